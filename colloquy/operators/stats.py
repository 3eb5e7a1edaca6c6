"""Corpus statistics: token counts, split summaries, histogram, packing and cost estimates.

Per-conversation counts are one splittable ``groupBy(conv_id)`` (partial sums on the
map side); split summaries are one ``groupBy(split)``. ``percentile`` merges
value->count maps, so its memory grows with distinct token counts, not with rows;
``approx=True`` switches to ``percentile_approx`` for huge splits. ``quantile_sketches``
keeps mergeable sketches of bounded size with a stated rank error instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.text import whitespace_tokens


# tokens/second per device family (a heuristic, not a measurement) and
# the device profiles (batch size, gradient accumulation, row cap).
TOKENS_PER_SEC = {"A100": 3000.0, "L4": 900.0, "T4": 250.0, "OTHER": 500.0, "CPU": 5.0}
DEVICE_PROFILES = {
    "A100": (4, 4, None),
    "L4": (2, 8, 30000),
    "T4": (1, 16, 5000),
    "OTHER": (1, 16, 5000),
    "CPU": (1, 1, 50),
}


@dataclass(frozen=True)
class TrainingPlan:
    max_seq_length: int = 1536
    batch_size: int = 1
    gradient_accumulation: int = 16
    epochs: float = 1.0
    packing: bool = False
    device: str = "OTHER"


@dataclass(frozen=True)
class TokenModel:
    """Native token counting: content tokens plus a fixed chat-template overhead.

    ``count`` maps a text Column to a token-count Column; plug an Arrow UDF around a
    real tokenizer here to count with it instead.
    """

    count: Callable[[Column], Column] = whitespace_tokens
    per_turn_overhead: int = 4
    bos_tokens: int = 1


def conversation_tokens(turns: DataFrame, model: TokenModel = TokenModel(), key: str = "conv_id",
                        extra: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *extra, n_turns, prompt_tokens, response_tokens, total_tokens)``.

    Prompt = every non-assistant turn, response = assistant turns, total = both plus
    the template overhead of each turn and the leading BOS.
    """
    n = model.count(F.col("text"))
    is_resp = F.coalesce(F.col("role") == "assistant", F.lit(False))
    agg = turns.groupBy(key, *extra).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sum(F.when(is_resp, F.lit(0)).otherwise(n)).cast("bigint").alias("prompt_tokens"),
        F.sum(F.when(is_resp, n).otherwise(F.lit(0))).cast("bigint").alias("response_tokens"),
    )
    total = (
        F.col("prompt_tokens") + F.col("response_tokens") + F.col("n_turns") * model.per_turn_overhead + model.bos_tokens
    )
    return agg.withColumn("total_tokens", total.cast("bigint"))


SKETCH_K = 4096  # size parameter of a quantile sketch


def rank_error(k: int = SKETCH_K) -> float:
    """The share of rows by which a sketched quantile's rank may be off (in 99 of 100 cases)."""
    return 2.296 / k**0.9723  # fixed values: the published single-sided bound of KLL sketches


def quantile_sketches(df: DataFrame, value: str, *group: str, k: int = SKETCH_K) -> DataFrame:
    """``(*group, sketch)``: a KLL sketch of the whole-number column ``value`` for each group.

    A sketch takes some 8 k bytes however many rows it stands for. Partial sketches are merged
    map-side, and sketches kept from earlier runs can be merged again (``merge_sketches``), so
    new rows cost a pass over themselves only. Nulls are left out; a group of nulls alone has
    an empty sketch.
    """
    return df.groupBy(*group).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), k).alias("sketch"))


def merge_sketches(sketches: DataFrame, *group: str) -> DataFrame:
    """``(*group, sketch)``: one sketch for each group, standing for the rows of all its sketches."""
    return sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """``sketches`` with ``n``, and ``p`` and ``quantile`` exploded: a value of the column whose
    rank is within ``rank_error`` of ``p``; an empty sketch gives null quantiles."""
    n = F.kll_sketch_get_n_bigint("sketch")
    # a quantile of an empty sketch is an error, so it is not asked for
    points = [F.struct(F.lit(p).alias("p"), F.when(n > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(p))).alias("quantile")) for p in probabilities]
    return sketches.withColumn("n", n).withColumn("_at", F.explode(F.array(*points))).select(*[c for c in sketches.columns if c != "sketch"], "n", "_at.*")


def _pct(col: str, p: float, approx: bool) -> Column:
    return F.percentile_approx(col, p, 100000).cast("double") if approx else F.percentile(col, F.lit(p))


ALL_SPLITS = "all"


def _grouped(df: DataFrame, split: str, with_total: bool):
    """``groupBy(split)``, or ``rollup(split)`` adding one all-splits line when ``with_total``."""
    return df.rollup(split) if with_total else df.groupBy(split)


def _gid(with_total: bool) -> list[Column]:
    return [F.grouping_id().alias("_gid")] if with_total else []


def dataset_statistics(per_conv: DataFrame, plan: TrainingPlan = TrainingPlan(), split: str = "split",
                       approx: bool = False, with_total: bool = False) -> DataFrame:
    """One row per split: averages, p95, max, over-length count, packing and cost figures.

    ``with_total`` adds an ``all`` line over every split (a rollup in the same aggregate).
    """
    L = plan.max_seq_length
    agg = _grouped(per_conv, split, with_total).agg(
        *_gid(with_total),
        F.count(F.lit(1)).alias("num_examples"),
        F.avg("n_turns").alias("avg_turns"),
        F.avg("prompt_tokens").alias("avg_prompt_tokens"),
        F.avg("response_tokens").alias("avg_response_tokens"),
        F.avg("total_tokens").alias("avg_total_tokens"),
        _pct("total_tokens", 0.95, approx).alias("p95_total_tokens"),
        F.max("total_tokens").alias("max_total_tokens"),
        F.count_if(F.col("total_tokens") > L).alias("num_exceeding_max_seq_length"),
        F.sum("total_tokens").alias("_sum_total"),
    )
    if with_total:
        agg = agg.withColumn(split, F.when(F.col("_gid") == 1, F.lit(ALL_SPLITS)).otherwise(F.col(split)))
    eff_batch = max(plan.batch_size * plan.gradient_accumulation, 1)
    n = F.col("num_examples")
    if plan.packing:
        packed = F.greatest(F.floor(F.col("_sum_total") / max(L, 1)), F.lit(1))
        steps_per_epoch = F.greatest(F.floor(packed / eff_batch), F.lit(1))
        tokens = n * F.col("avg_total_tokens")
        efficiency = (F.col("avg_total_tokens") / L) if L else F.lit(None)
    else:
        steps_per_epoch = F.greatest(F.floor(n / eff_batch), F.lit(1))
        tokens = n * F.lit(float(L))
        efficiency = F.lit(None)
    tps = TOKENS_PER_SEC.get(plan.device, TOKENS_PER_SEC["OTHER"])
    return agg.select(
        split,
        "num_examples",
        "avg_turns",
        "avg_prompt_tokens",
        "avg_response_tokens",
        "avg_total_tokens",
        "p95_total_tokens",
        "max_total_tokens",
        "num_exceeding_max_seq_length",
        efficiency.cast("double").alias("packing_efficiency"),
        (steps_per_epoch * F.lit(float(plan.epochs))).cast("bigint").alias("estimated_optimizer_steps"),
        (tokens * F.lit(float(plan.epochs)) / F.lit(max(tps, 1e-6)) / F.lit(3600.0)).alias(
            "estimated_training_time_hours"
        ),
    )


def token_analysis(per_conv: DataFrame, max_seq_length: int = 1536, split: str = "split",
                   value: str = "total_tokens", approx: bool = False, with_total: bool = False) -> DataFrame:
    """Mean, median, p95, max and over-length count of the template length per split."""
    out = _grouped(per_conv, split, with_total).agg(
        *_gid(with_total),
        F.avg(value).alias("mean"),
        _pct(value, 0.5, approx).alias("median"),
        _pct(value, 0.95, approx).alias("p95"),
        F.max(value).alias("max"),
        F.count_if(F.col(value) > max_seq_length).alias("num_exceeding_max_seq_length"),
        F.count(F.lit(1)).alias("n"),
    )
    if with_total:
        out = out.withColumn(split, F.when(F.col("_gid") == 1, F.lit(ALL_SPLITS)).otherwise(F.col(split)))
    return out.drop("_gid") if with_total else out


def with_empty_splits(figures: DataFrame, splits: list[str], split: str = "split",
                      unknown: tuple[str, ...] = ("packing_efficiency", "estimated_optimizer_steps", "estimated_training_time_hours")) -> DataFrame:
    """``figures`` with a row for every name in ``splits``: a split without examples has
    zeros, and nulls for the figures in ``unknown``."""
    names = figures.sparkSession.createDataFrame([(s,) for s in splits], f"{split} string")
    absent = names.join(figures.select(split), split, "left_anti")
    zeros = [
        (F.lit(None) if f.name in unknown else F.col(split) if f.name == split else F.lit(0)).cast(f.dataType).alias(f.name)
        for f in figures.schema.fields
    ]
    return figures.unionByName(absent.select(*zeros))


def over_length_note(n_over: Column, n: Column, max_seq_length: int) -> Column:
    """A remark for splits with conversations longer than the sequence length, else null."""
    said = F.concat(n_over.cast("string"), F.lit(" of "), n.cast("string"), F.lit(f" conversations are longer than {max_seq_length} tokens"))
    return F.when(n_over > 0, said)


def length_ratio(df: DataFrame, generated: str, gold: str) -> DataFrame:
    """Median lengths of generated and gold replies and the ratio of the two (null for empty golds)."""
    out = df.groupBy().agg(F.percentile(generated, F.lit(0.5)).alias("median_generated"), F.percentile(gold, F.lit(0.5)).alias("median_gold"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("ratio", F.try_divide("median_generated", "median_gold"))


def histogram(df: DataFrame, value: str, split: str = "split", bins: int = 20, width: int = 50) -> DataFrame:
    """Equal-width histogram per split between min and max, last bin closed, empty bins kept.

    ``(split, bin, bucket_lo, bucket_hi, count, bar)``; a split whose values are all
    equal yields one bin holding every row. The rows are read once: they are counted per
    ``(split, value)`` map-side, and bounds and bins both come from that exchange, which
    is as long as there are distinct values. No job runs while building.
    """
    df = df.groupBy(split, value).agg(F.count(F.lit(1)).alias("_n"))
    bounds = df.groupBy(split).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    # One row per split; the join is planned from the sizes measured at run time.
    binned = (
        df.join(bounds, split)
        .select(
            split,
            "_n",
            F.when(F.col("_hi") == F.col("_lo"), F.lit(0))
            .otherwise(F.least(F.floor((F.col(value) - F.col("_lo")) / w).cast("int"), F.lit(bins - 1)))
            .alias("bin"),
        )
        .groupBy(split, "bin")
        .agg(F.sum("_n").alias("count"))
    )
    grid = bounds.select(
        split,
        "_lo",
        "_hi",
        F.explode(F.when(F.col("_hi") == F.col("_lo"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(bins - 1)))).alias("bin"),
    )
    out = grid.join(binned, [split, "bin"], "left").withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("bigint"))
    top = F.max("count").over(Window.partitionBy(split))
    lo = F.col("_lo").cast("double")
    width_col = F.when(F.col("_hi") == F.col("_lo"), F.lit(0.0)).otherwise(w)
    bar_len = F.floor(F.col("count") / F.greatest(top, F.lit(1)) * F.lit(float(width))).cast("int")
    return out.select(
        split,
        F.col("bin").cast("int").alias("bin"),
        (lo + F.col("bin") * width_col).alias("bucket_lo"),
        (lo + F.col("bin") * width_col + width_col).alias("bucket_hi"),
        "count",
        F.repeat(F.lit("#"), bar_len).alias("bar"),
    )


def cost_by_device(stats: DataFrame, plan: TrainingPlan = TrainingPlan(),
                   split: str = "split") -> DataFrame:
    """Training-time estimate of every split on every device family (fixed 5-entry list)."""
    L = plan.max_seq_length
    n = F.col("num_examples")
    tokens = n * F.col("avg_total_tokens") if plan.packing else n * F.lit(float(L))
    devices = F.array(*[F.struct(F.lit(k).alias("device"), F.lit(v).alias("tps")) for k, v in TOKENS_PER_SEC.items()])
    return stats.select(split, "num_examples", "avg_total_tokens", F.explode(devices).alias("_d")).select(
        split,
        F.col("_d.device").alias("device"),
        (tokens * F.lit(float(plan.epochs)) / F.greatest(F.col("_d.tps"), F.lit(1e-6)) / F.lit(3600.0)).alias(
            "estimated_training_time_hours"
        ),
    )


def exchanges_per_row(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Assistant turns per conversation and their distribution (``n_exchanges``, ``n_rows``)."""
    per = turns.groupBy(key).agg(F.count_if(F.col("role") == "assistant").alias("n_exchanges"))
    return per.groupBy("n_exchanges").agg(F.count(F.lit(1)).alias("n_rows"))


def length_distribution(df: DataFrame, value: str, group: str | None = None, max_tokens: int | None = None) -> DataFrame:
    """Median, p99, max of a length column; optional count of rows that hit the budget."""
    aggs = [
        F.percentile(value, F.lit(0.5)).alias("median"),
        F.percentile(value, F.lit(0.99)).alias("p99"),
        F.max(value).alias("max"),
        F.count(F.lit(1)).alias("n"),
    ]
    if max_tokens is not None:
        aggs.append(F.count_if(F.col(value) >= max_tokens).alias("n_at_budget"))
    return (df.groupBy(group) if group else df.groupBy()).agg(*aggs)


def arrow_token_counter(make_encoder):
    """Build a ``TokenModel.count`` from a tokenizer factory (Arrow-batched).

    ``make_encoder()`` runs once per Python worker and returns ``encode(text) -> list``;
    the resulting Column counts tokens of each text. Use for a real tokenizer when
    the native whitespace count is not close enough.
    """
    state = {}

    @F.pandas_udf(T.LongType())
    def _count(texts: pd.Series) -> pd.Series:
        enc = state.get("enc")
        if enc is None:
            enc = state["enc"] = make_encoder()
        return pd.Series([0 if t is None else len(enc(t)) for t in texts], dtype="int64")

    return lambda c: _count(c)


def distinct_word_tokens(texts: DataFrame, key: str, text: str, count: Callable[[Column], Column]) -> DataFrame:
    """``(key, n_tokens)``: tokens of each text's words, each distinct word tokenised once.

    For tokenizers that cut texts at white space first. Words are counted per text, the
    tokenizer (``count``, e.g. from ``arrow_token_counter``) sees every distinct word of the
    table once, and a text's tokens are a weighted sum joined back. A null or blank text has 0.
    """
    words = texts.select(key, F.explode(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")).alias("word"))
    per_text = words.where("word <> ''").groupBy(key, "word").agg(F.count(F.lit(1)).alias("times"))
    sizes = per_text.select("word").distinct().withColumn("size", count(F.col("word")))
    sums = per_text.join(sizes, "word").groupBy(key).agg(F.sum(F.col("times") * F.col("size")).alias("n_tokens"))
    return texts.select(key).join(sums, key, "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)).cast("long"))


def device_family(name: Column) -> Column:
    """Device family from a device name: A100, L4 (but not L40), T4, else OTHER."""
    upper = F.upper(name)
    return (
        F.when(upper.contains("A100"), F.lit("A100"))
        .when(upper.contains("L4") & ~upper.contains("L40"), F.lit("L4"))
        .when(upper.contains("T4"), F.lit("T4"))
        .otherwise(F.lit("OTHER"))
    )


def device_profile(family: str | None, detected: str = "OTHER") -> dict:
    """Recommended batch size, accumulation and row cap; an unknown override is an error."""
    if family:
        key = family.upper()
        if key not in DEVICE_PROFILES:
            raise ValueError(f"Unknown device profile override: {family!r}. Expected one of {sorted(DEVICE_PROFILES)}.")
    else:
        key = detected
    batch, accum, cap = DEVICE_PROFILES[key]
    return {"family": key, "batch_size": batch, "gradient_accumulation": accum, "max_train_rows": cap}


def template_tokens(turns: DataFrame, count: Callable[[Column], Column], key: str = "conv_id", template=None) -> DataFrame:
    """``(key, total_tokens)`` counted on the rendered chat template of each conversation.

    Use with a real tokenizer (``arrow_token_counter``) when the template markup itself
    must be counted exactly; the result can replace ``total_tokens`` of
    ``conversation_tokens`` by a key join.
    """
    from colloquy.operators.shape import DEFAULT_TEMPLATE, flatten_text

    flat = flatten_text(turns, template or DEFAULT_TEMPLATE, key)
    return flat.select(key, count(F.col("text")).cast("bigint").alias("total_tokens"))
