"""Composed jobs: split loading, benchmark runs, robustness runs, reports, manifests.

Each job is a short composition of the operators; only one-row reports reach the
driver (to be printed), every per-row result stays a DataFrame.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.operators import evaluate, generate, shape, validate
from colloquy.operators.registry import MANIFEST_SCHEMA
from colloquy.sources import jsonl, sinks
from colloquy.session import cut_lineage, stored

# The robustness suite (system prompt, deployment context, 12 queries).
LOOKUP_SYSTEM_PROMPT = (
    "You are a GPON network inventory query compiler. Given deployment context and "
    "natural language queries, emit five passes per query:\n"
    "PASS_0 Normalization — spelling/token fixes only; (none) when query is already clean.\n"
    "PASS_1 Lexical Detection — quoted verbatim phrases from normalized text (lexer output).\n"
    "PASS_2 Intent — exactly one canonical operation (LOOKUP, LIST, TRACE, COUNT, "
    "UNSUPPORTED on failure traces, etc.).\n"
    "PASS_3 Semantic Resolution — YAML semantic record only (mention, entity, source, confidence).\n"
    "PASS_4 TIR envelope JSON with status (SUCCESS or failure status) and diagnostics when not SUCCESS.\n"
    "Never invent identifiers or filters. Use deployment aliases only when listed in context."
)
LOOKUP_DEPLOYMENT_CONTEXT = (
    "## Deployment context\n\n"
    "product_families:\n"
    "  OLT:\n"
    "    aliases:\n"
    "      - OLT\n"
    "      - MA5xxx\n"
    "      - DSLAM\n\n"
    "olt_name_aliases:\n"
    "  TABA-04: TABA-04_XABA+A03_GPON_CO\n"
)
LOOKUP_QUERIES = [
    ("onu_sn", 1, "Show ONU 48575443EC9D3DB0"),
    ("onu_sn", 2, "Find subscriber 48575443EC9D3DB0"),
    ("onu_sn", 3, "Show 48575443EC9D3DB0"),
    ("onu_sn", 4, "Need details for subscriber 48575443EC9D3DB0"),
    ("olt_name", 1, "Find OLT TABA-04"),
    ("olt_name", 2, "Locate ONT TABA-04"),
    ("olt_name", 3, "Find TABA-04"),
    ("olt_name", 4, "Pull up the record for TABA-04"),
    ("ne_ip", 1, "Show NE 10.99.1.20"),
    ("ne_ip", 2, "Locate device 10.99.1.20"),
    ("ne_ip", 3, "Find 10.99.1.20"),
    ("ne_ip", 4, "Pull up the device at 10.99.1.20"),
]
# ------------------------------------------------------------------ split loads
LINE_KEY = ("file", "block", "row")


@dataclass
class SplitLoad:
    valid: DataFrame | None
    verdicts: DataFrame
    report: DataFrame


def load_split(spark: SparkSession, path: str, split: str, max_samples: int | None = None, seed: int = 42) -> SplitLoad:
    """Validated rows, with ``(file, line_no)``, and the reject report of one JSONL split.

    The text is read and inspected once; the verdicts are stored as Parquet, so the report
    reads reasons and keys only. Line numbers are joined late (``jsonl.number_lines``): to
    the rejected lines for the report, to bare keys for a capped sample, and to valid rows
    only if a reader asks for ``line_no``.
    """
    lines = jsonl.block_lines(spark, path)
    kept = stored(jsonl.validate_lines(lines, keep_blank=True), "verdicts")
    offsets = jsonl.block_offsets(kept)
    verdicts = jsonl.number_lines(kept.filter(~F.col("blank")).drop("blank"), offsets)
    report = validate.validation_report(verdicts, order_col="line_no", split=split, materialize=False)
    rows = kept.filter(~F.col("blank") & F.col("reason").isNull()).select(*LINE_KEY, "messages")
    valid = jsonl.number_lines(rows, offsets)
    if max_samples is not None:
        chosen = shape.seeded_sample(jsonl.number_lines(rows.select(*LINE_KEY), offsets), ("file", "line_no"), max_samples, seed)
        valid = rows.join(chosen, list(LINE_KEY))
    return SplitLoad(valid=valid.select(*LINE_KEY, "line_no", "messages"), verdicts=verdicts, report=report)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_train(spark: SparkSession, path: str, max_samples: int | None = None, seed: int = 42) -> SplitLoad:
    """Required split: a missing path or zero valid rows is an error."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"the train split has no file at {path}")
    load = load_split(spark, path, "train", max_samples, seed)
    if load.valid.isEmpty():
        raise ValueError(f"not one line of {path} passed validation")
    return load


def load_optional(spark: SparkSession, path: str | None, split: str, max_samples: int | None = None,
                  seed: int = 42) -> SplitLoad | None:
    """Optional split (val / golden): unset, missing or without valid rows gives ``None``."""
    if not path or not _exists(spark, path):
        return None
    load = load_split(spark, path, split, max_samples, seed)
    if load.valid.isEmpty():
        load.valid = None
    return load


def pick_eval_source(golden: DataFrame | None, fallback: DataFrame | None,
                     fallback_name: str = "val") -> tuple[DataFrame | None, str | None]:
    """Golden when present, else the fallback split, else nothing; with the provenance tag."""
    if golden is not None:
        return golden, "golden"
    if fallback is not None:
        return fallback, fallback_name
    return None, None


# ------------------------------------------------------------------- benchmark
def generate_predictions(conversations: DataFrame, key: str, batch_factory: Callable | None = None,
                         decode_factory: Callable | None = None, batch_size: int = 8,
                         max_new_tokens: int = 400) -> DataFrame:
    """Prediction records for rows ending on an assistant turn (others are skipped)."""
    prompts = shape.prompt_gold_records(conversations, key=key)
    gen = generate.generate(prompts, decode_factory=decode_factory, batch_factory=batch_factory,
                            batch_size=batch_size, max_new_tokens=max_new_tokens)
    return generate.prediction_records(gen, key)


def run_benchmark(spark: SparkSession, golden: DataFrame | None, fallback: DataFrame | None, key: str,
                  run_dir: str, batch_factory: Callable | None = None, decode_factory: Callable | None = None,
                  batch_size: int = 8, fallback_name: str = "val", run_id: str | None = None,
                  base_model: str = "", adapter_dir: str = "", val_metrics: dict[str, float] | None = None) -> DataFrame:
    """Generation benchmark: predictions exported under ``run_dir``, one-row report returned.

    ``val_metrics`` are the trainer's own figures, carried into the report.
    """
    data, source = pick_eval_source(golden, fallback, fallback_name)
    now = datetime.now(timezone.utc).replace(microsecond=0).isoformat()
    base = spark.range(1).select(
        F.lit(run_id or os.path.basename(run_dir.rstrip("/"))).alias("run_id"),
        F.lit(now).alias("timestamp"),
        F.lit(base_model).alias("base_model"),
        F.lit(adapter_dir).alias("adapter_dir"),
        F.lit(source).cast("string").alias("eval_dataset_source"),
        (F.create_map(*[F.lit(x) for kv in val_metrics.items() for x in (kv[0], float(kv[1]))]) if val_metrics
         else F.create_map()).cast("map<string,double>").alias("val_metrics"),
    )
    if data is None:
        return base.select(
            "*",
            F.lit(None).cast("struct<exact_match_rate:double,num_examples:bigint,num_errors:bigint>").alias("golden_metrics"),
            F.lit(0).cast("bigint").alias("num_golden_examples"),
            F.lit(None).cast("string").alias("predictions_path"),
            F.create_map().cast("map<string,struct<accuracy:double,num_scored:bigint,num_gold_unparseable:bigint,"
                                "num_prediction_unparseable:bigint>>").alias("pass_metrics"),
        )
    preds = generate_predictions(data, key, batch_factory, decode_factory, batch_size)
    preds = cut_lineage(preds)  # the predictor runs once; export and scores read the checkpoint
    path = sinks.export_predictions(preds, run_dir, source)
    # Both aggregates are one row / five rows: fetch them and write the report row directly.
    rate = evaluate.exact_match_rate(preds, status="status").first()
    acc = evaluate.pass_accuracy(evaluate.parse_pair(preds)).collect()
    pass_map = F.create_map(*[
        x
        for r in acc
        for x in (
            F.lit(r["pass_name"]),
            F.struct(
                F.lit(r["accuracy"]).cast("double").alias("accuracy"),
                F.lit(r["num_scored"]).cast("bigint").alias("num_scored"),
                F.lit(r["num_gold_unparseable"]).cast("bigint").alias("num_gold_unparseable"),
                F.lit(r["num_prediction_unparseable"]).cast("bigint").alias("num_prediction_unparseable"),
            ),
        )
    ])
    return base.select(
        "*",
        F.struct(
            F.lit(rate["exact_match_rate"]).cast("double").alias("exact_match_rate"),
            F.lit(rate["num_examples"]).cast("bigint").alias("num_examples"),
            F.lit(rate["num_errors"]).cast("bigint").alias("num_errors"),
        ).alias("golden_metrics"),
        F.lit(rate["num_examples"]).cast("bigint").alias("num_golden_examples"),
        F.lit(path).alias("predictions_path"),
        pass_map.alias("pass_metrics"),
    )


# ------------------------------------------------------------------ robustness
def lookup_suite(spark: SparkSession) -> DataFrame:
    """The 12-query robustness suite (3 groups x 4 levels) with level names and order."""
    rows = [(g, lv, evaluate.LEVEL_NAMES[lv], q, i) for i, (g, lv, q) in enumerate(LOOKUP_QUERIES)]
    return spark.createDataFrame(rows, "group_id string, level int, level_name string, query string, seq long")


def robustness_prompts(queries: DataFrame, system_prompt: str = LOOKUP_SYSTEM_PROMPT,
                       context: str = LOOKUP_DEPLOYMENT_CONTEXT) -> DataFrame:
    """System turn, deployment-context turn, then ``## Query\\n<query>``."""
    msg = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")),
        F.struct(F.lit("user").alias("role"), F.lit(context).alias("content")),
        F.struct(F.lit("user").alias("role"), F.concat(F.lit("## Query\n"), F.col("query")).alias("content")),
    )
    return queries.withColumn("prompt_messages", msg)


def run_lookup_level_benchmark(queries: DataFrame, batch_factory: Callable | None = None,
                               decode_factory: Callable | None = None, batch_size: int = 1,
                               max_new_tokens: int = 400) -> DataFrame:
    """Answers, parsed envelopes and ``matches_level1`` for every query of the suite."""
    gen = generate.generate(robustness_prompts(queries), decode_factory=decode_factory, batch_factory=batch_factory,
                            batch_size=batch_size, max_new_tokens=max_new_tokens)
    with_env = gen.withColumn("pass4_envelope", evaluate.envelope_of(F.col("generated"))).drop("prompt_messages")
    # Scoring reads the answers twice (reference aggregate + join back): checkpoint so
    # the predictor runs exactly once per query.
    return evaluate.robustness(cut_lineage(with_env))


# --------------------------------------------------------------------- reports
def report_lines(rows: DataFrame, title: str | None = None) -> Iterator[str]:
    """Any report as text, field by field from its schema; rows come one by one.

    Null fields are left out; nested fields are shown as JSON.
    """
    if title:
        yield f"# {title}"
    flat = rows.select(*[
        (F.to_json(c) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.format_string("%.4g", c)
         if isinstance(f.dataType, T.DoubleType) else F.col(c).cast("string")).alias(c)
        for f in rows.schema.fields for c in [f.name]
    ])
    for row in flat.toLocalIterator():
        yield "; ".join(f"{name}={value}" for name, value in row.asDict().items() if value is not None)


def validation_text(load: SplitLoad, order_col: str = "line_no") -> Iterator[str]:
    """A split's validation report, followed by every invalid reason with its count."""
    yield from report_lines(load.report, "validation")
    yield from report_lines(validate.reason_histogram(load.verdicts, order_col), "reasons")


def statistics_text(statistics: DataFrame) -> Iterator[str]:
    """Statistics rows as text."""
    yield from report_lines(statistics, "statistics")


def build_manifest(spark: SparkSession, counts: DataFrame, params: dict, prior: DataFrame | None = None) -> DataFrame:
    """One-row run manifest from split row counts and run parameters.

    ``counts`` is ``(split, rows)``; ``training_mode`` is ``continue_lora`` when a prior
    adapter is set. ``prior`` (one row, optional) is embedded as JSON text.
    """
    c = counts.groupBy().pivot("split", ["train", "val", "golden"]).agg(F.first("rows"))
    base = c.select(
        F.coalesce(F.col("train"), F.lit(0)).cast("bigint").alias("train_rows"),
        F.coalesce(F.col("val"), F.lit(0)).cast("bigint").alias("val_rows"),
        F.col("golden").cast("bigint").alias("golden_rows"),
    )
    cols = [F.lit(v).alias(k) for k, v in params.items()]
    mode = "continue_lora" if params.get("continued_from") else "fresh_lora"
    out = base.select("*", *cols, F.lit(mode).alias("training_mode"),
                      F.lit(datetime.now(timezone.utc).replace(microsecond=0).isoformat()).alias("created_at"))
    if prior is not None:
        prior_json = prior.select(F.to_json(F.struct("*")).alias("j")).first()
        out = out.withColumn("prior_manifest", F.lit(prior_json["j"] if prior_json else None).cast("string"))
    # every field of a manifest, in its order; what the caller left out is null
    return out.select(*[
        (F.col(f.name) if f.name in out.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA.fields
    ], *[c for c in out.columns if c not in MANIFEST_SCHEMA.fieldNames()])


def run_golden_evaluation(golden: DataFrame | None, key: str, batch_factory: Callable | None = None,
                          decode_factory: Callable | None = None, max_samples: int | None = None,
                          batch_size: int = 1) -> DataFrame | None:
    """Golden evaluation: ``None`` without a golden split; else the first ``max_samples`` rows
    (by key), predictions and a one-row ``(exact_match_rate, num_examples)``."""
    if golden is None:
        return None
    data = shape.first_n(golden, key, max_samples) if max_samples is not None else golden
    preds = generate_predictions(data, key, batch_factory, decode_factory, batch_size)
    return evaluate.exact_match_rate(preds, status="status")


def prediction_sample(conversations: DataFrame, key: str, decode_factory: Callable, eval_count: int,
                      every_n_evals: int = 1, sample_size: int = 8, max_new_tokens: int = 256) -> DataFrame | None:
    """Periodic ``(gold, generated)`` sample: on every n-th evaluation, the first
    ``sample_size`` rows (by key) that end on an assistant turn; rows whose predictor
    call fails are skipped, not fatal."""
    if eval_count % max(every_n_evals, 1) != 0:
        return None
    first = shape.first_n(conversations, key, sample_size)
    prompts = shape.prompt_gold_records(first, key=key)
    gen = generate.generate(prompts, decode_factory=decode_factory, max_new_tokens=max_new_tokens)
    return gen.filter(F.col("status") == "ok").select("gold", "generated")


def settle_remote(results: DataFrame, requests: DataFrame, key: str = "request_id", newest: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Results of a remote run joined to its request log, and how the two sides met.

    Of several results of one request the newest counts (greatest ``newest``). The second
    table has one row: requests on both sides, only in the results, only in the log, and
    results dropped as older repeats.
    """
    once = results.groupBy(key).agg(F.max_by(F.struct("*"), newest).alias("_r"), F.count(F.lit(1)).alias("_n"))
    both = once.join(requests.withColumn("_log", F.lit(True)), key, "full")
    counts = both.agg(
        F.count_if(F.col("_r").isNotNull() & F.col("_log").isNotNull()).alias("matched"),
        F.count_if(F.col("_log").isNull()).alias("without_log"),
        F.count_if(F.col("_r").isNull()).alias("without_result"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeats"),
    )
    fields = [c for c in results.columns if c != key]
    joined = both.where("_r IS NOT NULL AND _log IS NOT NULL")
    return joined.select(key, *[F.col(f"_r.{c}").alias(c) for c in fields], *[c for c in requests.columns if c != key]), counts


def score_remote_run(results: DataFrame, chunk_metrics: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remote robustness run: results ``(request_id, group_id, level, level_name, seq)`` joined by
    request id to per-request stream metrics (text = the answer), scored against level 1.

    Returns (scored rows, per-level summary, latency summary).
    """
    from colloquy.operators import telemetry

    joined = results.join(chunk_metrics, "request_id")
    answers = joined.withColumn("generated", F.col("text")).withColumn(
        "pass4_envelope", evaluate.envelope_of(F.col("generated"))
    )
    scored = evaluate.robustness(cut_lineage(answers))
    return scored, evaluate.robustness_summary(scored), telemetry.metrics_summary(chunk_metrics)
