"""Reply scoring: exact match, per-section accuracy, robustness against level 1.

Each reply is parsed once into a struct (``with_parsed_reply``); every score reads fields of
that struct. Section accuracy is one global aggregate with partial aggregation on the
map side, unpivoted into one row per section afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.replies import (
    PASS_PARSERS,
    exact_match,
    field_of,
    metric_of,
    parse_envelope,
    with_envelope,
    with_parsed_reply,
)

# Level names of the robustness suite and the level-1 note.
LEVEL_NAMES = {
    1: "Explicit entity + explicit identifier",
    2: "Synonyms",
    3: "Implicit entity from identifier",
    4: "Natural operator language",
}
LEVEL1_NOTE = "reference level — each group's own baseline, not scored against itself"


def parse_pair(preds: DataFrame, generated: str = "generated", gold: str = "gold") -> DataFrame:
    """Add ``_pg`` (parsed gold) and ``_pp`` (parsed prediction) struct columns.

    Sections of the prediction that are the gold's own text are not parsed again.
    """
    return with_parsed_reply(with_parsed_reply(preds, gold, "_pg", keep=True), generated, "_pp", like="_pg")


def score_predictions(preds: DataFrame, generated: str = "generated", gold: str = "gold") -> DataFrame:
    """Per-row ``exact_match`` plus one ``<PASS>_score`` column per section (null = gold unparseable)."""
    parsed = parse_pair(preds, generated, gold)
    scores = [
        metric_of(p)(F.col(f"_pp.{field_of(p)}"), F.col(f"_pg.{field_of(p)}")).alias(f"{p.lower()}_score")
        for p in PASS_PARSERS
    ]
    em = exact_match(F.col(generated), F.col(gold), F.col("_pp.envelope"), F.col("_pg.envelope")).alias("exact_match")
    return parsed.select(*[c for c in preds.columns], em, *scores, "_pg", "_pp")


def pass_accuracy(parsed: DataFrame) -> DataFrame:
    """One row per section: accuracy, num_scored, num_gold_unparseable, num_prediction_unparseable.

    ``parsed`` must carry ``_pg``/``_pp`` (``parse_pair`` or ``score_predictions``).
    A gold-unparseable row is excluded; an unparseable prediction counts as wrong.
    """
    aggs = []
    for p in PASS_PARSERS:
        g, q = F.col(f"_pg.{field_of(p)}"), F.col(f"_pp.{field_of(p)}")
        aggs += [
            F.count_if(g.isNull()).alias(f"{p}_gu"),
            F.count_if(g.isNotNull()).alias(f"{p}_sc"),
            F.count_if(g.isNotNull() & q.isNull()).alias(f"{p}_pu"),
            F.count_if(g.isNotNull() & q.isNotNull() & (q == g)).alias(f"{p}_ok"),
        ]
    wide = parsed.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(p).alias("pass_name"),
                F.col(f"{p}_ok").alias("correct"),
                F.col(f"{p}_sc").alias("num_scored"),
                F.col(f"{p}_gu").alias("num_gold_unparseable"),
                F.col(f"{p}_pu").alias("num_prediction_unparseable"),
            )
            for p in PASS_PARSERS
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select(
        "r.pass_name",
        F.coalesce(F.try_divide(F.col("r.correct").cast("double"), F.col("r.num_scored").cast("double")), F.lit(0.0)).alias(
            "accuracy"
        ),
        "r.num_scored",
        "r.num_gold_unparseable",
        "r.num_prediction_unparseable",
    )


def exact_match_rate(scored: DataFrame, col: str = "exact_match", status: str | None = None) -> DataFrame:
    """Mean of the scores there are (0.0 when none) and the number of examples.

    With ``status``, examples whose prediction failed score 0.0, and ``num_errors`` counts them.
    """
    failed = F.coalesce(F.col(status) != "ok", F.lit(True)) if status else F.lit(False)
    errors = [F.count_if(failed).alias("num_errors")] if status else []
    return scored.agg(
        F.coalesce(F.avg(F.when(failed, F.lit(0.0)).otherwise(F.col(col))), F.lit(0.0)).alias("exact_match_rate"),
        F.count(F.lit(1)).alias("num_examples"),
        *errors,
    )


def robustness(results: DataFrame, group: str = "group_id", level: str = "level", seq: str = "seq",
               envelope: str = "pass4_envelope") -> DataFrame:
    """Add ``matches_level1``: each group's last level-1 envelope is the reference.

    Null for levels <= 1, for groups without a level-1 row and when the reference is
    unparseable; an unparseable answer against a valid reference is false. The
    reference is a splittable ``max_by`` per group joined back on the group key
    (AQE splits a hot group on the large side). ``results`` is read twice: pass a
    materialised frame (``session.cut_lineage``) when it comes from a predictor or UDF.
    """
    lv = F.col(level)
    ref = results.groupBy(group).agg(
        F.max_by(F.struct(F.col(envelope).alias("e")), F.when(lv == 1, F.col(seq))).alias("_ref")
    )
    joined = results.join(ref, group, "left")
    ref_env = F.col("_ref.e")
    matches = F.when((lv > 1) & ref_env.isNotNull(), F.coalesce(F.col(envelope) == ref_env, F.lit(False)))
    return joined.withColumn("matches_level1", matches).drop("_ref")


def robustness_of_replies(results: DataFrame, group: str = "group_id", level: str = "level", seq: str = "seq",
                          reply: str = "generated", envelope: str = "pass4_envelope") -> DataFrame:
    """``robustness`` from reply texts, without reading parsed rows twice.

    The reference is chosen as a text; so each reply is parsed once, after the exchange
    that deals the rows by group, and each group's reference once. No job runs while
    building. Replies from a predictor must be materialised before.
    """
    ref = results.groupBy(group).agg(F.max_by(F.struct(F.col(reply).alias("t")), F.when(F.col(level) == 1, F.col(seq))).alias("_r"))
    ref = with_envelope(ref.select(group, F.col("_r.t").alias("_r")), "_r", "_ref").drop("_r")
    joined = with_envelope(results.join(ref, group, "left"), reply, envelope)
    scored = (F.col(level) > 1) & F.col("_ref").isNotNull()
    matches = F.when(scored, F.coalesce(F.col(envelope) == F.col("_ref"), F.lit(False)))
    return joined.withColumn("matches_level1", matches).drop("_ref")


def in_report_order(results: DataFrame, group: str = "group_id", level: str = "level", seq: str = "seq") -> DataFrame:
    """Results by group, inside it by level, then as they came."""
    return results.orderBy(group, level, seq)


def robustness_summary(scored: DataFrame, level: str = "level", seq: str = "seq", level_name: str = "level_name") -> DataFrame:
    """Per level: name (first seen), queries, scoreable, consistency (0.0 if none); level 1 is a note."""
    m = F.col("matches_level1")
    agg = scored.groupBy(level).agg(
        F.min_by(level_name, seq).alias("level_name"),
        F.count(F.lit(1)).alias("num_queries"),
        F.count(m).alias("_scoreable"),
        F.count_if(m).alias("_matches"),
    )
    is_ref = F.col(level) == 1
    return agg.select(
        level,
        "level_name",
        "num_queries",
        F.when(~is_ref, F.col("_scoreable")).alias("num_scoreable"),
        F.when(
            ~is_ref,
            F.coalesce(F.try_divide(F.col("_matches").cast("double"), F.col("_scoreable").cast("double")), F.lit(0.0)),
        ).alias("consistency_with_level1"),
        F.when(is_ref, F.lit(LEVEL1_NOTE)).alias("note"),
    )


def level_name_column(level: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in LEVEL_NAMES.items():
        out = F.when(level == k, F.lit(v)).otherwise(out)
    return out


def envelope_of(text: Column) -> Column:
    return parse_envelope(text)
