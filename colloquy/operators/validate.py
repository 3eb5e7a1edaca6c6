"""Conversation validation and the reject report.

Rules, first failure wins:

1. per turn, in position order: invalid role -> system turn not at position 0 ->
   blank content (the earliest failing turn decides);
2. whole conversation, on the non-system turns: none left -> does not start with a
   user turn -> two assistant turns in a row.

Typed lane (exploded turns) uses only splittable aggregates: the earliest failure
is ``min(struct(turn, reason))`` and adjacency of assistant turns is found by
grouping each assistant turn under the two pair keys it belongs to, so no group is
ever collected and a huge conversation is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import is_blank
from colloquy.session import cut_lineage

# The accepted roles and the reason texts.
VALID_ROLES = ("system", "user", "assistant")
R_INVALID_ROLE = "_invalid_role:"
R_SYSTEM_NOT_FIRST = "system_role_not_first"
R_EMPTY_CONTENT = "_empty_content"
R_NO_TURNS = "no_user_or_assistant_turns"
R_NOT_USER_FIRST = "does_not_start_with_user_turn"
R_CONSECUTIVE = "consecutive_assistant_turns"
MAX_DROPPED_TRACKED = 50


def turn_reason(turn: Column, role: Column, content_blank: Column, role_text: Column | None = None) -> Column:
    """First failing per-turn check of one message, null when the turn is fine."""
    role_text = F.coalesce(role, F.lit("None")) if role_text is None else role_text
    valid = F.coalesce(role.isin(*VALID_ROLES), F.lit(False))
    return (
        F.when(~valid, F.concat(F.lit("turn_"), turn.cast("string"), F.lit(R_INVALID_ROLE), role_text))
        .when((role == "system") & (turn != 0), F.lit(R_SYSTEM_NOT_FIRST))
        .when(content_blank, F.concat(F.lit("turn_"), turn.cast("string"), F.lit(R_EMPTY_CONTENT)))
    )


def sequence_reason(n_non_system: Column, first_role: Column, has_consecutive: Column) -> Column:
    return (
        F.when(n_non_system == 0, F.lit(R_NO_TURNS))
        .when(first_role != "user", F.lit(R_NOT_USER_FIRST))
        .when(has_consecutive, F.lit(R_CONSECUTIVE))
    )


def reason_class(reason: Column) -> Column:
    """Reason with the turn index and role value removed (bounded cardinality)."""
    return F.regexp_replace(F.regexp_replace(reason, r"^turn_\d+_", "turn_i_"), "(?s):.*$", "")


def validate_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, n_turns, reason, reason_class)``; ``reason`` is null for a valid conversation."""
    t, role = F.col("turn"), F.col("role")
    per_turn = turns.select(key, "turn", "role", turn_reason(t, role, is_blank(F.col("text"))).alias("_r"))
    facts = per_turn.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.min(F.when(F.col("_r").isNotNull(), F.struct(t.alias("t"), F.col("_r").alias("r")))).alias("_first"),
        F.count_if(role != "system").alias("_n_ns"),
        F.min_by(role, F.when(role != "system", t)).alias("_first_role"),
    )
    # Assistant turn at position p belongs to pairs (p-1, p) and (p, p+1); a pair key k
    # whose assistant turns include both k-1 and k means two adjacent assistant turns.
    # Groups hold at most two distinct positions and aggregate partially.
    pair_hits = (
        turns.filter(role == "assistant")
        .select(key, "turn", F.explode(F.array(t, t + 1)).alias("_pair"))
        .groupBy(key, "_pair")
        .agg(F.min("turn").alias("_lo"), F.max("turn").alias("_hi"))
        .filter((F.col("_lo") == F.col("_pair") - 1) & (F.col("_hi") == F.col("_pair")))
        .groupBy(key)
        .agg(F.lit(True).alias("_consec"))
    )
    out = facts.join(pair_hits, key, "left")
    reason = F.coalesce(
        F.col("_first.r"),
        sequence_reason(F.col("_n_ns"), F.col("_first_role"), F.coalesce(F.col("_consec"), F.lit(False))),
    )
    return out.select(key, "n_turns", reason.alias("reason")).withColumn("reason_class", reason_class(F.col("reason")))


def valid_turns(turns: DataFrame, verdicts: DataFrame, key: str = "conv_id") -> DataFrame:
    """Keep the turns of valid conversations (semi join on the verdict table)."""
    ok = verdicts.filter(F.col("reason").isNull()).select(key)
    return turns.join(ok, key, "left_semi")


def quarantine(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col("reason").isNotNull())


def reason_histogram(verdicts: DataFrame, order_col: str = "conv_id") -> DataFrame:
    """``(reason, reason_class, n, first_seen)`` ordered by count desc, then first appearance."""
    return (
        verdicts.filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first_seen"))
        .withColumn("reason_class", reason_class(F.col("reason")))
        .orderBy(F.desc("n"), F.asc("first_seen"))
    )


def validation_report(verdicts: DataFrame, order_col: str = "conv_id", split: str | None = None,
                      materialize: bool = True) -> DataFrame:
    """One-row report: totals, per-class reason counts and the first dropped ids.

    ``dropped`` comes from an ordered limit (top-k merge), never from collecting the
    whole reject set. The verdicts feed two branches, so they are checkpointed once
    (``materialize``) instead of being validated twice.
    """
    if materialize:
        verdicts = cut_lineage(verdicts.select(order_col, "reason"))
    by_class = verdicts.groupBy(reason_class(F.col("reason")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    dropped = (
        verdicts.filter(F.col("reason").isNotNull())
        .select(F.col(order_col).cast("bigint").alias("id"))
        .orderBy("id")
        .limit(MAX_DROPPED_TRACKED)
    )
    facts = by_class.select("k", "n", F.lit(None).cast("bigint").alias("id")).unionByName(
        dropped.select(F.lit(None).cast("string").alias("k"), F.lit(0).cast("bigint").alias("n"), "id")
    )
    report = facts.agg(
        F.sum("n").cast("bigint").alias("total"),
        F.coalesce(F.sum(F.when(F.col("k").isNull() & F.col("id").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("valid"),
        F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("invalid"),
        F.map_from_entries(
            F.filter(F.collect_list(F.struct("k", "n")), lambda e: e["k"].isNotNull())
        ).alias("reason_classes"),
        F.array_sort(F.collect_list("id")).alias("dropped"),
    )
    if split is not None:
        report = report.withColumn("split", F.lit(split))
    return report
