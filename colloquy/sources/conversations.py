"""Typed-lane conversation sources.

The exploded turn table ``(conv_id, turn, role, text)`` is the primary input: one row
per message, ``turn`` the 0-based position inside its conversation. Nothing here
groups a conversation into one value unless the caller asks for the assembled
``messages`` array (``assemble_messages``); validation and statistics work on the
exploded rows with splittable aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_TYPE = "array<struct<role:string,content:string>>"
MESSAGE_BLOCK_TURNS = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``conversations`` table as typed turns."""
    return read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def assemble_messages(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation with ``messages`` ordered by ``turn``.

    This is the nested-row form of the training corpus (one JSONL line per
    conversation); a conversation is bounded by what one training sequence holds.
    """
    # Two levels, like shape.ordered_text: sorted runs per (key, turn div block), then the
    # runs of each key in block order, so a huge conversation is pre-assembled in parallel.
    blk = F.floor(F.col("turn") / F.lit(MESSAGE_BLOCK_TURNS)).cast("bigint")
    runs = turns.groupBy(key, blk.alias("_blk")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
            lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")),
        ).alias("_run")
    )
    ordered = F.array_sort(F.collect_list(F.struct("_blk", "_run")))
    return runs.groupBy(key).agg(F.flatten(F.transform(ordered, lambda r: r["_run"])).alias("messages"))


def explode_messages(conversations: DataFrame, key: str = "conv_id", messages: str = "messages") -> DataFrame:
    """Inverse of ``assemble_messages``: nested rows back to typed turns."""
    return conversations.select(key, F.posexplode(messages).alias("turn", "m")).select(
        key, F.col("turn").cast("bigint").alias("turn"), F.col("m.role").alias("role"), F.col("m.content").alias("text")
    )


def with_split(df: DataFrame, split_expr: str, name: str = "split") -> DataFrame:
    """Tag rows with a split label computed by a SQL expression (e.g. a hash bucket)."""
    return df.withColumn(name, F.expr(split_expr))
