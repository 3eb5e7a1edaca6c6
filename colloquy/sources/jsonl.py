"""Raw JSONL lane: text scan, original line numbers, strict JSON checks, validation.

* ``block_lines`` reads text files with a key for every line: its file, the block (file
  split) it lies in and its number in the read. Line numbers (1-based per file, blank lines
  count) come late: ``block_offsets`` is a table of one row for each block, which
  ``number_lines`` joins to the lines whose numbers are asked for.
* ``read_lines`` is the numbered form of the same read.
* ``inspect_records`` is the only Python step: ``json.loads`` gives the exact parse
  error text and Python's truthiness rules for content; it returns a typed struct.
* ``validate_lines`` applies the message rules natively on that struct's arrays.
"""

from __future__ import annotations

import json
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.canonical import escape_surrogates
from colloquy.functions.text import py_strip
from colloquy.operators import validate as V

TURN_TYPE = T.StructType(
    [
        T.StructField("is_dict", T.BooleanType()),
        T.StructField("role", T.StringType()),
        T.StructField("role_repr", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_blank", T.BooleanType()),
    ]
)
RECORD_TYPE = T.StructType(
    [
        T.StructField("json_reason", T.StringType()),
        T.StructField("has_messages", T.BooleanType()),
        T.StructField("messages_is_list", T.BooleanType()),
        T.StructField("turns", T.ArrayType(TURN_TYPE)),
    ]
)

TASK_BYTES = 32 << 20


def block_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, block, row, value)`` for every line of the text files, in one pass without a shuffle.

    ``row`` grows along a block and is unique in the read. Lines of a stored read keep their
    key; a read with other split sizes deals other ones. Where blocks are far smaller than a
    task is worth, one task reads many of them: there is no more than a task for each
    ``TASK_BYTES``, nor fewer than shuffle partitions.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    split = int(number) << 10 * " kmgt".index(unit or " ")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), lines.rdd.getNumPartitions() * split // TASK_BYTES)
    return lines.coalesce(tasks)  # the numbers are dealt by block, before


def block_offsets(lines: DataFrame) -> DataFrame:
    """``(file, block, shift)``, one row for each block: ``row + shift`` is the line number in the file.

    ``lines`` are all lines of a read, blank ones included; only their keys are looked at.
    """
    blocks = lines.groupBy("file", "block").agg(F.min("row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("shift"))


def number_lines(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``rows`` with ``line_no``. Offsets are unique by block, so a reader of other columns
    gets a plan without the join, and a filter on ``rows`` comes before it."""
    return rows.join(offsets, ["file", "block"], "left").withColumn("line_no", F.col("row") + F.col("shift")).drop("shift")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, line_no, value)`` for every line of the text files, numbered from 1 per file."""
    lines = block_lines(spark, paths)
    return number_lines(lines, block_offsets(lines)).select("file", "line_no", "value")


def count_nonblank_lines(spark: SparkSession, paths: str | list[str]) -> int:
    return spark.read.text(paths).filter(py_strip(F.col("value")) != "").count()


def _rejected(reason: str) -> dict:
    return {"json_reason": reason, "has_messages": None, "messages_is_list": None, "turns": None}


def _text(value: str | None) -> str | None:
    """``value`` with lone surrogates spelt out, so that it can leave Python as UTF-8."""
    return None if value is None else escape_surrogates(value)


def _inspect(line: Any) -> dict | None:
    """One line's record; a line that can't be read is a rejected record, never an error."""
    if line is None:
        return None
    try:
        return _inspected(json.loads(line))
    except json.JSONDecodeError as exc:
        return _rejected(f"invalid_json:{exc.msg}")
    except (ValueError, RecursionError) as exc:
        return _rejected(f"invalid_json:{exc}")


def _inspected(data: Any) -> dict:
    if not isinstance(data, dict):
        return _rejected("not_a_json_object")
    messages = data.get("messages")
    turns = None
    if isinstance(messages, list):
        turns = []
        for m in messages:
            if not isinstance(m, dict):
                turns.append({"is_dict": False, "role": None, "role_repr": None, "content": None, "content_blank": None})
                continue
            role = m.get("role")
            content = m.get("content")
            turns.append(
                {
                    "is_dict": True,
                    "role": _text(role) if isinstance(role, str) else None,
                    "role_repr": _text(str(role)),
                    "content": _text(content if isinstance(content, str) or content is None
                                     else json.dumps(content, ensure_ascii=False)),
                    "content_blank": (not content) or (not str(content).strip()),
                }
            )
    return {
        "json_reason": None,
        "has_messages": messages is not None,
        "messages_is_list": isinstance(messages, list),
        "turns": turns,
    }


@F.pandas_udf(RECORD_TYPE)
def inspect_records(lines: pd.Series) -> pd.DataFrame:
    """Strict parse of each JSONL line into the typed inspection struct."""
    rows = [_inspect(x) for x in lines]
    empty = {"json_reason": None, "has_messages": None, "messages_is_list": None, "turns": None}
    return pd.DataFrame([r if r is not None else empty for r in rows], columns=[f.name for f in RECORD_TYPE.fields])


def _turn_failure(m: Column, i: Column) -> Column:
    valid = F.coalesce(m["role"].isin(*V.VALID_ROLES), F.lit(False))
    idx = i.cast("string")
    return (
        F.when(~m["is_dict"], F.concat(F.lit("turn_"), idx, F.lit("_not_a_dict")))
        .when(~valid, F.concat(F.lit("turn_"), idx, F.lit(V.R_INVALID_ROLE), m["role_repr"]))
        .when((m["role"] == "system") & (i != 0), F.lit(V.R_SYSTEM_NOT_FIRST))
        .when(m["content_blank"], F.concat(F.lit("turn_"), idx, F.lit(V.R_EMPTY_CONTENT)))
    )


def record_reason(rec: Column) -> Column:
    """First failing rule of an inspected record (null when valid)."""
    turns = rec["turns"]
    first_turn_failure = F.get(F.filter(F.transform(turns, _turn_failure), lambda x: x.isNotNull()), 0)
    roles = F.transform(F.filter(turns, lambda m: m["role"] != "system"), lambda m: m["role"])
    sequence = (
        F.when(F.size(roles) == 0, F.lit(V.R_NO_TURNS))
        .when(F.get(roles, 0) != "user", F.lit(V.R_NOT_USER_FIRST))
        .when(F.array_join(roles, ",").contains("assistant,assistant"), F.lit(V.R_CONSECUTIVE))
    )
    return (
        F.when(rec["json_reason"].isNotNull(), rec["json_reason"])
        .when(~rec["has_messages"], F.lit("missing_messages_key"))
        .when(~rec["messages_is_list"] | (F.size(turns) == 0), F.lit("messages_not_a_nonempty_list"))
        .otherwise(F.coalesce(first_turn_failure, sequence))
    )


def validate_lines(lines: DataFrame, value: str = "value", keep_blank: bool = False) -> DataFrame:
    """Non-blank lines with ``reason`` (null = valid), ``messages`` and a U+FFFD flag
    (invalid UTF-8 byte sequences become U+FFFD instead of failing the job).

    Blank lines (after a Python-style strip) are no records: they are dropped, or with
    ``keep_blank`` stay with all-null verdicts under ``blank`` (their keys still count).
    """
    # Invalid UTF-8 bytes are replaced by U+FFFD natively (and flagged) so that one corrupt
    # line cannot fail the Arrow transfer of its whole batch.
    clean = F.make_valid_utf8(F.col(value))
    stripped = py_strip(clean)
    checked = lines.withColumn("_clean", clean).withColumn("_line", stripped)
    if keep_blank:
        checked = checked.withColumn("_line", F.when(F.col("_line") != "", F.col("_line")))
    else:
        checked = checked.filter(F.col("_line") != "")
    inspected = checked.withColumn("_rec", inspect_records(F.col("_line")))
    messages = F.transform(F.col("_rec.turns"), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    reason = F.when(F.col("_line").isNotNull(), record_reason(F.col("_rec")))
    return inspected.select(
        *[c for c in lines.columns if c != value],
        reason.alias("reason"),
        V.reason_class(reason).alias("reason_class"),
        messages.alias("messages"),
        F.col("_clean").contains("\ufffd").alias("has_replacement_char"),
        *([F.col("_line").isNull().alias("blank")] if keep_blank else []),
    )


def read_json_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lenient scan: lines that parse as JSON (any type), blank and broken lines skipped."""
    return parseable_lines(read_lines(spark, paths))


@F.pandas_udf(T.BooleanType())
def parses(lines: pd.Series) -> pd.Series:
    """Whether each text is one JSON document."""
    return pd.Series([x is not None and _parses(x) for x in lines], dtype=bool)


def _parses(text: str) -> bool:
    try:
        json.loads(text)
    except (ValueError, RecursionError):
        return False
    return True


def parseable_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The rows whose stripped ``value`` is one JSON document: one filter, no join."""
    stripped = py_strip(F.make_valid_utf8(F.col(value)))
    return lines.filter(stripped != "").filter(parses(stripped))
