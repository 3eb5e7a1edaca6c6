"""Decode captured generation streams into typed chunk events.

Input: a chunk log ``(request_id, seq, arrived_at TIMESTAMP, line STRING)``, one row
per received line, ``seq`` the arrival order inside the request. Two wire formats:

* SSE: keep lines starting ``data: ``; ``[DONE]`` ends the stream (later lines are
  ignored); delta = ``choices[0].delta.content``; ``usage.completion_tokens`` is the
  token count, the last one seen wins.
* NDJSON: every non-blank line is a JSON object; delta = ``message.content``; the
  first line with a truthy ``done`` ends the stream and is itself included; its
  ``eval_count`` / ``eval_duration`` (ns) are the server-side counts.

JSON fields are read with ``get_json_object`` (JVM, no Python); a malformed payload
yields no delta instead of aborting the whole request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import py_strip
from colloquy.functions.timecols import epoch_micros

SSE_PREFIX = "data: "
SSE_DONE = "[DONE]"

DECODED_COLUMNS = ("request_id", "seq", "at_us", "is_line", "is_end", "delta", "usage_tokens", "eval_count", "eval_ns")


def decode_sse(log: DataFrame) -> DataFrame:
    line = py_strip(F.col("line"))
    is_data = line.startswith(SSE_PREFIX)
    payload = F.substr(line, F.lit(len(SSE_PREFIX) + 1))
    is_end = is_data & (payload == SSE_DONE)
    return log.select(
        "request_id",
        F.col("seq").cast("bigint").alias("seq"),
        epoch_micros(log, "arrived_at").alias("at_us"),
        is_data.alias("is_line"),
        is_end.alias("is_end"),
        F.when(is_data & ~is_end, F.get_json_object(payload, "$.choices[0].delta.content")).alias("delta"),
        F.when(is_data & ~is_end, F.get_json_object(payload, "$.usage.completion_tokens").cast("bigint")).alias(
            "usage_tokens"
        ),
        F.lit(None).cast("bigint").alias("eval_count"),
        F.lit(None).cast("bigint").alias("eval_ns"),
    )


def decode_ndjson(log: DataFrame) -> DataFrame:
    line = py_strip(F.col("line"))
    is_line = line != ""
    # Python truthiness of the JSON value: false, 0, "", [], {} and null do not end the stream.
    done_raw = F.get_json_object(line, "$.done")
    done = done_raw.isNotNull() & ~done_raw.isin("false", "0", "0.0", "-0", "", "[]", "{}")
    return log.select(
        "request_id",
        F.col("seq").cast("bigint").alias("seq"),
        epoch_micros(log, "arrived_at").alias("at_us"),
        is_line.alias("is_line"),
        (is_line & done).alias("is_end"),
        F.when(is_line, F.get_json_object(line, "$.message.content")).alias("delta"),
        F.lit(None).cast("bigint").alias("usage_tokens"),
        F.when(done, F.get_json_object(line, "$.eval_count").cast("bigint")).alias("eval_count"),
        F.when(done, F.get_json_object(line, "$.eval_duration").cast("bigint")).alias("eval_ns"),
    )
