"""Per-request generation metrics from decoded chunk events (batch form).

The log is read and decoded once. Each ``(request, block of seq)`` is summed up to the
block's own first end marker, and the summary carries that marker; a request's summaries
are then merged in seq order, those after the first marker left out. A hot request is
spread over its blocks. Formulas:

* ``ttft`` = first non-empty delta - start, or ``total`` when no content arrived;
* ``total`` = end-marker arrival (or last line arrival) - start;
* ``tokens_per_second`` = ``eval_count / eval_duration`` when the server reported both
  (non-zero), else ``(tokens - 1) / (total - ttft)`` when ``tokens > 1`` and
  ``total > ttft``, else 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.timecols import epoch_micros
from colloquy.operators.shape import TEXT_BLOCK_ROWS

METRIC_COLUMNS = ("request_id", "text", "ttft_seconds", "total_seconds", "tokens_generated", "tokens_per_second")


def tokens_per_second(tokens, total, ttft, eval_ns=None):
    fallback = F.when((tokens > 1) & (total > ttft), (tokens - 1) / (total - ttft)).otherwise(F.lit(0.0))
    if eval_ns is None:
        return fallback
    server = (eval_ns.isNotNull()) & (eval_ns != 0) & (tokens != 0)
    return F.when(server, tokens / (eval_ns / F.lit(1e9))).otherwise(fallback)


def _block_summaries(decoded: DataFrame, end_inclusive: bool) -> DataFrame:
    """One row per ``(request_id, _blk)``: bounds of all its rows, and the lines up to its first end marker."""
    blk = F.floor(F.col("seq") / F.lit(TEXT_BLOCK_ROWS)).cast("bigint")
    chunk = F.struct("seq", "at_us", "is_line", "is_end", F.coalesce("delta", F.lit("")).alias("delta"), "usage_tokens", "eval_count", "eval_ns")
    rows = decoded.groupBy("request_id", blk.alias("_blk")).agg(
        F.min("at_us").alias("_s"), F.max("at_us").alias("_l"), F.array_sort(F.collect_list(chunk)).alias("_c")
    )
    end = F.get(F.filter("_c", lambda x: x["is_end"]), 0)
    rows = rows.withColumn("_end", F.struct(end["seq"].alias("seq"), end["at_us"].alias("at_us")))
    end_seq = F.col("_end.seq")
    before = (lambda x: x["seq"] <= end_seq) if end_inclusive else (lambda x: x["seq"] < end_seq)
    kept = rows.withColumn("_k", F.filter("_c", lambda x: x["is_line"] & (end_seq.isNull() | before(x))))
    used = F.filter("_k", lambda x: x["usage_tokens"].isNotNull())
    return kept.select(
        "request_id",
        "_blk",
        "_s",
        "_l",
        F.when(end_seq.isNotNull(), F.col("_end")).alias("_end"),
        F.array_min(F.transform(F.filter("_k", lambda x: x["delta"] != ""), lambda x: x["at_us"])).alias("_fu"),
        F.try_element_at(used, F.lit(-1))["usage_tokens"].alias("_u"),
        F.array_max(F.transform("_k", lambda x: x["eval_count"])).alias("_ec"),
        F.array_max(F.transform("_k", lambda x: x["eval_ns"])).alias("_en"),
        F.array_join(F.transform("_k", lambda x: x["delta"]), "").alias("_t"),
    )


def _merged(blocks: DataFrame) -> DataFrame:
    """One row per request: its blocks' summaries in seq order, up to the first that holds an end marker."""
    part = F.struct("_blk", "_s", "_l", "_end", "_fu", "_u", "_ec", "_en", "_t")
    rows = blocks.groupBy("request_id").agg(F.array_sort(F.collect_list(part)).alias("_b"))
    end = F.get(F.filter("_b", lambda x: x["_end"].isNotNull()), 0)
    rows = rows.withColumns({"_last_blk": end["_blk"], "_end_us": end["_end"]["at_us"]})
    kept = rows.withColumn("_k", F.filter("_b", lambda x: F.col("_last_blk").isNull() | (x["_blk"] <= F.col("_last_blk"))))
    each = lambda array, field: F.transform(array, lambda x: x[field])
    return kept.select(
        "request_id",
        F.array_min(each("_b", "_s")).alias("_start_us"),
        F.array_max(each("_b", "_l")).alias("_last_us"),
        "_end_us",
        F.array_min(each("_k", "_fu")).alias("_first_us"),
        F.try_element_at(F.filter(each("_k", "_u"), lambda x: x.isNotNull()), F.lit(-1)).alias("_usage"),
        F.array_max(each("_k", "_ec")).alias("_eval_count"),
        F.array_max(each("_k", "_en")).alias("_eval_ns"),
        F.array_join(each("_k", "_t"), "").alias("text"),
    )


def request_metrics(decoded: DataFrame, end_inclusive: bool, starts: DataFrame | None = None) -> DataFrame:
    """One row per request: ``text, ttft_seconds, total_seconds, tokens_generated, tokens_per_second``.

    ``starts`` optionally supplies ``(request_id, started_at)``; otherwise a request
    starts at its first received line.
    """
    j = _merged(_block_summaries(decoded, end_inclusive))
    if starts is not None:
        s = starts.select("request_id", epoch_micros(starts, "started_at").alias("_s_us"))
        j = j.join(s, "request_id", "left").withColumn("_start_us", F.coalesce(F.col("_s_us"), F.col("_start_us")))
    total = (F.coalesce(F.col("_end_us"), F.col("_last_us")) - F.col("_start_us")) / F.lit(1e6)
    ttft = F.when(F.col("_first_us").isNotNull(), (F.col("_first_us") - F.col("_start_us")) / F.lit(1e6)).otherwise(total)
    tokens = F.coalesce(F.col("_eval_count"), F.col("_usage"), F.lit(0)).cast("bigint")
    out = j.select(
        "request_id",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ttft.alias("ttft_seconds"),
        total.alias("total_seconds"),
        tokens.alias("tokens_generated"),
        "_eval_ns",
    )
    tps = tokens_per_second(
        F.col("tokens_generated"), F.col("total_seconds"), F.col("ttft_seconds"), F.col("_eval_ns")
    )
    return out.withColumn("tokens_per_second", tps.cast("double")).drop("_eval_ns")


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Run summary; an empty input gives an empty result."""
    return (
        metrics.groupBy()
        .agg(
            F.count(F.lit(1)).alias("num_queries"),
            F.avg("ttft_seconds").alias("avg_ttft_seconds"),
            F.avg("total_seconds").alias("avg_total_seconds"),
            F.avg("tokens_per_second").alias("avg_tokens_per_second"),
            F.sum("tokens_generated").alias("total_tokens_generated"),
        )
        .filter(F.col("num_queries") > 0)
    )


def cumulative_to_delta(steps: DataFrame, key: str = "request_id", index: str = "token_index", text: str = "text",
                        block_rows: int = 1024) -> DataFrame:
    """Turn cumulative decoded text per step into per-step deltas (empty steps kept).

    ``delta`` = the text minus the previous step's text length. The previous step comes
    from a window inside ``(key, index div block_rows)`` blocks; the first step of a
    block takes the last text of the preceding block from a one-row-per-block table.
    """
    from pyspark.sql import Window

    blk = F.floor(F.col(index) / F.lit(block_rows)).cast("bigint")
    s = steps.withColumn("_blk", blk)
    prev_in_block = F.lag(text).over(Window.partitionBy(key, "_blk").orderBy(index))
    s = s.withColumn("_prev", prev_in_block)
    last = s.groupBy(key, "_blk").agg(F.max_by(F.length(text), F.col(index)).alias("_last_len"))
    last = last.select(
        key, "_blk", F.lag("_last_len").over(Window.partitionBy(key).orderBy("_blk")).alias("_prev_block_len")
    )
    j = s.join(last, [key, "_blk"])
    prev_len = F.coalesce(F.length("_prev"), F.col("_prev_block_len"), F.lit(0))
    return j.withColumn("delta", F.substr(F.col(text), prev_len + 1)).drop("_blk", "_prev", "_prev_block_len")
