"""Streaming conversation intake and streaming training-metric rates.

* ``intake``: new JSONL files in a folder are validated with the same Columns as the
  batch lane; every micro-batch writes valid rows and the quarantine (with reasons)
  to two parquet tables, one ``batch_id=`` folder per batch (replays overwrite).
* ``throughput_stream``: trainer log rows arriving as a stream are turned into
  examples/s, tokens/s and ETA (start times from a static run table), plus a
  watermarked tumbling-window rate of logged steps.
* ``on_each_batch``: hands every micro-batch of results to a callback in arrival
  order (the per-result hook of long benchmark runs).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.timecols import epoch_micros
from colloquy.operators.metrics import ThroughputPlan
from colloquy.session import checkpoint_dir
from colloquy.sources.jsonl import validate_lines


def intake(spark: SparkSession, folder: str, valid_path: str, quarantine_path: str, name: str,
           max_files_per_trigger: int = 100) -> None:
    """Validate a stream of JSONL files into a valid table and a quarantine table."""
    stream = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(folder)
    lines = stream.select(F.col("_metadata.file_path").alias("file"), "value")
    checked = validate_lines(lines)

    def route(batch: DataFrame, batch_id: int) -> None:
        # One folder per micro-batch, overwritten: a replayed batch replaces its own output
        # instead of appending duplicates (idempotent under task or driver retries).
        batch.persist()
        batch.filter(F.col("reason").isNull()).select("file", "messages").write.mode("overwrite").parquet(
            f"{valid_path.rstrip('/')}/batch_id={batch_id}"
        )
        batch.filter(F.col("reason").isNotNull()).select("file", "reason").write.mode("overwrite").parquet(
            f"{quarantine_path.rstrip('/')}/batch_id={batch_id}"
        )
        batch.unpersist()

    q = (
        checked.writeStream.foreachBatch(route)
        .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def throughput_stream(logs: DataFrame, starts: DataFrame, plan: ThroughputPlan = ThroughputPlan()) -> DataFrame:
    """Per log row: elapsed, examples/s, tokens/s, ETA (stream-static join on run id)."""
    s = starts.select("run_id", epoch_micros(starts, "started_at").alias("_t0"))
    j = logs.filter(F.col("step") > 0).join(s, "run_id")
    elapsed = (epoch_micros(logs, "ts") - F.col("_t0")) / F.lit(1e6)
    ex_rate = F.col("step") * F.lit(plan.batch_size * plan.gradient_accumulation) / F.greatest(elapsed, F.lit(1e-6))
    eta = ((F.lit(plan.max_steps) - F.col("step")) * (elapsed / F.col("step"))) if plan.max_steps else F.lit(0.0)
    return j.select(
        "run_id", "step", "ts", elapsed.alias("elapsed_seconds"), ex_rate.alias("examples_per_sec"),
        (ex_rate * F.lit(float(plan.max_length))).alias("tokens_per_sec"), eta.cast("double").alias("eta_seconds"),
    )


def windowed_step_rate(logs: DataFrame, window: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Logged steps per run and event-time window; late rows beyond ``delay`` are dropped."""
    return (
        logs.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .groupBy("run_id", F.window("ts", window))
        .agg(F.count(F.lit(1)).alias("n_logs"), F.max("step").alias("max_step"))
    )


def on_each_batch(results: DataFrame, callback: Callable[[DataFrame, int], None], name: str) -> None:
    """Call ``callback(batch, batch_id)`` for every micro-batch, in order, until the input is drained."""
    spark = results.sparkSession
    q = (
        results.writeStream.foreachBatch(callback)
        .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
