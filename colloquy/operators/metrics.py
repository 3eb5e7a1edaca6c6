"""Training metric series: key naming, every-N sampling, summaries, throughput and ETA.

The series is a long table ``(run_id, step, key, value)``; logs arrive as
``(run_id, step, ts, key, value)`` rows with the raw trainer names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.timecols import epoch_micros

# Trainer log keys forwarded under train/, and the eval prefix rule.
TRAIN_KEYS = ("loss", "learning_rate", "grad_norm", "epoch")
EVAL_PREFIX = "eval_"
DEVICE_KEYS = ("memory_used_gb", "memory_reserved_gb", "memory_total_gb", "utilization_pct")
PROGRESS_KEYS = ("examples_per_sec", "tokens_per_sec", "eta_seconds", "epoch", "step")


def series_key(raw_key: Column, source: Column) -> Column:
    """Metric name: ``train/<k>`` for the four trainer keys, ``eval/<k minus eval_>`` for eval
    logs, ``gpu/<k>`` and ``system/<k>`` for device and progress figures."""
    train = F.when(raw_key.isin(*TRAIN_KEYS), F.concat(F.lit("train/"), raw_key))
    evaluation = F.concat(
        F.lit("eval/"), F.when(raw_key.startswith(EVAL_PREFIX), F.substr(raw_key, F.lit(len(EVAL_PREFIX) + 1))).otherwise(raw_key)
    )
    out = F.when(source == "train", train).when(source == "eval", evaluation)
    for name, keys in (("gpu", DEVICE_KEYS), ("system", PROGRESS_KEYS)):
        out = out.when(source == name, F.when(raw_key.isin(*keys), F.concat(F.lit(f"{name}/"), raw_key)))
    return out


def to_series(logs: DataFrame, source: str = "source", key: str = "key") -> DataFrame:
    """Renamed long series; rows whose key is not forwarded (or whose value is null) drop out."""
    name = series_key(F.col(key), F.col(source))
    return logs.withColumn("metric", name).filter(F.col("metric").isNotNull() & F.col("value").isNotNull())


def scalar_metadata(meta: DataFrame, run: str = "run_id") -> DataFrame:
    """``run/<k>`` rows for scalar metadata values at step 0 (``meta``: run, k, kind, value)."""
    scalar = F.col("kind").isin("str", "int", "float", "bool")
    return meta.filter(scalar).select(run, F.lit(0).cast("bigint").alias("step"),
                                      F.concat(F.lit("run/"), F.col("k")).alias("metric"), "value")


def every_n(series: DataFrame, n: int, step: str = "step") -> DataFrame:
    """Rows on every n-th step (n floored at 1) — periodic sampling."""
    return series.filter(F.col(step) % F.lit(max(int(n), 1)) == 0)


def summary(series: DataFrame, run: str = "run_id", metric: str = "metric", step: str = "step") -> DataFrame:
    """Last value per (run, metric) by step, kept apart from the series."""
    return series.groupBy(run, metric).agg(
        F.max_by("value", step).alias("last_value"), F.max(step).alias("last_step"), F.count(F.lit(1)).alias("n_points")
    )


@dataclass(frozen=True)
class ThroughputPlan:
    batch_size: int = 1
    gradient_accumulation: int = 16
    max_length: int = 1536
    max_steps: int | None = None


def throughput(logs: DataFrame, plan: ThroughputPlan = ThroughputPlan(), run: str = "run_id", step: str = "step",
               ts: str = "ts") -> DataFrame:
    """Examples/s, tokens/s and ETA at every logged step after step 0.

    The run start is the earliest log time of the run (a splittable ``min`` joined back).
    """
    us = epoch_micros(logs, ts)
    start = logs.groupBy(run).agg(F.min(us).alias("_t0"))
    j = logs.filter(F.col(step) > 0).join(start, run)
    elapsed = (us - F.col("_t0")) / F.lit(1e6)
    eff = plan.batch_size * plan.gradient_accumulation
    examples = F.col(step) * F.lit(eff)
    ex_rate = examples / F.greatest(elapsed, F.lit(1e-6))
    if plan.max_steps and plan.max_steps > 0:
        eta = (F.lit(plan.max_steps) - F.col(step)) * (elapsed / F.col(step))
    else:
        eta = F.lit(0.0)
    return j.select(
        run,
        step,
        elapsed.alias("elapsed_seconds"),
        ex_rate.alias("examples_per_sec"),
        (ex_rate * F.lit(float(plan.max_length or 0))).alias("tokens_per_sec"),
        eta.cast("double").alias("eta_seconds"),
    )
