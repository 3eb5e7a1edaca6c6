"""Sinks: JSONL tables, prediction exports, one-document reports, metric series.

All writes are distributed (one file per partition); reports are one-row frames.
Nulls are written as ``null`` rather than dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    w = df.write.mode(mode).option("ignoreNullFields", False)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def export_predictions(predictions: DataFrame, run_dir: str, source: str | None) -> str:
    """``<run_dir>/predictions/<source>_predictions`` as JSONL part files; returns the folder."""
    path = f"{run_dir.rstrip('/')}/predictions/{source or 'none'}_predictions"
    write_jsonl(predictions, path)
    return path


def write_report(report: DataFrame, path: str) -> None:
    """One JSON document per row (reports are one-row frames)."""
    report.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def append_series(series: DataFrame, table_path: str) -> None:
    """Append metric points ``(run_id, step, metric, value)`` to a parquet series table."""
    series.select("run_id", "step", "metric", "value").write.mode("append").partitionBy("run_id").parquet(table_path)
