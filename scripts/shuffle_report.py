"""Per-query wall time, shuffle bytes and input rows from Spark's event log.

Usage: python scripts/shuffle_report.py [sf_dir] [query ...]
Writes the event log into a fresh scratch folder, runs each query once into the
``noop`` sink under its own job group, then sums task shuffle-write bytes per group.
Prints a markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import bench  # noqa: E402
from colloquy.plans import suite  # noqa: E402

INPUTS = {  # main input table of each query (rows are read from the parquet footer)
    "orders": ("parse_replies", "pass_accuracy", "reply_scores", "latest_synced_run", "inherit_manifest"),
    "lineitem": ("latest_checkpoint", "stale_checkpoints"),
    "events": ("robustness", "robustness_summary", "request_metrics", "ndjson_metrics", "stream_request_metrics",
               "metric_summary", "throughput_eta"),
    "documents": ("doc_packing", "doc_token_stats"),
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or bench.HEADLINE
    logdir = tempfile.mkdtemp(prefix="colloquy-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logdir)
        .config("spark.eventLog.compress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    import pyarrow.parquet as pq

    table_rows = {t: pq.ParquetFile(f"{sf}/{t}.parquet").metadata.num_rows for t in
                  ("conversations", "orders", "lineitem", "events", "documents")}
    wall = {}
    for name in names:
        spark.sparkContext.setJobGroup("warm-up", "warm-up")
        suite.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        suite.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        wall[name] = time.perf_counter() - t0
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()
    stage_group, shuffle = {}, {}
    for path in [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    g = stage_group.get(ev.get("Stage ID"))
                    if g:
                        shuffle[g] = shuffle.get(g, 0) + m.get("Shuffle Bytes Written", 0)
    print("| query | wall s | input table | input rows | rows/s | shuffle bytes |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name in names:
        table = next((t for t, qs in INPUTS.items() if name in qs), "conversations")
        rows = table_rows[table]
        print(f"| {name} | {wall[name]:.2f} | {table} | {rows:,} | {rows / wall[name]:,.0f} | {shuffle.get(name, 0):,} |")


if __name__ == "__main__":
    main()
