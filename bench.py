"""Headline-query benchmark.

Runs the registered headline queries on ``$BENCH_SF_DIR`` (default sf0.1) with
``local[$BENCH_CPUS]``; each query is executed in full into the ``noop`` sink, one
warm-up then the median of ``$BENCH_REPS`` (default 3) timed runs. Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from colloquy.plans import suite  # noqa: E402
from colloquy.session import get_spark  # noqa: E402

HEADLINE = [
    "validate_turns",
    "validate_summary",
    "dataset_stats",
    "token_histogram",
    "flatten_text",
    "response_spans",
    "wrapped_packing",
    "doc_packing",
    "parse_replies",
    "pass_accuracy",
    "reply_scores",
    "robustness",
    "robustness_summary",
    "request_metrics",
    "ndjson_metrics",
    "stream_request_metrics",
    "jsonl_validate",
    "doc_token_stats",
    "generate_eval",
    "latest_checkpoint",
    "stale_checkpoints",
    "metric_summary",
    "throughput_eta",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_spark(cpus=cpus, app="colloquy-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    names = [n for n in HEADLINE if n in suite.QUERIES] + [
        n for n in os.environ.get("BENCH_EXTRA", "").split(",") if n in suite.QUERIES
    ]
    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = suite.QUERIES[name]
        runs = []
        try:
            for i in range(reps + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    runs.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # noqa: BLE001 - report and keep benchmarking the rest
            timings[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total_median",
                "value": round(sum(v for v in timings.values() if v is not None), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "reps": reps,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
