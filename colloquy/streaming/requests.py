"""Streaming generation telemetry and result logs.

Three streaming forms of the per-request metrics:

* ``request_sessions`` (long-running streams): ``transformWithState`` with list and value
  state and event-time timers. A request is emitted once the watermark has passed its last
  chunk, so chunks may come in any order; state is bounded by the requests not yet passed.

* ``request_metrics_stateful`` (long-running streams): ``applyInPandasWithState`` with
  event-time timeouts. A request is emitted when its end marker arrives and its state
  is dropped; abandoned requests are emitted when the watermark passes them; chunks
  older than the watermark are dropped. State is bounded by the open requests.
* ``request_metrics_single_pass`` (finite replays): one grouped aggregate of compact
  chunk records per request, run in ``complete`` mode through ``foreachBatch`` so an
  ``availableNow`` run emits every request, including those without an end marker.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from colloquy.operators.telemetry import tokens_per_second
from colloquy.session import checkpoint_dir


def request_metrics_single_pass(decoded: DataFrame, end_inclusive: bool) -> DataFrame:
    """Same result as ``operators.telemetry.request_metrics`` from one grouped aggregate."""
    chunk = F.struct("seq", "at_us", "is_line", "is_end", "delta", "usage_tokens", "eval_count", "eval_ns")
    agg = decoded.groupBy("request_id").agg(F.collect_list(chunk).alias("_c"))
    arr = F.array_sort(F.col("_c"))
    ends = F.filter(arr, lambda x: x["is_end"])
    end_seq = F.get(ends, 0)["seq"]
    end_us = F.get(ends, 0)["at_us"]
    start_us = F.array_min(F.transform(arr, lambda x: x["at_us"]))
    last_us = F.array_max(F.transform(arr, lambda x: x["at_us"]))

    def keep(x):
        before = (x["seq"] <= end_seq) if end_inclusive else (x["seq"] < end_seq)
        return x["is_line"] & (end_seq.isNull() | before)

    staged = agg.select(
        "request_id",
        F.filter(arr, keep).alias("_k"),
        start_us.alias("_s"),
        F.coalesce(end_us, last_us).alias("_e"),
    )
    k = F.col("_k")
    content = F.filter(k, lambda x: F.coalesce(x["delta"], F.lit("")) != "")
    usage = F.filter(k, lambda x: x["usage_tokens"].isNotNull())
    first_us = F.array_min(F.transform(content, lambda x: x["at_us"]))
    total = (F.col("_e") - F.col("_s")) / F.lit(1e6)
    ttft = F.when(first_us.isNotNull(), (first_us - F.col("_s")) / F.lit(1e6)).otherwise(total)
    tokens = F.coalesce(
        F.array_max(F.transform(k, lambda x: x["eval_count"])), F.try_element_at(usage, F.lit(-1))["usage_tokens"], F.lit(0)
    ).cast("bigint")
    out = staged.select(
        "request_id",
        F.array_join(F.transform(k, lambda x: F.coalesce(x["delta"], F.lit(""))), "").alias("text"),
        ttft.alias("ttft_seconds"),
        total.alias("total_seconds"),
        tokens.alias("tokens_generated"),
        F.array_max(F.transform(k, lambda x: x["eval_ns"])).alias("_eval_ns"),
    )
    tps = tokens_per_second(F.col("tokens_generated"), F.col("total_seconds"), F.col("ttft_seconds"), F.col("_eval_ns"))
    return out.withColumn("tokens_per_second", tps.cast("double")).drop("_eval_ns")


def run_complete_to_table(stream: DataFrame, out_path: str, name: str,
                          transform: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Run a streaming aggregate to completion (``availableNow``); the latest full result is
    written to ``out_path`` as parquet on every micro-batch. Returns ``out_path``."""
    spark = stream.sparkSession
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def write(batch: DataFrame, epoch: int) -> None:
        frame = transform(batch) if transform else batch
        frame.write.mode("overwrite").parquet(out_path)

    q = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return out_path


def append_results(stream: DataFrame, out_path: str, name: str) -> DataFrame:
    """Durable append-as-produced result log (file sink, exactly-once via checkpoint)."""
    spark = stream.sparkSession
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    q = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(out_path)


# ---------------------------------------------------------------------------
# Stateful form: emit a request when its end marker arrives, then drop its state.
# ---------------------------------------------------------------------------
METRICS_SCHEMA = (
    "request_id string, text string, ttft_seconds double, total_seconds double, "
    "tokens_generated long, tokens_per_second double, ended boolean"
)
_CHUNK_FIELDS = ("seq", "at_us", "is_line", "is_end", "delta", "usage_tokens", "eval_count", "eval_ns")
_STATE_SCHEMA = (
    "ended boolean, seq array<long>, at_us array<long>, is_line array<boolean>, is_end array<boolean>, "
    "delta array<string>, usage_tokens array<long>, eval_count array<long>, eval_ns array<long>"
)


def _metrics_from_chunks(request_id, chunks, end_inclusive: bool, ended: bool) -> dict:
    """Metric formulas of one request from its chunk records (pandas frame, any order)."""
    import math

    c = chunks.sort_values("seq")
    start, last = int(c["at_us"].min()), int(c["at_us"].max())
    ends = c[c["is_end"].fillna(False).astype(bool)]
    end_seq = None if ends.empty else int(ends["seq"].iloc[0])
    end_us = None if ends.empty else int(ends["at_us"].iloc[0])
    keep = c["is_line"].fillna(False).astype(bool)
    if end_seq is not None:
        keep &= (c["seq"] <= end_seq) if end_inclusive else (c["seq"] < end_seq)
    k = c[keep]
    delta = k["delta"].where(k["delta"].notna(), "")
    total = ((end_us if end_us is not None else last) - start) / 1e6
    content = k[delta != ""]
    ttft = (int(content["at_us"].iloc[0]) - start) / 1e6 if not content.empty else total
    evals = k["eval_count"].dropna()
    usage = k["usage_tokens"].dropna()
    tokens = int(evals.max()) if not evals.empty else (int(usage.iloc[-1]) if not usage.empty else 0)
    eval_ns = k["eval_ns"].dropna()
    ens = int(eval_ns.max()) if not eval_ns.empty else None
    if ens and tokens:
        tps = tokens / (ens / 1e9)
    elif tokens > 1 and total > ttft:
        tps = (tokens - 1) / (total - ttft)
    else:
        tps = 0.0
    return {"request_id": request_id, "text": "".join(delta.tolist()), "ttft_seconds": ttft,
            "total_seconds": total, "tokens_generated": tokens, "tokens_per_second": float(tps) if not math.isnan(tps) else 0.0,
            "ended": ended}


def request_metrics_stateful(decoded: DataFrame, end_inclusive: bool, delay_ms: int = 600_000) -> DataFrame:
    """Append-mode stream of per-request metrics with bounded state (event-time timeouts).

    Chunks are watermarked on their arrival time with ``delay_ms`` of allowed lateness
    (older chunks are dropped). State per request holds its chunk records until the end
    marker arrives; the row is then emitted (``ended`` true) and the state shrinks to a
    tombstone that swallows late lines until the watermark passes it. A request that
    never ends is emitted with ``ended`` false once the watermark passes its last chunk
    plus the delay (time to first token = total when no content arrived).
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, batches, state):
        (request_id,) = key
        if state.hasTimedOut:
            stored = state.get
            state.remove()
            if not stored[0]:
                chunks = pd.DataFrame({f: list(stored[i + 1]) for i, f in enumerate(_CHUNK_FIELDS)})
                yield pd.DataFrame([_metrics_from_chunks(request_id, chunks, end_inclusive, False)])
            return
        new = pd.concat([b[list(_CHUNK_FIELDS)] for b in batches], ignore_index=True)
        deadline = int(new["at_us"].max() // 1000) + delay_ms
        if state.exists:
            stored = state.get
            if stored[0]:  # already emitted: late lines are ignored
                state.setTimeoutTimestamp(max(deadline, state.getCurrentWatermarkMs() + 1))
                return
            old = pd.DataFrame({f: list(stored[i + 1]) for i, f in enumerate(_CHUNK_FIELDS)})
            new = pd.concat([old, new], ignore_index=True)
            deadline = int(new["at_us"].max() // 1000) + delay_ms
        deadline = max(deadline, state.getCurrentWatermarkMs() + 1)
        if new["is_end"].fillna(False).astype(bool).any():
            state.update((True, [], [], [], [], [], [], [], []))
            state.setTimeoutTimestamp(deadline)
            yield pd.DataFrame([_metrics_from_chunks(request_id, new, end_inclusive, True)])
            return
        state.update((False, *[[None if pd.isna(v) else v for v in new[f].tolist()] for f in _CHUNK_FIELDS]))
        state.setTimeoutTimestamp(deadline)

    watermarked = decoded.withColumn("_event_ts", F.timestamp_micros("at_us")).withWatermark(
        "_event_ts", f"{int(delay_ms)} milliseconds"
    )
    return watermarked.groupBy("request_id").applyInPandasWithState(
        step, METRICS_SCHEMA, _STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
    )


# ---------------------------------------------------------------------------
# Sessions: list and value state with timers (transformWithState).
# ---------------------------------------------------------------------------
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def chunk_metrics(chunks: list[tuple], end_inclusive: bool) -> tuple:
    """``(text, ttft, total, tokens, tokens per second, ended)`` of one request's chunks, in any order."""
    chunks = sorted(chunks, key=lambda c: c[0])
    start, last = min(c[1] for c in chunks), max(c[1] for c in chunks)
    end = next((c for c in chunks if c[3]), None)
    kept = [c for c in chunks if c[2] and (end is None or c[0] < end[0] or (end_inclusive and c[0] == end[0]))]
    total = ((end[1] if end else last) - start) / 1e6
    first = min((c[1] for c in kept if c[4]), default=None)
    ttft = total if first is None else (first - start) / 1e6
    counted = [c[6] for c in kept if c[6] is not None]
    used = [c[5] for c in kept if c[5] is not None]
    tokens = max(counted) if counted else used[-1] if used else 0
    spent = max((c[7] for c in kept if c[7] is not None), default=0)
    if spent and tokens:
        speed = tokens / (spent / 1e9)
    else:
        speed = (tokens - 1) / (total - ttft) if tokens > 1 and total > ttft else 0.0
    return "".join(c[4] or "" for c in kept), ttft, total, tokens, float(speed), end is not None


class RequestSessions(StatefulProcessor):
    """Holds the chunks of a bucket of requests (list state) and when to look at them again (value state, timer).

    State calls go to the JVM one by one, so the requests of a bucket share them: a batch's
    chunks are one list element. A request is due at its last chunk; an open one gets
    ``idle_ms`` more. When the watermark passes that no earlier chunk can come any more, so
    the row is emitted and the chunks are dropped. A marker stays ``idle_ms`` longer and
    swallows stragglers. The bucket's timer stands at or before the first of these times.
    """

    def __init__(self, end_inclusive: bool, idle_ms: int):
        self.end_inclusive, self.idle_ms = end_inclusive, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        # JSON lists: [request_id, watermark at arrival, chunk fields...] or, for a marker, [request_id, until]
        self.rows = handle.getListState("rows", "body string")
        self.timer = handle.getValueState("timer", "at_ms long")

    def _wake(self, at: int, known: int | None) -> None:
        self.handle.registerTimer(at)
        if at != known:
            self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentWatermarkInMs()
        new, last = [], {}
        for r in rows:
            rid = r["request_id"]
            new.append([rid, now, *(r[f] for f in _CHUNK_FIELDS)])
            last[rid] = max(last.get(rid, r["at_us"]), r["at_us"])
        self.rows.appendValue((json.dumps(new),))
        at = max(min(last.values()) // 1000 + 1, now + 1)  # no request of these is due earlier
        got = self.timer.get()
        known = got[0] if got is not None else None
        if known is None or at < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self._wake(at, known)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        past = max(now - 1, expiredTimerInfo.getExpiryTimeInMs())
        markers: dict[str | None, int] = {}
        held: dict[str | None, list[list]] = {}
        changed = False
        for (body,) in self.rows.get():
            for row in json.loads(body):
                if len(row) == 2:
                    markers[row[0]] = row[1]
                elif row[0] in markers:
                    changed = True  # a straggler
                else:
                    held.setdefault(row[0], []).append(row)
        for rid in [r for r, until in markers.items() if until <= past]:
            del markers[rid]
            changed = True
        first: list[int] = []
        for rid, chunks in list(held.items()):
            ended = any(c[5] for c in chunks)
            due = max(max(c[3] for c in chunks) // 1000 + 1 + (0 if ended else self.idle_ms), max(c[1] for c in chunks) + 1)
            if due > past:
                first.append(due)
                continue
            found = chunk_metrics([tuple(c[2:]) for c in chunks], self.end_inclusive)
            del held[rid]
            markers[rid] = now + self.idle_ms
            changed = True
            yield Row(request_id=rid, text=found[0], ttft_seconds=found[1], total_seconds=found[2],
                      tokens_generated=found[3], tokens_per_second=found[4], ended=found[5])
        left = [[rid, until] for rid, until in markers.items()]
        for chunks in held.values():
            left += chunks
        if not left:
            self.rows.clear()
            self.timer.clear()
            return
        if changed:
            self.rows.put([(json.dumps(left),)])
        self._wake(min([*first, *markers.values()]), None)

    def close(self) -> None:
        pass


def request_sessions(decoded: DataFrame, end_inclusive: bool, delay_ms: int = 600_000, idle_ms: int = 600_000, buckets: int = 4096) -> DataFrame:
    """Append-mode stream of request metrics, equal to the batch form for chunks up to ``delay_ms`` late.

    State is bounded by the requests whose last chunk the watermark has not passed; it is
    kept by ``buckets`` hash buckets of requests, and one bucket's open chunks are in memory
    at once. It needs the RocksDB state store (``with_rocksdb``). Chunks older than the
    watermark are dropped.
    """
    timed = decoded.withColumn("_event_ts", F.timestamp_micros("at_us")).withWatermark("_event_ts", f"{int(delay_ms)} milliseconds")
    bucket = F.pmod(F.xxhash64("request_id"), F.lit(buckets)).cast("int").alias("bucket")
    return timed.select(bucket, "request_id", *_CHUNK_FIELDS, "_event_ts").groupBy("bucket").transformWithState(
        statefulProcessor=RequestSessions(end_inclusive, idle_ms), outputStructType=METRICS_SCHEMA, outputMode="Append", timeMode="EventTime"
    )


@contextmanager
def with_rocksdb(spark: SparkSession):
    """The session starts streams on the RocksDB state store inside this block."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# ---------------------------------------------------------------------------
# Result log with committed batches.
# ---------------------------------------------------------------------------
def commit_batch(batch: DataFrame, path: str, query: str, batch_id: int) -> None:
    """Write one micro-batch under ``(query, batch id)``, then commit it.

    A replay overwrites its own folder, so it adds nothing; a batch whose write broke off
    has no commit and is not read.
    """
    root = path.rstrip("/")
    batch.write.mode("overwrite").parquet(f"{root}/data/query={query}/batch={batch_id}")
    done = batch.sparkSession.range(1).select(F.lit(query).alias("query"), F.lit(batch_id).cast("long").alias("batch"))
    done.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/{query}-{batch_id}")


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of committed batches; readable at any time of a run."""
    root = path.rstrip("/")
    keyed = T.StructType([*schema.fields, T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())])
    rows = spark.read.schema(keyed).option("basePath", f"{root}/data").parquet(f"{root}/data")
    commits = spark.read.schema("query string, batch long").option("recursiveFileLookup", True).parquet(f"{root}/commits")
    return rows.join(commits.distinct(), ["query", "batch"], "left_semi").drop("query", "batch")


def results_once(stream: DataFrame, path: str, query: str) -> DataFrame:
    """Run ``stream`` to the end of its input into the committed log at ``path``; returns the log's rows."""
    ckpt = f"{checkpoint_dir(stream.sparkSession).rstrip('/')}/streams/{query}"
    schema = stream.schema
    write = lambda batch, batch_id: commit_batch(batch, path, query, batch_id)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return read_committed(stream.sparkSession, path, schema)
