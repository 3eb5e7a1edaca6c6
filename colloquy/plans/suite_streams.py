"""Registered streaming queries: events arrive in waves, out of order, and end with a heartbeat.

A wave is one micro-batch. Six days of event time make a wave, and each fifth event comes
one wave late. Importing this module adds its queries to ``suite.QUERIES`` and ``suite.ORACLE``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import telemetry
from colloquy.plans import fixtures as fx
from colloquy.plans.suite import _SSE_ORACLE, _rounded_metrics, _VALIDATE_ORACLE, defect_turns, register
from colloquy.session import checkpoint_dir
from colloquy.sources.conversations import assemble_messages, read_table
from colloquy.sources.telemetry import decode_sse
from colloquy.streaming import intake, requests

WAVES = 6
#: Wave of an event; the same text on both sides.
WAVE_SQL = "CAST(least(greatest(floor((day(ts) - 1) / 6), 0), 4) AS INT) + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END"
HEARTBEAT = "2100-01-01 00:00:00"


def in_waves(spark: SparkSession, rows: DataFrame, heartbeat: DataFrame | None, name: str, start: Callable[[DataFrame, str], None]) -> str:
    """Feeds ``rows`` (with a column ``wave``) wave by wave to the stream that ``start`` runs to its end.

    ``start(stream, folder)`` is called after each wave with the same folder, so a query
    with a checkpoint there goes on where it stopped. Returns the folder.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/waves/{name}-{uuid.uuid4().hex}"
    schema = rows.drop("wave").schema
    for wave in range(WAVES):
        rows.where(F.col("wave") == wave).drop("wave").write.mode("append").parquet(f"{folder}/in")
        start(spark.readStream.schema(schema).parquet(f"{folder}/in"), folder)
    if heartbeat is not None:
        heartbeat.select(*schema.names).write.mode("append").parquet(f"{folder}/in")
        start(spark.readStream.schema(schema).parquet(f"{folder}/in"), folder)
    return folder


def to_table(out: DataFrame, folder: str) -> None:
    """Appends a stream's rows to ``folder/out`` until its input is drained."""
    query = (
        out.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _chunks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    log = read_table(spark, sf, "events").selectExpr(
        f"{fx.REQUEST_SQL} AS request_id", "event_id AS seq", "CAST(ts AS TIMESTAMP) AS arrived_at", f"{fx.SSE_LINE_SQL} AS line", f"{WAVE_SQL} AS wave"
    )
    beat = spark.range(1).selectExpr("'' AS request_id", "-1L AS seq", f"CAST('{HEARTBEAT}' AS TIMESTAMP) AS arrived_at", "'' AS line")
    return log, beat


@register(
    "stream_request_sessions",
    _SSE_ORACLE + """SELECT request_id, text, ttft_seconds, total_seconds, tokens_generated, tokens_per_second,
      (SELECT bool_or(is_end) FROM d2 WHERE d2.rid = request_id) AS ended FROM mt""",
)
def q_stream_request_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """List state and timers over out-of-order chunks; open requests come with ``ended`` false.

    Thirteen days of lateness cover the waves, so each request equals the batch form.
    """
    log, beat = _chunks(spark, sf)
    day = 86_400_000

    def start(stream: DataFrame, folder: str) -> None:
        to_table(requests.request_sessions(decode_sse(stream), end_inclusive=False, delay_ms=13 * day, idle_ms=day), folder)

    with requests.with_rocksdb(spark):
        folder = in_waves(spark, log, beat, "sessions", start)
    found = spark.read.parquet(f"{folder}/out").where("request_id <> ''")
    return _rounded_metrics(found.drop("ended")).join(found.select("request_id", "ended"), "request_id")


@register(
    "stream_result_log",
    _SSE_ORACLE + """SELECT request_id, text, tokens_generated FROM mt""",
)
def q_stream_result_log(spark: SparkSession, sf: str) -> DataFrame:
    """Results appended wave by wave; one wave is replayed and a broken write is left behind, and neither shows."""
    log, _ = _chunks(spark, sf)
    metrics = telemetry.request_metrics(decode_sse(log.drop("wave")), end_inclusive=False)
    results = metrics.select("request_id", "text", "tokens_generated").withColumn("wave", F.pmod(F.xxhash64("request_id"), F.lit(WAVES)).cast("int"))
    again: list[DataFrame] = []

    def start(stream: DataFrame, folder: str) -> None:
        def write(batch: DataFrame, batch_id: int) -> None:
            requests.commit_batch(batch, f"{folder}/log", "results", batch_id)
            if batch_id == 1:  # the same batch once more, as after a lost driver
                requests.commit_batch(batch, f"{folder}/log", "results", batch_id)
                again.append(batch)
                batch.write.parquet(f"{folder}/log/data/query=results/batch=999")  # written, never committed

        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()

    folder = in_waves(spark, results, None, "results", start)
    return requests.read_committed(spark, f"{folder}/log", results.drop("wave").schema)


_RATE_WINDOW, _RATE_DELAY = "6 hours", "3 days"


@register(
    "stream_step_rate",
    f"""WITH e AS (
  SELECT CAST(user_id % 20 AS BIGINT) AS run_id, event_id AS step, ts, {WAVE_SQL} AS wave,
    time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS w FROM events),
m AS (SELECT wave, max(max(ts)) OVER (ORDER BY wave) - INTERVAL '3 days' AS mark FROM e GROUP BY wave),
k AS (SELECT e.* FROM e LEFT JOIN m ON m.wave = e.wave - 1 WHERE m.mark IS NULL OR w + INTERVAL '6 hours' > m.mark)
SELECT run_id, epoch_us(w) AS window_us, count(*) AS n_logs, max(step) AS max_step FROM k GROUP BY run_id, w""",
)
def q_stream_step_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Logged steps per run and window of event time; rows whose window the watermark has passed are dropped."""
    logs = read_table(spark, sf, "events").selectExpr("CAST(user_id % 20 AS BIGINT) AS run_id", "event_id AS step", "CAST(ts AS TIMESTAMP) AS ts", f"{WAVE_SQL} AS wave")
    beat = spark.range(1).selectExpr("-1L AS run_id", "-1L AS step", f"CAST('{HEARTBEAT}' AS TIMESTAMP) AS ts")
    folder = in_waves(spark, logs, beat, "rate", lambda stream, folder: to_table(intake.windowed_step_rate(stream, _RATE_WINDOW, _RATE_DELAY), folder))
    found = spark.read.parquet(f"{folder}/out").where("run_id >= 0")
    return found.select("run_id", F.unix_micros("window.start").alias("window_us"), "n_logs", "max_step")


@register(
    "stream_intake",
    _VALIDATE_ORACLE + """SELECT coalesce(reason, 'valid') AS outcome, count(*) AS n_rows,
      (SELECT count(*) FROM verdict) AS n_read FROM verdict GROUP BY reason""",
)
def q_stream_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as text files, routed to a valid table and a quarantine; the counts must add up."""
    conv = assemble_messages(defect_turns(spark, sf))
    name = f"intake-{uuid.uuid4().hex}"
    folder = f"{checkpoint_dir(spark).rstrip('/')}/waves/{name}"
    for part in range(2):  # two arrivals
        conv.where(F.pmod("conv_id", F.lit(2)) == part).selectExpr("to_json(struct(messages), map('ignoreNullFields', 'false')) AS value").write.mode("append").text(f"{folder}/in")
        intake.intake(spark, f"{folder}/in", f"{folder}/valid", f"{folder}/bad", name)
    n_read = spark.read.text(f"{folder}/in").agg(F.count(F.lit(1)).alias("n_read"))
    valid = spark.read.parquet(f"{folder}/valid").select(F.lit("valid").alias("outcome"))
    bad = spark.read.parquet(f"{folder}/bad").select(F.col("reason").alias("outcome"))
    counts = valid.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(n_read)
