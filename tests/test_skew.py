"""Hot keys: one conversation / group / request holding a third of all rows."""

import json

from pyspark.sql import functions as F

from colloquy.operators import evaluate, stats, telemetry
from colloquy.operators import validate as V
from colloquy.sources.telemetry import decode_sse


def test_hot_conversation_validation_and_stats(spark):
    hot = [(0, t, "user" if t % 2 == 0 else "assistant", f"w{t}") for t in range(20000)]
    hot[15001] = (0, 15001, "user", "w")  # turn 15000 user, 15001 user: legal
    hot[17001] = (0, 17001, "assistant", "x")
    hot[17002] = (0, 17002, "assistant", "y")  # assistant, assistant -> consecutive
    small = [(c, t, "user" if t % 2 == 0 else "assistant", "q") for c in range(1, 10001) for t in range(4)]
    df = spark.createDataFrame(hot + small, "conv_id long, turn long, role string, text string").repartition(8)
    v = {r["conv_id"]: r["reason"] for r in V.validate_turns(df).filter("conv_id < 3").collect()}
    assert v == {0: "consecutive_assistant_turns", 1: None, 2: None}
    per = stats.conversation_tokens(df).filter("conv_id = 0").first()
    assert per["n_turns"] == 20000 and per["total_tokens"] == 20000 + 4 * 20000 + 1


def test_hot_group_robustness(spark):
    env = lambda e: "PASS_4\n" + json.dumps({"e": e})
    rows = [("hot", 1 + i % 4, i, env("A" if i % 3 else "B")) for i in range(30000)]
    rows += [(f"g{i}", 1 + j, 100000 + i * 4 + j, env("A")) for i in range(15000) for j in range(4)]
    df = spark.createDataFrame(rows, "group_id string, level int, seq long, generated string").repartition(8)
    out = evaluate.robustness(df.withColumn("pass4_envelope", evaluate.envelope_of(F.col("generated"))))
    hot = out.filter("group_id = 'hot' AND level > 1")
    # last level-1 row of the hot group is seq 29996 (29996 % 3 != 0 -> "A")
    want = sum(1 for i in range(30000) if 1 + i % 4 > 1 and i % 3 != 0)
    assert hot.filter("matches_level1").count() == want
    assert out.filter("group_id <> 'hot' AND level > 1 AND NOT matches_level1").count() == 0


def test_hot_request_metrics(spark):
    n = 20000
    rows = [("hot", i, 1000.0 + i / 1000, 'data: {"choices":[{"delta":{"content":"a"}}],"usage":{"completion_tokens":%d}}' % (i + 1))
            for i in range(n)]
    rows += [(f"r{i}", n + i, 5.0, 'data: {"choices":[{"delta":{"content":"b"}}]}') for i in range(10000)]
    df = spark.createDataFrame(rows, "request_id string, seq long, t double, line string").withColumn(
        "arrived_at", F.col("t").cast("timestamp")).drop("t").repartition(8)
    m = telemetry.request_metrics(decode_sse(df), end_inclusive=False).filter("request_id = 'hot'").first()
    assert m["text"] == "a" * n and m["tokens_generated"] == n
