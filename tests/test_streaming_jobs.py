"""Streaming intake, result callbacks, stream rates, manifest scan, tokenizer hook, composed jobs."""

import json
import os

from pyspark.sql import functions as F

from colloquy.operators import registry, shape, stats
from colloquy.plans import jobs, stubs
from colloquy.sources import sinks
from colloquy.sources.telemetry import decode_sse
from colloquy.streaming import intake as S
from colloquy.streaming.requests import append_results, request_metrics_single_pass, run_complete_to_table



def test_stream_intake_routes_rows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    good = json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]})
    for i in range(3):
        with open(os.path.join(src, f"part-{i}.jsonl"), "w") as f:
            f.write("\n".join([good, "[1]", "", good]) + "\n")
    S.intake(spark, src, os.path.join(tmp_dir, "valid"), os.path.join(tmp_dir, "quarantine"), "intake-test",
             max_files_per_trigger=1)
    assert spark.read.parquet(os.path.join(tmp_dir, "valid")).count() == 6
    q = spark.read.parquet(os.path.join(tmp_dir, "quarantine")).collect()
    assert len(q) == 3 and {r["reason"] for r in q} == {"not_a_json_object"}


def test_stream_equals_batch_and_callbacks(spark, tmp_dir):
    src = os.path.join(tmp_dir, "chunks")
    rows = [("r1", 0, 100.0, ": open"), ("r1", 1, 100.2, 'data: {"choices":[{"delta":{"content":"Hi"}}],"usage":{"completion_tokens":2}}'),
            ("r1", 2, 100.5, "data: [DONE]"), ("r2", 3, 50.0, 'data: {"choices":[{"delta":{"content":"x"}}]}')]
    df = spark.createDataFrame(rows, "request_id string, seq long, at double, line string").withColumn(
        "arrived_at", F.col("at").cast("timestamp")).drop("at")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out = run_complete_to_table(request_metrics_single_pass(decode_sse(stream), False), os.path.join(tmp_dir, "m"), "m-test")
    got = {r["request_id"]: (r["text"], r["tokens_generated"]) for r in spark.read.parquet(out).collect()}
    assert got == {"r1": ("Hi", 2), "r2": ("x", 0)}
    seen = []
    S.on_each_batch(spark.readStream.schema(df.schema).parquet(src), lambda b, i: seen.append((i, b.count())), "cb-test")
    assert sum(n for _, n in seen) == 4
    logged = append_results(spark.readStream.schema(df.schema).parquet(src), os.path.join(tmp_dir, "log"), "log-test")
    assert logged.count() == 4


def test_stream_throughput_and_window(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs")
    logs = spark.createDataFrame([(1, s, float(1000 + s)) for s in range(0, 5)], "run_id long, step long, t double").withColumn(
        "ts", F.col("t").cast("timestamp")).drop("t")
    logs.write.parquet(src)
    starts = spark.createDataFrame([(1, 1000.0)], "run_id long, s double").withColumn("started_at", F.col("s").cast("timestamp"))
    stream = spark.readStream.schema(logs.schema).parquet(src)
    from colloquy.operators.metrics import ThroughputPlan

    out = S.throughput_stream(stream, starts, ThroughputPlan(batch_size=1, gradient_accumulation=2, max_length=10, max_steps=10))
    path = os.path.join(tmp_dir, "tp")
    append_results(out, path, "tp-test")
    r = {x["step"]: x for x in spark.read.parquet(path).collect()}
    assert set(r) == {1, 2, 3, 4} and r[2]["examples_per_sec"] == 2.0 and r[2]["eta_seconds"] == 8.0
    w = S.windowed_step_rate(logs)
    assert w.agg(F.sum("n_logs")).first()[0] == 5


def test_manifest_scan(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    os.makedirs(a)
    os.makedirs(b)
    open(os.path.join(a, "manifest.json"), "w").write(json.dumps({"lora_r": 8, "base_model": "m"}, indent=2))
    open(os.path.join(a, "old_manifest.json"), "w").write(json.dumps({"lora_r": 4}))
    open(os.path.join(b, "old_manifest.json"), "w").write(json.dumps({"lora_r": 2}))
    m = registry.parse_manifest_body(registry.prefer_manifest(
        registry.read_manifests(spark, [a, b, os.path.join(tmp_dir, "none")], legacy="old_manifest.json"), legacy="old_manifest.json"))
    got = {os.path.basename(r["adapter_path"]): r["manifest"]["lora_r"] for r in m.collect()}
    assert got == {"a": 8, "b": 2}


def test_tokenizer_hook(spark):
    count = stats.arrow_token_counter(lambda: (lambda t: list(t)))
    model = stats.TokenModel(count=count, per_turn_overhead=0, bos_tokens=0)
    t = spark.createDataFrame([(1, 0, "user", "abc"), (1, 1, "assistant", "de")], "conv_id long, turn long, role string, text string")
    r = stats.conversation_tokens(t, model).first()
    assert (r["prompt_tokens"], r["response_tokens"], r["total_tokens"]) == (3, 2, 5)


def test_golden_eval_sample_and_sinks(spark, tmp_dir):
    conv = spark.createDataFrame(
        [(i, [{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": f"q{i}" if i % 2 else "other"}]) for i in range(10)],
        "conv_id long, messages array<struct<role:string,content:string>>",
    )
    assert jobs.run_golden_evaluation(None, "conv_id") is None
    r = jobs.run_golden_evaluation(conv, "conv_id", decode_factory=stubs.echo_last_turn_factory, max_samples=4).first()
    assert r["num_examples"] == 4 and r["exact_match_rate"] == 0.5
    assert jobs.prediction_sample(conv, "conv_id", stubs.echo_last_turn_factory, eval_count=1, every_n_evals=2) is None
    assert jobs.prediction_sample(conv, "conv_id", stubs.echo_last_turn_factory, eval_count=2, every_n_evals=2).count() == 8
    rep = spark.createDataFrame([(1, None)], "a int, b string")
    sinks.write_report(rep, os.path.join(tmp_dir, "report"))
    assert spark.read.text(os.path.join(tmp_dir, "report")).first()[0] == '{"a":1,"b":null}'
    counts = shape.first_n(spark.createDataFrame([("train", 5), ("val", 2)], "split string, rows long"), "split", 5)
    man = jobs.build_manifest(spark, counts, {"base_model": "m", "continued_from": None}).first()
    assert (man["train_rows"], man["val_rows"], man["golden_rows"], man["training_mode"]) == (5, 2, None, "fresh_lora")


def test_remote_run_scoring(spark):
    env = lambda e: "PASS_4\n" + json.dumps({"subject": {"entity": e}})
    res = spark.createDataFrame([("q1", "g", 1, "L1", 0), ("q2", "g", 2, "L2", 1)],
                                "request_id string, group_id string, level int, level_name string, seq long")
    met = spark.createDataFrame([("q1", env("A"), 0.1, 1.0, 5, 4.0), ("q2", env("A"), 0.2, 2.0, 5, 2.0)],
                                "request_id string, text string, ttft_seconds double, total_seconds double, tokens_generated long, tokens_per_second double")
    scored, summary, lat = jobs.score_remote_run(res, met)
    assert {r["request_id"]: r["matches_level1"] for r in scored.collect()} == {"q1": None, "q2": True}
    assert lat.first()["num_queries"] == 2 and summary.count() == 2


def test_stateful_stream_emits_ended_requests(spark, tmp_dir):
    from colloquy.streaming.requests import request_metrics_stateful

    src = os.path.join(tmp_dir, "chunks2")
    rows = [("r1", 0, 100.0, ": open"), ("r1", 1, 100.2, 'data: {"choices":[{"delta":{"content":"Hel"}}],"usage":{"completion_tokens":1}}'),
            ("r1", 2, 100.5, 'data: {"choices":[{"delta":{"content":"lo"}}],"usage":{"completion_tokens":2}}'),
            ("r1", 3, 100.7, 'data: {"choices":[{"delta":{}}],"usage":{"completion_tokens":3}}'),
            ("r1", 4, 100.9, "data: [DONE]"), ("r2", 5, 100.95, 'data: {"choices":[{"delta":{"content":"x"}}]}'),
            ("r3", 6, 200.0, ": open"), ("r1", 7, 50.0, 'data: {"choices":[{"delta":{"content":"late"}}]}')]
    df = spark.createDataFrame(rows, "request_id string, seq long, at double, line string").withColumn(
        "arrived_at", F.col("at").cast("timestamp")).drop("at")
    for i in range(0, 8, 2):  # four files -> four micro-batches; the last one moves the watermark
        df.filter(F.col("seq").between(i, i + 1)).write.mode("append").parquet(src)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(df.schema).parquet(src)
    out = os.path.join(tmp_dir, "stateful")
    append_results(request_metrics_stateful(decode_sse(stream), end_inclusive=False, delay_ms=1000), out, "stateful-test")
    got = {r["request_id"]: r for r in spark.read.parquet(out).collect()}
    r1 = got["r1"]
    # r2 never ends: emitted once the watermark passes its last chunk plus the delay
    assert got["r2"]["ended"] is False and got["r2"]["text"] == "x" and got["r2"]["ttft_seconds"] == 0.0
    assert "r3" not in got  # still open, inside the watermark delay
    assert len([r for r in spark.read.parquet(out).collect() if r["request_id"] == "r1"]) == 1  # late line ignored
    assert r1["text"] == "Hello" and r1["tokens_generated"] == 3 and r1["ended"]
    assert abs(r1["ttft_seconds"] - 0.2) < 1e-9 and abs(r1["tokens_per_second"] - 2 / 0.7) < 1e-9


def test_template_tokens(spark):
    count = stats.arrow_token_counter(lambda: (lambda t: t.split("<")))
    t = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    r = stats.template_tokens(t, count).first()
    text = "<bos><|turn>user\na<turn|>\n<|turn>model\nb<turn|>\n"
    assert r["total_tokens"] == len(text.split("<"))


def test_manifest_with_prior(spark):
    counts = spark.createDataFrame([("train", 5)], "split string, rows long")
    prior = spark.createDataFrame([("m0", 8)], "base_model string, lora_r long")
    man = jobs.build_manifest(spark, counts, {"base_model": "m", "continued_from": "ad/1"}, prior).first()
    assert man["training_mode"] == "continue_lora" and json.loads(man["prior_manifest"]) == {"base_model": "m0", "lora_r": 8}


def test_sinks_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(1, None, "a"), (2, "x", "b")], "k long, v string, source string")
    sinks.write_jsonl(df, os.path.join(tmp_dir, "j"), partition_by="source")
    lines = [r[0] for r in spark.read.text(os.path.join(tmp_dir, "j", "source=a")).collect()]
    assert lines == ['{"k":1,"v":null}']
    path = sinks.export_predictions(df.drop("source"), os.path.join(tmp_dir, "run_7"), "val")
    assert path.endswith("predictions/val_predictions") and spark.read.json(path).count() == 2
    series = spark.createDataFrame([(1, 10, "train/loss", 0.5), (1, 20, "train/loss", 0.4)],
                                   "run_id long, step long, metric string, value double")
    sinks.append_series(series, os.path.join(tmp_dir, "series"))
    sinks.append_series(series.limit(1), os.path.join(tmp_dir, "series"))
    assert spark.read.parquet(os.path.join(tmp_dir, "series")).count() == 3


def test_session_helpers(spark):
    from colloquy import session

    session.ship_package(spark)
    session.ship_package(spark)  # idempotent per application
    assert spark.sparkContext.applicationId in session._SHIPPED
    assert session.checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
