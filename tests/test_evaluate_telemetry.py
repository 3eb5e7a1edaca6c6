"""Section accuracy, robustness rules, stream telemetry, generation batching, registry rules."""

import json

import pytest
from pyspark.sql import functions as F

from colloquy.operators import evaluate, generate, metrics, registry, telemetry
from colloquy.plans import jobs, stubs
from colloquy.sources.telemetry import decode_ndjson, decode_sse
from colloquy.streaming.requests import request_metrics_single_pass

from .test_text_and_replies import reply


def acc(spark, pairs):
    df = spark.createDataFrame(pairs, "gold string, generated string")
    return {r["pass_name"]: r for r in evaluate.pass_accuracy(evaluate.parse_pair(df)).collect()}


def test_section_accuracy_classes(spark):
    good = reply()
    r = acc(spark, [(good, "garbage")])["PASS_2"]
    assert (r["accuracy"], r["num_scored"], r["num_prediction_unparseable"]) == (0.0, 1, 1)
    r = acc(spark, [("garbage", good)])["PASS_2"]
    assert (r["accuracy"], r["num_scored"], r["num_gold_unparseable"]) == (0.0, 0, 1)
    r = acc(spark, [(reply(intent="LIST"), reply(intent="LIST")), (reply(intent="LIST"), reply(intent="COUNT"))])["PASS_2"]
    assert (r["accuracy"], r["num_scored"], r["num_prediction_unparseable"]) == (0.5, 2, 0)
    rate = evaluate.exact_match_rate(spark.createDataFrame([(None,)], "exact_match double")).first()
    assert rate["exact_match_rate"] == 0.0 and rate["num_examples"] == 1


def env(entity):
    return "PASS_4\n" + json.dumps({"status": "SUCCESS", "subject": {"entity": entity}})


def robust(spark, rows):
    df = spark.createDataFrame(rows, "group_id string, level int, seq long, generated string")
    df = df.withColumn("pass4_envelope", evaluate.envelope_of(F.col("generated")))
    out = evaluate.robustness(df).withColumn("level_name", evaluate.level_name_column(F.col("level")))
    return out, {(r["group_id"], r["seq"]): r["matches_level1"] for r in out.collect()}


def test_robustness_rules(spark):
    rows = [
        ("a", 1, 0, env("ONU")), ("a", 2, 1, env("ONU")), ("a", 3, 2, env("OLT")), ("a", 4, 3, "garbage"),
        ("b", 1, 4, "garbage"), ("b", 2, 5, env("ONU")),
        ("c", 2, 6, env("ONU")),
        ("d", 1, 7, env("X")), ("d", 1, 8, env("ONU")), ("d", 0, 9, env("ONU")), ("d", 2, 10, env("ONU")),
    ]
    out, m = robust(spark, rows)
    assert m[("a", 0)] is None and m[("a", 1)] is True and m[("a", 2)] is False and m[("a", 3)] is False
    assert m[("b", 5)] is None  # unparseable level 1: group not scored
    assert m[("c", 6)] is None  # no level 1
    assert m[("d", 10)] is True and m[("d", 9)] is None  # last level-1 row wins; level 0 never scored
    summ = {r["level"]: r for r in evaluate.robustness_summary(out).collect()}
    assert summ[1]["num_scoreable"] is None and summ[1]["note"].startswith("reference level")
    assert summ[2]["num_queries"] == 4 and summ[2]["num_scoreable"] == 2
    assert summ[2]["consistency_with_level1"] == 1.0
    assert summ[4]["consistency_with_level1"] == 0.0


def test_lookup_suite_run(spark):
    suite = jobs.lookup_suite(spark)
    assert suite.count() == 12 and suite.select("group_id").distinct().count() == 3
    res = jobs.run_lookup_level_benchmark(suite, decode_factory=stubs.echo_last_turn_factory)
    assert res.filter("matches_level1 IS NOT NULL").count() == 0  # echoes carry no envelope


def log(spark, rows):
    return spark.createDataFrame(
        [(r, i, t, line) for i, (r, t, line) in enumerate(rows)], "request_id string, seq long, arrived_at double, line string"
    ).withColumn("arrived_at", F.col("arrived_at").cast("timestamp"))


def sse(content=None, tokens=None):
    ev = {"choices": [{"delta": {"content": content} if content is not None else {}}]}
    if tokens is not None:
        ev["usage"] = {"completion_tokens": tokens}
    return "data: " + json.dumps(ev)


def test_sse_metrics_controlled_clock(spark):
    rows = [
        ("r1", 100.0, ": opened"), ("r1", 100.2, sse("Hel", 1)), ("r1", 100.5, sse("lo", 2)), ("r1", 100.7, sse("", 3)),
        ("r1", 100.9, "data: [DONE]"), ("r1", 101.5, sse("late", 9)),
        ("r2", 200.0, ": opened"), ("r2", 200.5, "data: [DONE]"),
    ]
    d = decode_sse(log(spark, rows))
    for m in (telemetry.request_metrics(d, end_inclusive=False), request_metrics_single_pass(d, end_inclusive=False)):
        got = {r["request_id"]: r for r in m.collect()}
        r1 = got["r1"]
        assert r1["text"] == "Hello" and r1["tokens_generated"] == 3
        assert abs(r1["ttft_seconds"] - 0.2) < 1e-6 and abs(r1["total_seconds"] - 0.9) < 1e-6
        assert abs(r1["tokens_per_second"] - 2 / 0.7) < 1e-6
        r2 = got["r2"]
        assert r2["text"] == "" and abs(r2["ttft_seconds"] - 0.5) < 1e-6 and r2["tokens_per_second"] == 0.0
    s = telemetry.metrics_summary(telemetry.request_metrics(d, end_inclusive=False)).first()
    assert s["num_queries"] == 2 and s["total_tokens_generated"] == 3


def test_ndjson_metrics(spark):
    rows = [
        ("n1", 10.0, json.dumps({"message": {"content": "a"}, "done": False})),
        ("n1", 10.4, json.dumps({"message": {"content": "b"}, "done": True, "eval_count": 10, "eval_duration": 2_000_000_000})),
        ("n1", 11.0, json.dumps({"message": {"content": "zzz"}, "done": False})),
        ("n2", 5.0, json.dumps({"message": {"content": ""}, "done": False})),
        ("n2", 5.5, json.dumps({"message": {"content": "x"}, "done": True, "eval_count": 3})),
    ]
    d = decode_ndjson(log(spark, rows))
    for m in (telemetry.request_metrics(d, end_inclusive=True), request_metrics_single_pass(d, end_inclusive=True)):
        got = {r["request_id"]: r for r in m.collect()}
        assert got["n1"]["text"] == "ab" and got["n1"]["tokens_per_second"] == 5.0
        assert got["n2"]["text"] == "x" and abs(got["n2"]["tokens_per_second"] - 2 / 1e-9) > 0  # fallback path
        assert got["n2"]["ttft_seconds"] == got["n2"]["total_seconds"]  # content only on the last line


def test_summary_averages(spark):
    df = spark.createDataFrame([(0.2, 1.0, 10, 5.0), (0.4, 2.0, 20, 15.0)],
                               "ttft_seconds double, total_seconds double, tokens_generated long, tokens_per_second double")
    s = telemetry.metrics_summary(df).first()
    assert abs(s["avg_ttft_seconds"] - 0.3) < 1e-12 and s["avg_total_seconds"] == 1.5
    assert s["avg_tokens_per_second"] == 10.0 and s["total_tokens_generated"] == 30 and s["num_queries"] == 2
    assert telemetry.metrics_summary(df.limit(0)).count() == 0


def test_cumulative_to_delta(spark):
    df = spark.createDataFrame([("r", 1, "He"), ("r", 2, "Hello"), ("r", 3, "Hello")], "request_id string, token_index int, text string")
    assert [r["delta"] for r in telemetry.cumulative_to_delta(df).orderBy("token_index").collect()] == ["He", "llo", ""]


def test_generation_batches_and_fallback(spark):
    df = spark.createDataFrame(
        [(i, [{"role": "user", "content": f"q{i}"}]) for i in range(5)], "k long, prompt_messages array<struct<role:string,content:string>>"
    ).coalesce(1)
    with pytest.raises(ValueError):
        generate.generate(df, decode_factory=stubs.echo_last_turn_factory, batch_size=2)
    out = generate.generate(df, batch_factory=stubs.echo_last_turn_batch_factory, batch_size=2).orderBy("k").collect()
    assert [r["generated"] for r in out] == [f"q{i}" for i in range(5)] and {r["status"] for r in out} == {"ok"}
    failing = generate.generate(df, batch_factory=stubs.failing_batch_factory("q2"), batch_size=2).orderBy("k").collect()
    assert [r["status"] for r in failing] == ["ok", "ok", "error", "ok", "ok"]
    assert failing[2]["error"].startswith("RuntimeError")


def test_run_benchmark_report(spark, tmp_dir):
    conv = spark.createDataFrame(
        [(i, [{"role": "user", "content": reply()}, {"role": "assistant", "content": reply()}]) for i in range(3)],
        "conv_id long, messages array<struct<role:string,content:string>>",
    )
    rep = jobs.run_benchmark(spark, None, conv, "conv_id", tmp_dir + "/run_1", batch_factory=stubs.echo_last_turn_batch_factory,
                             batch_size=2).first()
    assert rep["eval_dataset_source"] == "val" and rep["num_golden_examples"] == 3
    assert rep["golden_metrics"]["exact_match_rate"] == 1.0
    assert rep["pass_metrics"]["PASS_4"]["accuracy"] == 1.0
    assert spark.read.json(rep["predictions_path"]).count() == 3
    none = jobs.run_benchmark(spark, None, None, "conv_id", tmp_dir + "/run_2").first()
    assert none["eval_dataset_source"] is None and none["num_golden_examples"] == 0


def test_registry_rules(spark):
    ck = spark.createDataFrame(
        [("b", "run_1", "checkpoint-900", 0.5), ("b", "run_1", "checkpoint-1000", 0.7), ("b", "run_1", "checkpoint-50", 0.2),
         ("b", "run_1", "checkpoint-final", 0.1), ("b", "run_2", "checkpoint-5", 0.3)],
        "base_dir string, run_name string, name string, eval_loss double",
    )
    latest = {r["run_name"]: r["latest_checkpoint"] for r in registry.latest_checkpoint(ck).collect()}
    assert latest == {"run_1": "checkpoint-1000", "run_2": "checkpoint-5"}
    stale = [r["name"] for r in registry.stale_checkpoints(ck).collect()]
    assert stale == ["checkpoint-900"]
    runs = spark.createDataFrame(
        [("b", "run_20240101_000000", True), ("b", "run_20250101_000000", False), ("b", "other", True),
         ("b", "run_manual", True), ("c", "run_20230101_000000", True)],
        "base_dir string, run_name string, has_adapter boolean",
    )
    assert {r["base_dir"]: r["latest_run"] for r in registry.latest_synced_run(runs).collect()} == {
        "b": "run_manual", "c": "run_20230101_000000"}
    ck2 = spark.createDataFrame([("b", "run_20240101_000000", "checkpoint-1", 0.1)], ck.schema)
    assert [tuple(r) for r in registry.latest_resumable_run(runs, ck2).collect()] == [("b", "run_20240101_000000")]
    cfg = spark.createDataFrame([(1, "m", 16, 32, 1536, "ad/1"), (2, "m", 16, 32, 1536, None)],
                                "id int, base_model string, lora_r long, lora_alpha long, max_seq_length long, continue_adapter string")
    prior = spark.createDataFrame([("ad/1", "prior-m", 8, None, 1024)],
                                  "adapter_path string, base_model string, lora_r long, lora_alpha long, max_seq_length long")
    out = {r["id"]: r for r in registry.inherit_from_prior(cfg, prior).collect()}
    assert (out[1]["base_model"], out[1]["lora_r"], out[1]["lora_alpha"], out[1]["training_mode"]) == ("prior-m", 8, 32, "continue_lora")
    assert out[2]["training_mode"] == "fresh_lora" and out[2]["lora_r"] == 16


def test_manifest_preference(spark):
    m = spark.createDataFrame(
        [("a", "old_manifest.json", '{"lora_r": 4}'), ("a", "manifest.json", '{"lora_r": 8}'),
         ("b", "old_manifest.json", '{"lora_r": 2}'), ("c", "manifest.json", "{corrupt")],
        "adapter_path string, file_name string, body string",
    )
    best = registry.parse_manifest_body(registry.prefer_manifest(m, legacy="old_manifest.json"))
    got = {r["adapter_path"]: (r["manifest"]["lora_r"] if r["manifest"] else None) for r in best.collect()}
    assert got == {"a": 8, "b": 2, "c": None}


def test_metric_series(spark):
    logs = spark.createDataFrame(
        [(1, 0, "train", "loss", 2.0), (1, 50, "train", "loss", 1.0), (1, 50, "eval", "eval_loss", 0.5),
         (1, 60, "train", "other", 3.0), (1, 100, "eval", "accuracy", 0.9)],
        "run_id long, step long, source string, key string, value double",
    )
    s = metrics.to_series(logs)
    assert sorted(r["metric"] for r in s.collect()) == ["eval/accuracy", "eval/loss", "train/loss", "train/loss"]
    summ = {r["metric"]: r["last_value"] for r in metrics.summary(s).collect()}
    assert summ["train/loss"] == 1.0
    assert metrics.every_n(s, 50).count() == 4 and metrics.every_n(s, 0).count() == 4


def test_ndjson_done_truthiness(spark):
    rows = [("a", 1.0, '{"message": {"content": "x"}, "done": 0}'), ("a", 2.0, '{"message": {"content": "y"}, "done": 1}'),
            ("a", 3.0, '{"message": {"content": "z"}}'), ("b", 1.0, '{"message": {"content": "p"}, "done": "yes"}'),
            ("b", 2.0, '{"message": {"content": "q"}, "done": false}')]
    got = {r["request_id"]: r["text"] for r in telemetry.request_metrics(decode_ndjson(log(spark, rows)), True).collect()}
    assert got == {"a": "xy", "b": "p"}


def test_predict_column(spark):
    df = spark.createDataFrame(
        [(i, [{"role": "user", "content": f"q{i}"}]) for i in range(5)], "k long, prompt_messages array<struct<role:string,content:string>>"
    )
    col = generate.predict_column(stubs.echo_last_turn_batch_factory, batch_size=2)
    out = df.select("k", col(F.to_json("prompt_messages")).alias("g")).orderBy("k").collect()
    assert [r["g"] for r in out] == [f"q{i}" for i in range(5)]


def test_cumulative_to_delta_across_blocks(spark):
    words = ["a", "bc", "", "def", "g", "", "hi"]
    cum, acc = [], ""
    for i, w in enumerate(words, start=1):
        acc += w
        cum.append(("r", i, acc))
    df = spark.createDataFrame(cum, "request_id string, token_index int, text string")
    got = [r["delta"] for r in telemetry.cumulative_to_delta(df, block_rows=2).orderBy("token_index").collect()]
    assert got == words


def test_small_helpers(spark):
    import datetime as dt

    from colloquy.operators import stats
    from colloquy.operators import validate as V

    runs = spark.createDataFrame([("run_20240102_030405",), ("run_manual",)], "run_name string")
    ts = [r[0] for r in runs.select(registry.run_timestamp(F.col("run_name"))).collect()]
    assert ts[0] == dt.datetime(2024, 1, 2, 3, 4, 5) and ts[1] is None
    meta = spark.createDataFrame([(1, "lr", "float", "0.1"), (1, "cfg", "dict", "{}")], "run_id long, k string, kind string, value string")
    assert [r["metric"] for r in metrics.scalar_metadata(meta).collect()] == ["run/lr"]
    turns = spark.createDataFrame([(1, 0, "user", "q"), (2, 0, "bot", "q")], "conv_id long, turn long, role string, text string")
    verdicts = V.validate_turns(turns)
    assert [r["conv_id"] for r in V.valid_turns(turns, verdicts).collect()] == [1]
    assert [r["reason_class"] for r in V.quarantine(verdicts).collect()] == ["turn_i_invalid_role"]


def test_failed_predictions_score_zero_and_are_counted(spark):
    prompts = spark.createDataFrame([(i, "gold") for i in range(10)], "conv_id long, gold string").withColumn(
        "prompt_messages", F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content"))))
    gen = prompts.selectExpr("*", "CASE WHEN conv_id = 0 THEN 'gold' END AS generated", "CASE WHEN conv_id = 0 THEN 'ok' ELSE 'error' END AS status")
    r = evaluate.exact_match_rate(generate.prediction_records(gen, "conv_id"), status="status").first()
    assert (r["exact_match_rate"], r["num_examples"], r["num_errors"]) == (0.1, 10, 9)


def test_runs_with_a_final_checkpoint_resume_and_unmeasured_losses_are_never_best(spark):
    runs = spark.createDataFrame([("b", "run_20240101_000000", True), ("b", "run_20240102_000000", True)], "base_dir string, run_name string, has_adapter boolean")
    cks = spark.createDataFrame(
        [("b", "run_20240101_000000", "checkpoint-1", None), ("b", "run_20240101_000000", "checkpoint-2", 0.5), ("b", "run_20240101_000000", "checkpoint-3", 0.9),
         ("b", "run_20240102_000000", "checkpoint-final", None)], "base_dir string, run_name string, name string, eval_loss double")
    assert registry.latest_resumable_run(runs, cks).first()["resume_run"] == "run_20240102_000000"
    assert [r["name"] for r in registry.stale_checkpoints(cks).collect()] == ["checkpoint-1"]


def test_two_prior_rows_do_not_multiply_a_child(spark):
    fields = "base_model string, lora_r long, lora_alpha long, max_seq_length long"
    child = spark.createDataFrame([("c", "a", "m", 1, 2, 3)], "name string, continue_adapter string, " + fields)
    prior = spark.createDataFrame([("a", "p", 8, 16, 512), ("a", "p", 8, 16, 512)], "adapter_path string, " + fields)
    rows = registry.inherit_from_prior(child, prior).collect()
    assert len(rows) == 1 and rows[0]["lora_r"] == 8


def test_generation_reads_prompts_in_slices_and_leaves_other_columns_alone(spark):
    n = generate.SLICE * 2 + 5
    rows = [(None if i % 3 == 0 else (1 << 53) + 1 + i, [("user", f"q{i}")]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, prompt_messages array<struct<role:string,content:string>>").coalesce(1)

    def factory():
        return lambda prompts, _: [f"{len(prompts)}:{p[0]['content']}" for p in prompts]

    out = generate.generate(df, batch_factory=factory, batch_size=7).collect()
    assert [r["id"] for r in out] == [r[0] for r in rows]  # whole numbers beside nulls, past a double's precision
    assert [r["generated"].split(":")[1] for r in out] == [f"q{i}" for i in range(n)]
    assert {int(r["generated"].split(":")[0]) for r in out[: generate.SLICE // 7 * 7]} == {7}
