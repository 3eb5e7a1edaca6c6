"""Bounded request sessions, the committed result log, whole-row priors, settled runs, one-pass plans."""

import os
import random

from pyspark.sql import functions as F

from colloquy.operators import registry, shape, stats, telemetry
from colloquy.plans import jobs, stubs
from colloquy.sources.telemetry import decode_sse
from colloquy.streaming import requests

CHUNK = 'data: {"choices":[{"delta":{"content":"%s"}}],"usage":{"completion_tokens":%d}}'


def _log(spark, rows):
    df = spark.createDataFrame(rows, "request_id string, seq long, at double, line string")
    return df.withColumn("arrived_at", F.col("at").cast("timestamp")).drop("at")


def test_sessions_equal_the_batch_form(spark, tmp_dir):
    rng = random.Random(5)
    rows = []
    for r in range(12):
        n = rng.randrange(1, 7)
        rows += [(f"r{r}", 10 * r + i, 100.0 * (r // 3) + rng.random() * 60, CHUNK % (f"{r}.{i} ", i)) for i in range(n)]
        if r % 3:
            rows.append((f"r{r}", 10 * r + rng.choice([2, 9]), 100.0 * (r // 3) + 61, "data: [DONE]"))
    want = {x["request_id"]: x for x in telemetry.request_metrics(decode_sse(_log(spark, rows)), end_inclusive=False).collect()}
    late = sorted(rows, key=lambda x: x[2] + rng.random() * 90)  # out of order, within the allowed lateness
    late.append(("beat", 999, 10_000.0, ""))
    src = os.path.join(tmp_dir, "in")
    out = os.path.join(tmp_dir, "out")
    schema = _log(spark, rows).schema
    with requests.with_rocksdb(spark):
        for i in range(0, len(late), 12):
            _log(spark, late[i : i + 12]).write.mode("append").parquet(src)
            stream = spark.readStream.schema(schema).parquet(src)
            requests.append_results(requests.request_sessions(decode_sse(stream), False, delay_ms=300_000, idle_ms=60_000), out, f"sessions-{os.path.basename(tmp_dir)}")
    got = {x["request_id"]: x for x in spark.read.parquet(out).collect() if x["request_id"] != "beat"}
    assert got.keys() == want.keys() and len(spark.read.parquet(out).collect()) <= len(got) + 1
    for k, w in want.items():
        assert got[k]["text"] == w["text"] and got[k]["tokens_generated"] == w["tokens_generated"]
        assert all(abs(got[k][c] - w[c]) < 1e-9 for c in ("ttft_seconds", "total_seconds", "tokens_per_second"))
        assert got[k]["ended"] == (int(k[1:]) % 3 > 0)


def test_one_scan_for_request_metrics(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    _log(spark, [("a", i, float(i), CHUNK % ("x", i)) for i in range(3000)] + [("a", 2500, 2500.5, "data: [DONE]")]).write.parquet(path)
    m = telemetry.request_metrics(decode_sse(spark.read.parquet(path)), end_inclusive=False)
    assert m._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert m.first()["text"] == "x" * 2500 and m.first()["tokens_generated"] == 2499


def test_committed_log(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    one, two = spark.range(3), spark.range(3, 5)
    requests.commit_batch(one, path, "q", 0)
    requests.commit_batch(one, path, "q", 0)  # replayed
    two.write.parquet(f"{path}/data/query=q/batch=1")  # broke off before its commit
    assert sorted(r.id for r in requests.read_committed(spark, path, one.schema).collect()) == [0, 1, 2]
    requests.commit_batch(two, path, "q", 1)
    assert sorted(r.id for r in requests.read_committed(spark, path, one.schema).collect()) == [0, 1, 2, 3, 4]


def test_priors_are_taken_whole(spark):
    fields = "adapter_path string, base_model string, lora_r long, lora_alpha long, max_seq_length long, created long"
    priors = spark.createDataFrame([("a", "m1", 8, None, 512, 2), ("a", "m0", 64, 16, None, 1), ("a", None, 4, 4, 4, 0)], fields)
    child = spark.createDataFrame([(1, "own", 1, 2, 3, "a"), (2, "own", 1, 2, 3, None)], "id long, base_model string, lora_r long, lora_alpha long, max_seq_length long, continue_adapter string")
    got = {r["id"]: r for r in registry.inherit_from_prior(child, priors, newest="created").collect()}
    assert (got[1]["base_model"], got[1]["lora_r"], got[1]["lora_alpha"], got[1]["max_seq_length"]) == ("m1", 8, 2, 512)
    assert got[2]["base_model"] == "own" and got[2]["training_mode"] == "fresh_lora"


def test_scan_of_many_folders(spark, tmp_dir):
    for i in range(40):
        folder = os.path.join(tmp_dir, f"g{i % 3}", f"a{i}")
        os.makedirs(folder)
        for name in ("manifest.json", "old.json")[i % 2 :]:
            with open(os.path.join(folder, name), "w") as f:
                f.write('{\n "lora_r": %d\n}' % (i if name == "manifest.json" else -i))
    found = registry.preferred(registry.scan_manifests(spark, tmp_dir, ["manifest.json", "old.json"]))
    got = {os.path.basename(r["folder"]): r["manifest"]["lora_r"] for r in registry.parse_manifest_body(found).collect()}
    assert got == {f"a{i}": i if i % 2 == 0 else -i for i in range(40)}


def test_settled_runs_count_both_sides(spark):
    results = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x")], "request_id string, seq long, level_name string")
    log = spark.createDataFrame([("a", "t"), ("c", "t")], "request_id string, text string")
    joined, counts = jobs.settle_remote(results, log)
    assert [tuple(r) for r in joined.collect()] == [("a", 2, "new", "t")]
    assert tuple(counts.first()) == (1, 1, 1, 1)


def test_words_are_tokenised_once(spark):
    texts = spark.createDataFrame([(1, "alpha alpha\n be "), (2, None), (3, "  "), (4, "alphabetical")], "k long, t string")
    got = stats.distinct_word_tokens(texts, "k", "t", stats.arrow_token_counter(stubs.fours_factory))
    assert {r["k"]: r["n_tokens"] for r in got.collect()} == {1: 5, 2: 0, 3: 0, 4: 3}


def test_guard_and_lengths_without_texts(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "assistant", None), (2, 0, "user", "x <|turn>model"), (3, 0, "user", "say <|turn>model\nnow"), (4, 0, None, None)],
        "conv_id long, turn long, role string, text string",
    )
    flat = shape.flatten_text(turns)
    assert shape.marker_guard_of_turns(turns).collect() == shape.marker_guard(flat).collect()
    assert {r["conv_id"]: r["n_chars"] for r in shape.text_lengths(turns).where("conv_id < 4").collect()} == {r["conv_id"]: len(r["text"]) for r in flat.where("conv_id < 4").collect()}
    spans = shape.response_spans(turns)
    assert shape.masked_fraction(spans, shape.text_lengths(turns)).first() == shape.masked_fraction(spans, flat).first()
    assert shape._straddles("<|turn>user", "x<") and not shape._straddles("<|turn>user", "<turn|>\n")


def test_sessions_share_state_by_bucket(spark, tmp_dir):
    """many requests of a bucket wait, close and swallow stragglers each by itself, with few state elements."""
    line = CHUNK % ("x ", 1)
    waves = [
        [("a", 1, 10.0, line), ("b", 2, 10.0, line), ("c", 3, 500.0, line), ("d", 4, 10.0, line), ("d", 5, 11.0, "data: [DONE]"), (None, 6, 10.0, line)],
        [("c", 7, 480.0, line), ("beat", 100, 420.0, "")],  # the watermark comes to 200 s
        [("d", 8, 450.0, line), ("a", 9, 460.0, line), ("beat", 101, 421.0, "")],  # stragglers, not yet too late
        [("beat", 102, 5000.0, "")],
        [("a", 10, 6000.0, line), ("beat", 103, 20_000.0, "")],  # its marker is gone: a new request
        [("beat", 104, 30_000.0, "")],
    ]
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    schema = _log(spark, waves[0]).schema
    with requests.with_rocksdb(spark):
        for wave in waves:
            _log(spark, wave).coalesce(1).write.mode("append").parquet(src)
            stream = spark.readStream.schema(schema).parquet(src)
            made = requests.request_sessions(decode_sse(stream), False, delay_ms=300_000, idle_ms=60_000, buckets=1)
            requests.append_results(made, out, f"bucket-{os.path.basename(tmp_dir)}")
    got = sorted((str(x["request_id"]), x["text"], x["ended"]) for x in spark.read.parquet(out).collect() if x["request_id"] != "beat")
    assert got == [("None", "x ", False), ("a", "x ", False), ("a", "x ", False), ("b", "x ", False), ("c", "x x ", False), ("d", "x ", True)]
