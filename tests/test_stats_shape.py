"""Statistics, histogram, cost figures and corpus shaping against direct Python computations."""

import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import shape, stats
from colloquy.plans import jobs


def turns_df(spark, convs):
    rows = [(cid, i, role, text) for cid, msgs in convs.items() for i, (role, text) in enumerate(msgs)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def pct(values, p):
    s = sorted(values)
    if len(s) == 1:
        return float(s[0])
    k = p / 100 * (len(s) - 1)
    f = int(k)
    c = min(f + 1, len(s) - 1)
    return float(s[f]) if f == c else s[f] * (c - k) + s[c] * (k - f)


def test_percentile_matches_linear_interpolation(spark):
    df = spark.createDataFrame([("a", v) for v in [7, 1, 100, 3]], "split string, total_tokens long")
    r = stats.token_analysis(df.withColumn("n_turns", F.lit(1)), max_seq_length=50).first()
    assert abs(r["p95"] - 86.05) < 1e-9
    assert r["median"] == pct([7, 1, 100, 3], 50)
    assert r["num_exceeding_max_seq_length"] == 1


def test_dataset_statistics_against_python(spark):
    rng = random.Random(3)
    convs = {
        c: [("user" if i % 2 == 0 else "assistant", " ".join("w" for _ in range(rng.randint(0, 30))))
            for i in range(rng.randint(1, 6))]
        for c in range(60)
    }
    per = stats.conversation_tokens(turns_df(spark, convs).withColumn("split", F.lit("train")), extra=("split",))
    plan = stats.TrainingPlan(max_seq_length=40, batch_size=2, gradient_accumulation=4, epochs=2.0, packing=True, device="T4")
    r = stats.dataset_statistics(per, plan).first()
    totals = []
    for msgs in convs.values():
        p = sum(len(t.split()) for role, t in msgs if role != "assistant")
        q = sum(len(t.split()) for role, t in msgs if role == "assistant")
        totals.append(p + q + 4 * len(msgs) + 1)
    n = len(totals)
    assert r["num_examples"] == n
    assert abs(r["avg_total_tokens"] - sum(totals) / n) < 1e-9
    assert abs(r["p95_total_tokens"] - pct(totals, 95)) < 1e-9
    assert r["max_total_tokens"] == max(totals)
    assert r["num_exceeding_max_seq_length"] == sum(t > 40 for t in totals)
    assert abs(r["packing_efficiency"] - (sum(totals) / n) / 40) < 1e-12
    packed = max(int(sum(totals) / 40), 1)
    assert r["estimated_optimizer_steps"] == int(max(packed // 8, 1) * 2.0)
    assert abs(r["estimated_training_time_hours"] - n * (sum(totals) / n) * 2.0 / 250.0 / 3600) < 1e-12
    (title, line) = jobs.statistics_text(spark.createDataFrame([r]))
    assert title == "# statistics" and f"num_examples={n}" in line and "packing_efficiency=" in line


def test_exact_samples_at_any_bucket(spark):
    df = spark.range(5000).withColumn("half", F.col("id") % 2)
    for n in (0, 1, 9, 11, 4999, 5000, 6000):
        got = {r["id"] for r in shape.seeded_sample(df, "id", n, seed=3).collect()}
        assert len(got) == min(n, 5000)
    pairs = df.selectExpr("id % 100 AS line_no", "CAST(id DIV 100 AS STRING) AS file")  # line numbers repeat over files
    assert shape.seeded_sample(pairs, ("file", "line_no"), 9).count() == 9
    assert shape.seeded_sample(pairs, ("file", "line_no"), 11).count() == 11


def test_histogram_bins(spark):
    vals = [0, 1, 2, 5, 10, 10, 19, 20]
    df = spark.createDataFrame([("s", v) for v in vals] + [("flat", 3), ("flat", 3)], "split string, v long")
    h = {(r["split"], r["bin"]): r for r in stats.histogram(df, "v", bins=20, width=50).collect()}
    assert len([k for k in h if k[0] == "s"]) == 20
    assert h[("s", 19)]["count"] == 2  # the maximum lands in the last bin
    assert h[("s", 10)]["count"] == 2 and h[("s", 10)]["bar"] == "#" * 50
    assert h[("s", 3)]["count"] == 0 and h[("s", 3)]["bar"] == ""
    assert [k for k in h if k[0] == "flat"] == [("flat", 0)] and h[("flat", 0)]["count"] == 2


def test_cost_by_device_and_exchanges(spark):
    convs = {1: [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")], 2: [("user", "x")]}
    per = stats.conversation_tokens(turns_df(spark, convs).withColumn("split", F.lit("t")), extra=("split",))
    st = stats.dataset_statistics(per)
    costs = {r["device"]: r["estimated_training_time_hours"] for r in stats.cost_by_device(st).collect()}
    assert abs(costs["CPU"] - 2 * 1536 / 5.0 / 3600) < 1e-12 and len(costs) == 5
    ex = {r["n_exchanges"]: r["n_rows"] for r in stats.exchanges_per_row(turns_df(spark, convs)).collect()}
    assert ex == {2: 1, 0: 1}


def test_flatten_prefix_and_spans(spark):
    convs = {
        1: [("system", "sys"), ("user", "ctx"), ("user", "query"), ("assistant", "PASS_0\n...")],
        2: [("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2")],
        3: [("user", "only")],
    }
    t = turns_df(spark, convs)
    flat = {r["conv_id"]: r["text"] for r in shape.flatten_text(t).collect()}
    assert flat[1] == ("<bos><|turn>system\nsys<turn|>\n<|turn>user\nctx<turn|>\n"
                       "<|turn>user\nquery<turn|>\n<|turn>model\nPASS_0\n...<turn|>\n")
    prefix = {r["conv_id"]: r["prompt"] for r in shape.prompt_prefix(t).collect()}
    assert set(prefix) == {1, 2}
    for k, p in prefix.items():
        assert flat[k].startswith(p) and p.endswith("<|turn>model\n")
    spans = shape.response_spans(t).collect()
    for s in spans:
        body = flat[s["conv_id"]][s["span_start"]:s["span_end"]]
        content = dict(((c, i), txt) for c, msgs in convs.items() for i, (_, txt) in enumerate(msgs))[(s["conv_id"], s["turn"])]
        assert body.startswith(content + "<turn|>\n")
        assert "<|turn>user\n" not in body
    guard = shape.marker_guard(shape.flatten_text(t)).first()
    assert guard["markers_ok"] is False and guard["n_rows_missing_markers"] == 1
    empty = shape.marker_guard(spark.createDataFrame([], "text string")).first()
    assert empty["markers_ok"] is False


def test_prompt_gold(spark):
    convs = {1: [("user", "q"), ("assistant", "a")], 2: [("user", "q")], 3: [("user", "q"), ("assistant", "x"), ("user", "y"), ("assistant", "z")]}
    pg = {r["conv_id"]: (r["n_prompt_turns"], r["gold"]) for r in shape.prompt_gold(turns_df(spark, convs)).collect()}
    assert pg == {1: (1, "a"), 3: (3, "z")}


def packs_by_hand(lengths, size):
    want, pos = [], 0
    for k, n in sorted(lengths, key=lambda x: (x[0] is not None, x[0])):
        start = pos
        while n and pos < start + n:
            pack = pos // size
            end = min(start + n, (pack + 1) * size)
            want.append((k, pack, pos - pack * size, end - pos))
            pos = end
    return want


@pytest.mark.parametrize("slots", [8, 64, shape.KEY_SLOTS])
def test_wrapped_packing_matches_python(spark, slots):
    rng = random.Random(11)
    lengths = [(i * 3 + 1, rng.choice([0, 1, 5, 17, 40, 100])) for i in range(200)]
    df = spark.createDataFrame(lengths, "conv_id long, n_tokens long").repartition(3)
    got = sorted(tuple(r) for r in shape.wrapped_packing(df, 32, slots=slots).collect())
    assert got == sorted(packs_by_hand(lengths, 32))


def test_wrapped_packing_of_text_keys_null_keys_and_no_rows(spark):
    rng = random.Random(12)
    lengths = [(f"c{i:04d}", rng.choice([0, 3, 90, None])) for i in range(150)] + [(None, 50)]
    df = spark.createDataFrame(lengths, "conv_id string, n_tokens long").repartition(4)
    got = [tuple(r) for r in shape.wrapped_packing(df, 32, slots=32).collect()]
    assert sorted(got, key=str) == sorted(packs_by_hand(lengths, 32), key=str)
    assert shape.wrapped_packing(df.limit(0), 32).collect() == []


def test_key_blocks_are_even_and_in_order(spark):
    df = spark.range(40_000).select((F.col("id") * F.col("id")).alias("k"))  # far from uniform
    blocks = df.withColumn("bounds", shape.key_bounds(df, "k", 1024, 16).scalar()).withColumn("b", shape.block_of(F.col("k"), F.col("bounds")))
    got = blocks.groupBy("b").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).orderBy("b").collect()
    assert 60 <= len(got) <= 65 and max(r.n for r in got) < 3 * 40_000 / 64
    assert all(a.hi < b.lo for a, b in zip(got, got[1:]))


def test_seeded_sample(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = sorted(r["k"] for r in shape.seeded_sample(df, "k", 20).collect())
    b = sorted(r["k"] for r in shape.seeded_sample(df.repartition(7), "k", 20).collect())
    assert a == b and len(set(a)) == 20
    assert shape.seeded_sample(df, "k", 1000).count() == 500


def test_device_family_and_profiles(spark):
    import pytest

    names = ["NVIDIA A100-SXM4-40GB", "NVIDIA L4", "NVIDIA L40S", "Tesla T4", "H100", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(stats.device_family(F.col("name"))).collect()]
    assert got == ["A100", "L4", "OTHER", "T4", "OTHER", "OTHER"]
    assert stats.device_profile("t4")["gradient_accumulation"] == 16
    assert stats.device_profile(None, "A100")["max_train_rows"] is None
    with pytest.raises(ValueError):
        stats.device_profile("V100")


def test_statistics_with_all_splits_line(spark):
    df = spark.createDataFrame([("a", 10, 1, 4, 5), ("a", 20, 1, 4, 5), ("b", 30, 1, 4, 5)],
                               "split string, total_tokens long, n_turns long, prompt_tokens long, response_tokens long")
    st = {r["split"]: r for r in stats.dataset_statistics(df, with_total=True).collect()}
    assert set(st) == {"a", "b", "all"} and st["all"]["num_examples"] == 3 and st["all"]["max_total_tokens"] == 30
    ta = {r["split"]: r for r in stats.token_analysis(df, with_total=True).collect()}
    assert ta["all"]["median"] == 20.0 and ta["a"]["median"] == 15.0
    assert stats.token_analysis(df).count() == 2


def test_prompt_gold_records_empty_and_nested(spark):
    conv = spark.createDataFrame(
        [(1, []), (2, [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]), (3, [{"role": "user", "content": "q"}])],
        "conv_id long, messages array<struct<role:string,content:string>>",
    )
    rec = {r["conv_id"]: r for r in shape.prompt_gold_records(conv).collect()}
    assert set(rec) == {2} and rec[2]["gold"] == "a" and rec[2]["prompt_json"] == '[{"role":"user","content":"q"}]'
    first = {r["conv_id"]: len(r["prompt_messages"]) for r in shape.prompt_before_first_reply(conv).collect()}
    assert first == {1: 0, 2: 1, 3: 1}


def test_response_spans_blocks_match_single_level(spark):
    rng = random.Random(4)
    convs = {c: [(rng.choice(["user", "assistant", "system"]), "x" * rng.randint(0, 9)) for _ in range(rng.randint(1, 12))]
             for c in range(120)}
    t = turns_df(spark, convs)
    a = sorted(tuple(r) for r in shape.response_spans(t, block_turns=1024).collect())
    b = sorted(tuple(r) for r in shape.response_spans(t, block_turns=2).collect())
    c = sorted(tuple(r) for r in shape.response_spans(t, block_turns=3).collect())
    assert a == b == c and len(a) > 0
    flat = {r["conv_id"]: r["text"] for r in shape.flatten_text(t).collect()}
    for k, turn, s0, s1 in b:
        body = flat[k][s0:s1]
        assert body.startswith(convs[k][turn][1] + "<turn|>\n") and "<|turn>user\n" not in body


def test_merged_sketches_keep_their_rank_error(spark):
    # squares, a value held by a third of all rows, and a second split
    rows = spark.range(60000).selectExpr("CASE WHEN id % 3 = 0 THEN 777 ELSE id * id END AS v", "IF(id % 10 = 0, 'b', 'a') AS split", "id % 13 AS shard")
    parts = stats.quantile_sketches(rows, "v", "split", "shard", k=400)
    found = {(r["split"], r["p"]): r for r in stats.sketch_quantiles(stats.merge_sketches(parts, "split"), (0.1, 0.5, 0.95)).collect()}
    assert len(found) == 6
    values = {}
    for r in rows.collect():
        values.setdefault(r["split"], []).append(r["v"])
    for (split, p), r in found.items():
        n, q = len(values[split]), r["quantile"]
        room = 3 * stats.rank_error(400) * n + 1
        assert r["n"] == n and q in values[split]
        assert sum(v < q for v in values[split]) <= p * n + room and sum(v <= q for v in values[split]) >= p * n - room


def test_sketches_of_few_rows_and_nulls(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("n", None)], "split string, v bigint")
    got = {r["split"]: (r["n"], r["quantile"]) for r in stats.sketch_quantiles(stats.quantile_sketches(df, "v", "split"), (0.5,)).collect()}
    assert got == {"a": (1, 5), "n": (0, None)}
    assert stats.sketch_quantiles(stats.quantile_sketches(df.limit(0), "v", "split")).count() == 0
