"""Validation rules on both lanes, reject report and line numbers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from colloquy.operators import validate as V
from colloquy.plans import jobs
from colloquy.sources import jsonl


def turns_df(spark, convs):
    rows = [(cid, i, role, text) for cid, msgs in convs.items() for i, (role, text) in enumerate(msgs)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def verdicts(spark, convs):
    return {r["conv_id"]: r["reason"] for r in V.validate_turns(turns_df(spark, convs)).collect()}


def test_typed_lane_rules(spark):
    convs = {
        1: [("system", "s"), ("user", "ctx"), ("user", "q"), ("assistant", "a")],
        2: [("user", "q"), ("bot", "a")],
        3: [("user", "   ")],
        4: [("user", "q"), ("system", "s")],
        5: [("assistant", "a"), ("user", "q")],
        6: [("user", "q"), ("assistant", "a"), ("assistant", "b")],
        7: [("system", "s")],
        8: [("user", "q"), (None, "x")],
        9: [("system", "s"), ("assistant", "a")],
        10: [("user", "q"), ("assistant", "a"), ("user", "　\n")],
        11: [("bot", "  "), ("system", "x")],
    }
    got = verdicts(spark, convs)
    assert got == {
        1: None,
        2: "turn_1_invalid_role:bot",
        3: "turn_0_empty_content",
        4: "system_role_not_first",
        5: "does_not_start_with_user_turn",
        6: "consecutive_assistant_turns",
        7: "no_user_or_assistant_turns",
        8: "turn_1_invalid_role:None",
        9: "does_not_start_with_user_turn",
        10: "turn_2_empty_content",
        11: "turn_0_invalid_role:bot",
    }


def _lines(spark, lines):
    df = spark.createDataFrame([(i + 1, x) for i, x in enumerate(lines)], "line_no long, value string")
    return {r["line_no"]: r["reason"] for r in jsonl.validate_lines(df).collect()}


def test_raw_lane_rules(spark):
    good = json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "x": 1})
    lines = [
        "[1, 2, 3]", "{}", '{"messages": []}', '{"messages": null}', '{"messages": "x"}', "{broken",
        good, "", '{"messages": [{"role": "bot", "content": "a"}]}', '{"messages": [{"role": "user", "content": " "}]}',
        '{"messages": [{"role": "user", "content": 0}]}', '{"messages": [{"role": 5, "content": "x"}]}',
        '{"messages": ["hello"]}', good + " trailing",
    ]
    got = _lines(spark, lines)
    assert got == {
        1: "not_a_json_object",
        2: "missing_messages_key",
        3: "messages_not_a_nonempty_list",
        4: "missing_messages_key",
        5: "messages_not_a_nonempty_list",
        6: "invalid_json:Expecting property name enclosed in double quotes",
        7: None,
        9: "turn_0_invalid_role:bot",
        10: "turn_0_empty_content",
        11: "turn_0_empty_content",
        12: "turn_0_invalid_role:5",
        13: "turn_0_not_a_dict",
        14: "invalid_json:Extra data",
    }


def test_lanes_agree_on_random_conversations(spark):
    import random

    rng = random.Random(7)
    roles = ["system", "user", "assistant", "bot", None]
    texts = ["q", " ", "", None, "a b", " "]
    convs = {}
    for cid in range(300):
        n = rng.randint(1, 6)
        convs[cid] = [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]
    typed = verdicts(spark, convs)
    lines = [json.dumps({"messages": [{"role": r, "content": t} for r, t in convs[c]]}) for c in range(300)]
    raw = _lines(spark, lines)
    assert [typed[c] for c in range(300)] == [raw[c + 1] for c in range(300)]


def test_line_numbers_and_report(spark, tmp_dir):
    path = os.path.join(tmp_dir, "train.jsonl")
    good = json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]})
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([good, "", "{broken", good, "   ", "[1]", good]) + "\n")
    load = jobs.load_split(spark, path, "train")
    rep = load.report.first()
    assert (rep["total"], rep["valid"], rep["invalid"]) == (5, 3, 2)
    assert rep["dropped"] == [3, 6]
    assert load.valid.count() == 3
    text = list(jobs.validation_text(load))
    assert any("dropped=[3,6]" in x for x in text) and text.index("# reasons") == 2
    assert sorted(x.split("; first_seen")[0] for x in text[3:]) == [
        "reason=invalid_json:Expecting property name enclosed in double quotes; n=1", "reason=not_a_json_object; n=1"
    ]
    assert jsonl.count_nonblank_lines(spark, path) == 5
    assert jsonl.read_json_lines(spark, path).count() == 4


def test_train_and_optional_sources(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        jobs.load_train(spark, os.path.join(tmp_dir, "missing.jsonl"))
    bad = os.path.join(tmp_dir, "bad.jsonl")
    with open(bad, "w") as f:
        f.write("{}\n")
    with pytest.raises(ValueError):
        jobs.load_train(spark, bad)
    assert jobs.load_optional(spark, None, "val") is None
    assert jobs.load_optional(spark, os.path.join(tmp_dir, "nope.jsonl"), "golden") is None
    assert jobs.load_optional(spark, bad, "val").valid is None


def test_seeded_cap(spark, tmp_dir):
    path = os.path.join(tmp_dir, "many.jsonl")
    good = [json.dumps({"messages": [{"role": "user", "content": f"q{i}"}]}) for i in range(40)]
    with open(path, "w") as f:
        f.write("\n".join(good) + "\n")
    a = [r["line_no"] for r in jobs.load_split(spark, path, "train", max_samples=10).valid.collect()]
    b = [r["line_no"] for r in jobs.load_split(spark, path, "train", max_samples=10).valid.collect()]
    assert len(a) == 10 and sorted(a) == sorted(b)


def test_reason_histogram_order(spark):
    convs = {i: [("bot", "x")] for i in range(3)}
    convs.update({10 + i: [("user", " ")] for i in range(3)})
    convs[20] = [("assistant", "a")]
    h = V.reason_histogram(V.validate_turns(turns_df(spark, convs))).collect()
    assert [(r["reason"], r["n"]) for r in h][-1] == ("does_not_start_with_user_turn", 1)
    assert {r["reason_class"] for r in h} == {"turn_i_invalid_role", "turn_i_empty_content", "does_not_start_with_user_turn"}
    assert F is not None


def test_line_numbers_across_many_splits(spark, tmp_dir):
    import random

    rng = random.Random(1)
    expected = {}
    for f in range(3):
        path = os.path.join(tmp_dir, f"part-{f}.jsonl")
        lines = []
        for i in range(400):
            lines.append("" if rng.random() < 0.1 else json.dumps({"f": f, "i": i, "pad": "x" * rng.randint(0, 80)}))
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        for n, text in enumerate(lines, start=1):
            expected[(f, n)] = text
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        rows = jsonl.read_lines(spark, os.path.join(tmp_dir, "part-*.jsonl")).collect()
        assert spark.read.text(os.path.join(tmp_dir, "part-*.jsonl")).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {(int(r["file"].rsplit("-", 1)[1].split(".")[0]), r["line_no"]): r["value"] for r in rows}
    assert got == expected


def test_invalid_utf8_and_mixed_newlines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mixed.jsonl")
    good = json.dumps({"messages": [{"role": "user", "content": "q"}]}).encode()
    bad_utf8 = b'{"messages": [{"role": "user", "content": "caf\xff"}]}'
    with open(path, "wb") as fh:
        fh.write(good + b"\r\n" + bad_utf8 + b"\r" + b"   " + b"\n" + good + b"\n")
    lines = jsonl.read_lines(spark, path).orderBy("line_no").collect()
    assert [r["line_no"] for r in lines] == [1, 2, 3, 4]
    checked = {r["line_no"]: r for r in jsonl.validate_lines(jsonl.read_lines(spark, path)).collect()}
    assert set(checked) == {1, 2, 4}  # the blank line 3 is not a record
    assert checked[2]["reason"] is None and checked[2]["has_replacement_char"] is True
    assert checked[1]["has_replacement_char"] is False
    assert jsonl.count_nonblank_lines(spark, path) == 3


def _numbered_split(spark, tmp_dir):
    """Two files of many blocks; returns their loaded split and {(file, line_no): text}."""
    expected = {}
    for f in range(2):
        lines = []
        for i in range(300):
            good = json.dumps({"messages": [{"role": "user", "content": f"q{f}-{i} " + "x" * (i % 70)}, {"role": "assistant", "content": "a"}]})
            lines.append("  " if i % 7 == 3 else "{broken" if i % 11 == 5 else good)
        with open(os.path.join(tmp_dir, f"part-{f}.jsonl"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        expected |= {(f, n): text for n, text in enumerate(lines, start=1)}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        return jobs.load_split(spark, os.path.join(tmp_dir, "part-*.jsonl"), "train"), expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _place(row):
    return int(row["file"].rsplit("-", 1)[1].split(".")[0]), row["line_no"]


def test_late_line_numbers(spark, tmp_dir):
    load, expected = _numbered_split(spark, tmp_dir)
    rejected = load.verdicts.where("reason IS NOT NULL").collect()
    assert sorted(map(_place, rejected)) == sorted(p for p, text in expected.items() if text == "{broken")
    valid = {_place(r): r["messages"][0]["content"] for r in load.valid.collect()}
    assert valid == {p: json.loads(text)["messages"][0]["content"] for p, text in expected.items() if text.startswith('{"')}
    assert load.report.first()["total"] == sum(bool(text.strip()) for text in expected.values())
    assert load.valid.select(*jobs.LINE_KEY).distinct().count() == load.valid.count()


def test_unasked_line_numbers_cost_nothing(spark, tmp_dir):
    load, _ = _numbered_split(spark, tmp_dir)
    plan = load.valid.select("file", "messages")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    rejected = load.verdicts.where("reason IS NOT NULL").select("file", "line_no", "reason")._jdf.queryExecution().executedPlan().toString()
    assert "Join" in rejected and "messages" not in rejected  # only narrow columns are joined


def test_split_of_blank_lines_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "blank.jsonl")
    with open(path, "w") as fh:
        fh.write("\n  \n\n")
    load = jobs.load_split(spark, path, "train")
    assert load.valid.count() == 0 and load.verdicts.count() == 0
    with pytest.raises(ValueError):
        jobs.load_train(spark, path)


def test_one_task_reads_many_small_blocks(spark, tmp_dir):
    for i in range(6):
        with open(f"{tmp_dir}/part-{i}.txt", "w") as f:
            f.writelines(f"{i}:{n} {'x' * 40}\n" for n in range(1, 101))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1024", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = jsonl.block_lines(spark, tmp_dir)
            assert lines.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
            assert lines.select("file", "block").distinct().count() > 20
            rows = jsonl.read_lines(spark, tmp_dir).collect()
            assert len(rows) == 600 and all(int(r["value"].split()[0].split(":")[1]) == r["line_no"] for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
