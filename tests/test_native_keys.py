"""Native canonical keys equal the Python ones on random texts, and say so only where they do."""

import json
import random

from pyspark.sql import functions as F

from colloquy.functions import canonical, native_keys


def _value(rng, depth):
    kind = rng.randrange(12 if depth < 4 else 8)
    if kind < 4:
        return rng.choice(["", "a", "a b", "A!", "x/y", "it's", "é", 'q"q', "{", "tab\t", "\\", "null", "1", "~|~"])
    if kind < 6:
        return rng.choice([0, 1, -1, -0.0, 12, 10**14, 10**15, 10**20, -(10**14), 999999999999999])
    if kind == 6:
        return rng.choice([1.5, 1.0, 1e3, True, False, None])
    if kind == 7:
        return {}
    if kind < 10:
        return {rng.choice(["a", "ab", "a b", "a!", "B", "_", "é", "key", "k2", ""]): _value(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]


def _envelopes(rng):
    text = json.dumps({"status": _value(rng, 0), "x": _value(rng, 0)}, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 2]))
    return rng.choice([
        text, text, text + " trailing notes", text + " {\"a\": 1}", text + " }", text[:-1], text[:-1] + ',"x": 2}', "{" + text, text.replace(":", ": 0", 1),
        text.replace("1", "01"), text.replace("{", "{ ", 1), text + "\n\n", "{s: n}", "{}", '{"a": -0}', '{"a": 1,}', "{" * 30, '{"a": 1}x', text.replace(",", ",\r\n"),
    ])


def test_envelopes_equal_python(spark):
    rng = random.Random(8)
    texts = [_envelopes(rng) for _ in range(4000)] + [None, "{", '{"a":' * 600 + "1" + "}" * 600]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = native_keys.envelope(rows, F.col("t"), "n").collect()
    known = 0
    for r in rows:
        if r.n_known:
            known += 1
            assert r.n_key == canonical._canon_or_none(canonical.parse_envelope_tail(texts[r.i])), texts[r.i]
    assert known > 500


def _section(rng):
    words = ["LOOKUP", "yes", "no", "Yes", "yEs", "on", "null", "NULL", "true", "n", "y", "12", "0", "012", "-3", "1_000", "1.5", "a b", "~", "x:", "'q'", "2020-01-01", "nan", "0x1f", "b\r", "#c"]
    lines = [f"  {rng.choice(['a', 'b', 'operation', 'no', 'x_y', 'B', 'ab'])}: {rng.choice(words)}" for _ in range(rng.randrange(4))]
    if rng.random() < 0.1:
        lines.insert(0, rng.choice(["   a: b", "a: b", "  a:", "  - x", "\ta: b"]))
    return "\n".join([rng.choice(["semantic:", "semantic:", "on:", "semantic: x", "- a", "[unclosed", "semantic: "]), *lines])


def test_sections_equal_python(spark):
    rng = random.Random(9)
    texts = [_section(rng) for _ in range(4000)] + [None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = native_keys.semantic(rows, F.col("t"), "n").collect()
    known = 0
    for r in rows:
        if r.n_known:
            known += 1
            assert r.n_key == canonical._canon_or_none(canonical.parse_semantic(texts[r.i])), texts[r.i]
    assert known > 100
