"""Passages: larger groups meet whole, and only what other documents have too is worked on."""

import os
import random

import numpy as np

from colloquy.llm import passages

from .conftest import words


def covered(spans, later: bool) -> dict[int, set[int]]:
    out: dict[int, set[int]] = {}
    for k, lo, hi, is_later in spans:
        if is_later or not later:
            out.setdefault(k, set()).update(range(lo, hi))
    return out


def test_passages_around_a_common_phrase_are_found(docs_of):
    """A phrase of 200 documents stands in passages of which two documents each have one: a function
    whose minimum lies in the phrase meets in a large group only, and has to count there."""
    rng = random.Random(21)
    phrase = words(rng, 30, 20_000)
    texts = [words(rng, 120, 20_000) for _ in range(300)]
    pairs = [(2 * i, 2 * i + 1) for i in range(60)]
    for a, b in pairs:
        passage = words(rng, 18, 20_000) + phrase + words(rng, 18, 20_000)
        near = list(passage)
        near[5] = "other"
        texts[a][30:30], texts[b][50:50] = passage, near
    for x in texts[120:260]:
        x[60:60] = phrase
    got = {r.k: r for r in passages.near_duplicate_passages(docs_of([(i, " ".join(x)) for i, x in enumerate(texts)])).collect()}
    seqs = [s for *_, s in passages._sequences(_batch(texts), 50)]
    want = {b for a in range(300) for b in range(a + 1, 300) if passages.matched(seqs[b], seqs[a], 46, 0.8)}
    assert want == {b for _, b in pairs}
    assert {k for k, r in got.items() if r.removed} == want


def _batch(texts):
    import pyarrow as pa

    n = len(texts)
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array([" ".join(x) for x in texts])], ["k", "t", "x"])


def test_stretches_of_a_large_group_all_meet(spark, monkeypatch):
    """Against all pairs, with several slices; what is covered from end to end needs no more."""
    monkeypatch.setattr(passages, "SLICE", 30)
    rng = np.random.default_rng(22)
    base = [rng.integers(1, 1 << 32, 80) for _ in range(12)]
    seqs = []
    for i in range(90):
        x = np.concatenate([base[rng.integers(12)], rng.integers(1, 1 << 32, rng.integers(0, 30)), base[rng.integers(12)]])
        x[rng.integers(0, len(x), rng.integers(0, 12))] = rng.integers(1, 1 << 32)
        seqs.append(x.astype("<u4"))
    rows = [(c, c // 2, 7, bytes([c]), c % 5 == 0, len(x), x.tobytes(), b"") for c, x in enumerate(seqs)]  # two of each document
    distinct = spark.createDataFrame(rows, "c long, k long, t long, digest binary, many boolean, n int, low binary, high binary")
    group = [(v, c, c, 0, len(seqs[c]) - 1, 1, 0) for v in (8, 9) for c in range(90) if v == 8 or c % 3]
    large = spark.createDataFrame(group, "key long, k long, t long, lo int, hi int, bits int, c int")
    none = spark.createDataFrame([], "k long, t long, lo int, hi int, later boolean")
    pairs = {(r.a, r.b) for r in passages.left_over(large, none, over=1).select("a", "b").distinct().collect()}
    assert pairs == {(a, b) for b in range(90) for a in range(b)}
    want = []
    for a, b in pairs:
        inside = a // 2 == b // 2
        if not inside or a % 5 == 0 or b % 5 == 0:
            for lo, hi, x, y in passages.matched(seqs[b], seqs[a], 46, 0.8):
                want += [(b, lo, hi + 4, not inside), (a, x, y + 4, False)]
    got = [(r.k, r.lo, r.hi, r.later) for r in passages.rest(large, none, distinct, 50, 0.8).collect()]
    assert got and set(got) <= set(want)
    for later in (True, False):
        assert covered(got, later) == covered(want, later)
    done = spark.createDataFrame([(c, c, 0, len(x) + 4, later) for c, x in enumerate(seqs) for later in (True, False)], none.schema)
    assert passages.left_over(large, done, large.selectExpr("k", "t", "hi + 5 AS words").distinct(), over=1).count() == 0
    assert passages.rest(large, done, distinct, 50, 0.8).count() == 0


def test_only_what_other_documents_have_is_kept(docs_of, monkeypatch):
    rng = random.Random(23)
    texts = [words(rng, 200, 20_000) for _ in range(40)]
    passage = words(rng, 70, 20_000)
    for d in (3, 8, 30):
        texts[d][40:40] = passage
    texts.append(texts[12])
    kept, stage = {}, passages.stage

    def noted(df, name):
        kept[name] = out = stage(df, name)
        return out

    gone: list[str] = []
    unstage = passages.unstage
    monkeypatch.setattr(passages, "stage", noted)
    monkeypatch.setattr(passages, "unstage", lambda df: (gone.extend(df.inputFiles()), unstage(df)))
    docs = docs_of([(i, " ".join(x)) for i, x in enumerate(texts)])
    got = {r.k: [tuple(s) for s in r.removed] for r in passages.near_duplicate_passages(docs).collect()}
    assert got == {3: [], 8: [(40, 110)], 30: [(40, 110)], 12: [], 40: [(0, 200)]}
    assert sorted((r.k, r.lo, len(r.high)) for r in kept["passage-stretches"].collect()) == [(3, 40, 66), (8, 40, 66), (12, 0, 196), (30, 40, 66), (40, 0, 196)]
    assert kept["passage-contents"].count() == 2  # equal stretches are one
    assert gone and not any(os.path.exists(f.removeprefix("file:")) for f in gone)


def test_dense_ranges_by_brute_force():
    rng = np.random.default_rng(24)
    for _ in range(200):
        hit = rng.random(rng.integers(0, 150)) < rng.choice([0.5, 0.8, 0.95])
        on = np.zeros(len(hit), bool)
        for i in range(len(hit) - 19):
            if hit[i : i + 20].sum() >= 16:
                on[i : i + 20] = True
        want, i = [], 0
        while i < len(on):
            j = i
            while j < len(on) and on[j]:
                j += 1
            if j > i:
                inside = [x for x in range(i, j) if hit[x]]
                if inside[-1] - inside[0] + 1 >= 20:
                    want.append((inside[0], inside[-1] + 1))
            i = j + 1
        assert passages.dense(hit, 20, 0.8) == want
