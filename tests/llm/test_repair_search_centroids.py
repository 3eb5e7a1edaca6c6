"""Conversation repair, multi-index hashing and centroid clustering against brute force."""

import functools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import centroids, hamming, repair

# --- conversation repair ----------------------------------------------------------------


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        d = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def expected(conv, rows):
    md5 = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    rows = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], md5(r[2], r[3])))
    turns = {r[1] for r in rows if r[1] is not None}
    count, seen, faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            count[fault] += 1
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, word, lines = cheapest(rows, faults)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *count.values(), illegal, cost, word, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def cheapest(rows, faults):
    """Best (cost, word, lines), found from the last row backwards over all edits and whole role strings' ends."""

    @functools.cache
    def best(i, roles, inserted):
        # roles: "", "s", or the last initial after a first u
        found = []
        if i == len(rows) and roles in ("", "a"):
            found.append((0, "", ()))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[roles]
        name = {"u": "user", "a": "assistant"}
        if inserted < 3:
            for r in follow.replace("s", ""):
                if rest := best(i, r, inserted + 1):
                    found.append((rest[0] + 3, "I" + rest[1], (f"{name[r]}:", *rest[2])))
        if i < len(rows):
            if rest := best(i + 1, roles, 0):
                found.append((rest[0] + 4, "D" + rest[1], rest[2]))
            if faults[i] not in ("blank", "duplicate"):
                extra, role, text = 3 * (faults[i] == "truncated"), rows[i][2], rows[i][3]
                if role[:1] and role[:1] in follow and (rest := best(i + 1, role[:1], 0)):
                    found.append((rest[0] + extra, "K" + rest[1], (f"{role}:{text}", *rest[2])))
                for r in follow.replace("s", ""):
                    if rest := best(i + 1, r, 0):
                        found.append((rest[0] + 3 + extra, "R" + rest[1], (f"{name[r]}:{text}", *rest[2])))
        return min(found, default=None)

    return best(0, "", 0)


TEXTS = ["Yes.", "No!", "Why?  \n", "cut", " \t", "", "Yes.", "long. tail"]


def test_repairs_by_plain_search(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(120):
        for turn in sorted(rng.sample(range(-4, 9), rng.randrange(0, 6))):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "", "user", "assistant", None]), rng.choice([*TEXTS, None])))
    rows += [(500, None, "user", "a."), (500, None, "user", "a."), (500, None, "assistant", "b."), (500, 3, "user", "a."), (None, 1, "user", "x."), (None, 2, "assistant", "y."), (501, 0, "user", "same."), (501, 0, "user", "same."), (501, 0, "system", "z.")]
    table = spark.createDataFrame([(*r, "n", 1) for r in rows], "conv_id long, turn long, role string, text string, word string, blk int").repartition(3)
    got = {tuple(r) for r in repair.repair(repair.damaged(table), table.select("conv_id").distinct()).collect()}
    hurt = damaged(rows)
    assert got == {expected(c, hurt) for c in {r[0] for r in rows}}


@pytest.fixture
def undamaged(spark):
    def make(rows):
        return spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(3)

    return make


def test_blocks_give_what_one_block_gives(spark, undamaged, monkeypatch):
    rng = random.Random(4)
    rows = [("hot", t // 3, rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"t{t % 50}.", "cut", "", "Yes."])) for t in range(900)]
    rows += [(f"c{i}", t, rng.choice(["user", "assistant"]), f"x{t}.") for i in range(30) for t in range(rng.randrange(1, 9))]
    table = undamaged(rows)
    ids = table.select("conv_id").distinct()
    whole = {tuple(r) for r in repair.repair(table, ids).collect()}
    for block, step in ((3, 512), (10, 7), (2, 3)):
        monkeypatch.setattr(repair, "BLOCK", block)
        monkeypatch.setattr(repair, "STEP", step)
        assert {tuple(r) for r in repair.repair(table, ids).collect()} == whole
    assert next(r for r in whole if r[0] == "hot")[6] > 0


def test_conversations_without_rows_and_empty_tables(spark, undamaged):
    empty = hashlib.sha256(b"").hexdigest()
    ids = spark.createDataFrame([("a",), (None,)], "conv_id string")
    got = {tuple(r) for r in repair.repair(undamaged([]), ids).collect()}
    assert got == {("a", 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)}
    assert repair.repair(undamaged([]), ids.limit(0)).collect() == []
    long = "w " * 200_000 + "end."
    got = repair.repair(undamaged([("a", 0, "user", long), ("a", 1, "assistant", "")]), ids.limit(1)).collect()
    assert [tuple(r) for r in got] == [("a", 0, 1, 0, 0, 0, 7, "KDI", hashlib.sha256(f"user:{long}\nassistant:".encode()).hexdigest())]


def test_agenda_stops_at_the_goal():
    edges = {"a": [(1, "b"), (5, "c")], "b": [(1, "c"), (9, "d")], "c": [(1, "d")], "d": [(1, "e")]}
    final = repair.lightest([((0, ""), "a")], lambda x, w: [((w[0] + c, w[1] + y), y) for c, y in edges.get(x, [])], lambda x: x == "d")
    assert final["d"][0] == (3, "bcd") and "e" not in final


# --- multi-index hashing ----------------------------------------------------------------


def clustered(rng, n, dims, spread):
    centres = rng.normal(size=(6, dims))
    return (centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims))).astype(np.float32)


ODD = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, float("inf")] + [0.0] * 6, [None] + [1.0] * 7]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key long, raw string, code long").repartition(3)


@pytest.mark.parametrize(("dims", "spread"), [(8, 0.5), (64, 1.0), (96, 0.05)])
def test_recall_and_scores_of_hashed_search(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(hamming, "ROWS", 128)
    monkeypatch.setattr(hamming, "QUERIES", 8)
    rng = np.random.default_rng(dims)
    x = clustered(rng, 900, dims, spread) * rng.uniform(1e-3, 1e3, (900, 1)).astype(np.float32)
    x[100:140] = x[99]  # equal vectors
    rows = [(i, v.tolist(), 0, i, "r", 1) for i, v in enumerate(x)] + [(2000 + i, v, 0, 1, None, None) for i, v in enumerate(ODD)] + [(None, x[0].tolist(), 0, 0, "", 0)]
    got = hamming.search(vectors(spark, rows), lambda k: F.pmod(k, F.lit(20)) == 0).collect()
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, 900, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and q not in {r.vec_id for r in mine}
        score = y @ y[q]
        assert all(math.isclose(r.score, score[r.vec_id], abs_tol=1e-12) for r in mine)
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(mine, mine[1:]))
        score[q] = -2
        want = set(np.lexsort((np.arange(900), -np.round(score, 12)))[:5].tolist())
        hits, total = hits + len(want & {r.vec_id for r in mine}), total + 5
    assert len(got) == total and hits >= 0.95 * total
    assert {r.vec_id for r in got if r.query_id == 100} == {99, 101, 102, 103, 104}


def test_hashed_search_small_and_empty(spark):
    few = [(0, [1.0, 2.0], 0, 0, "", 0), (1, [1.0], 0, 0, "", 0), (1, [1.0], 0, 0, "", 0), (0, [5.0, 9.0], 0, 0, "", 0), (3, [1e30, 2e30], 0, 0, "", 0)]
    got = hamming.search(vectors(spark, few), lambda k: k == 0).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 3), (2, 1)] and max(r.score for r in got) == pytest.approx(1, abs=1e-3)
    for rows in ([], few[:1], [(0, None, 0, 0, "", 0)]):
        assert hamming.search(vectors(spark, rows), lambda k: k == 0).collect() == []


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    code = rng.integers(0, 2**64, 300, dtype=np.uint64)
    code[50:90] = code[0] ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64))
    query, radius = code[:60], np.arange(60) % 30
    q, row = hamming.Index(code).within(query, radius)
    near = np.bitwise_count(query[:, None] ^ code[None]) <= radius[:, None]
    assert set(zip(q.tolist(), row.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(near))))


# --- centroids --------------------------------------------------------------------------


def by_hand(rows, k, rounds, dims):
    ok = [(i, [math.floor(256 * float(c)) if abs(c) < 1e300 else int(c) * 256 for c in v]) for i, v in rows if v is not None and len(v) == dims and None not in v and all(map(math.isfinite, v))]
    first = sorted(ok, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())[:k]
    c = [v for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c)) for _, v in ok]

    for _ in range(rounds):
        got = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (_, g) in zip(ok, got) if g == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    got = assign()
    return sorted((i, g, d) for (i, _), (d, g) in zip(ok, got)), c


@pytest.mark.parametrize("scale", [1.0, 0.01, 1e6])
def test_clusters_by_hand(spark, scale):
    rng = np.random.default_rng(6)
    x = clustered(rng, 150, 16, 0.8) * np.float32(scale)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200 + i, rows_) for i, rows_ in enumerate(x[:20].tolist())]
    rows += [(300, None), (301, [1.0] * 15), (302, [None] + [1.0] * 15), (303, [float("inf")] * 16)]
    got, c = centroids.cluster(vectors(spark, [(*r, 0, 0, "", 0) for r in rows]), k=12, rounds=3, dims=16)
    want, means = by_hand(rows, 12, 3, 16)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert [[int(v) for v in m] for m in c] == means


def test_few_vectors_large_values_and_none(spark):
    rows = [(1, [1e305] * 4), (2, [0.5] * 4), (2, [0.5] * 4), (None, [-0.1] * 4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, c = centroids.cluster(table, k=40, rounds=2, dims=4)
    assert sorted(((r.vec_id or 0), r.distance) for r in got.collect()) == [(0, 0), (1, 0), (2, 0), (2, 0)] and len(c) == 4
    none, c = centroids.cluster(table.limit(0), dims=4)
    assert none.collect() == [] and len(c) == 0


def test_scan_measures_few_centroids_when_means_differ():
    rng = np.random.default_rng(7)
    c = centroids.whole(rng.normal(size=(40, 64)) + np.arange(40)[:, None])
    x = centroids.whole(rng.normal(size=(500, 64)) + rng.integers(0, 40, (500, 1)))
    number, best, measured = centroids.nearest(x, c)
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < 6 * len(x)


def test_a_text_costs_the_same_whatever_the_word_cache_holds():
    from colloquy.llm.wordcache import WordCache

    class Counted(WordCache):
        looked = 0

        def __contains__(self, word):
            Counted.looked += 1
            return super().__contains__(word)

        def __iter__(self):
            raise AssertionError("walks the cache")

        def keys(self):
            raise AssertionError("walks the cache")

    cache = Counted(lambda ws: [w.encode() for w in ws], limit=200_000)
    cache.learn([f"w{i}" for i in range(100_000)])
    Counted.looked = 0
    cache.learn(["w1", "w2", "new"])
    assert Counted.looked == 3 and cache.join(["new", "w1"]) == b"neww1"
