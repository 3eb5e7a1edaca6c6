"""Vector operators against brute force, the pipeline, and what is registered."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from colloquy.llm import neardup, packing, quality, queries, topk

from .test_text_operators import print_by_hand


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, key long, raw string").repartition(3)


def clustered(rng, n, dims, spread):
    centres = rng.normal(size=(6, dims))
    return (centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims))).astype(np.float32)


ODD = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, float("inf")] + [0.0] * 6, [None] + [1.0] * 7]


def rows_of(x, odd):
    rows = [(i, v.tolist(), 0, i, "r") for i, v in enumerate(x)]
    rows += [(i, rows[i - len(x)][1], 0, i, "r") for i in range(len(x), len(x) + 40)]  # exact copies
    return rows + [(1000 + i, v, None, 1, None) for i, v in enumerate(odd)]


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(1)
    x = clustered(rng, 300, 8, 0.5) * rng.uniform(0.1, 3, (300, 1)).astype(np.float32)
    rows = rows_of(x, ODD)
    got = topk.search(table(spark, rows), lambda k: F.pmod(k, F.lit(20)) == 0).collect()
    ok = [(i, np.floor(64 * np.array(list(v) + [0.0] * (8 - len(v)), float)).astype(int)) for i, v, *_ in rows if v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for q, a in ok:
        if q % 20 == 0:
            best = sorted((-int(a @ b), i) for i, b in ok if i != q)[:20]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_top_k_small_and_empty(spark):
    few = topk.search(table(spark, [(0, [1.0, 2.0], 0, 0, ""), (1, [1.0], 0, 0, ""), (None, [9.0, 9.0], 0, 0, "")]), lambda k: k == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in few] == [(0, 1, 1, 4096)]
    assert topk.search(table(spark, []), lambda k: k == 0).collect() == []
    assert topk.search(table(spark, [(1, [1.0], 0, 0, "")]), lambda k: k == 0).collect() == []


def test_top_k_keeps_long_vectors(spark, monkeypatch):
    """Integer forms over 2 ** 31, scores beyond a long, and blocks ruled out by their length."""
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES", 8)
    got = topk.search(table(spark, [(0, [1.0, 2.0], 0, 0, ""), (1, [3e8, 0.0], 0, 0, ""), (2, [1.0, 0.0], 0, 0, "")]), lambda k: k == 0).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 64 * 64 * 300_000_000), (2, 64 * 64)]
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(400, 6)) * 10.0 ** rng.uniform(-1, 1, (400, 1))).astype(np.float32)
    x[::7] *= np.float32(1e9)
    x[::31] *= np.float32(1e20)
    rows = [(i, v.tolist(), 0, i, "r") for i, v in enumerate(x)]
    got = topk.search(table(spark, rows), lambda k: F.pmod(k, F.lit(20)) == 0).collect()
    whole = [[int(c) for c in np.floor(64 * v.astype(float)).tolist()] for v in x]
    held = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    want = []
    for q in range(0, 400, 20):
        best = sorted((-held(sum(a * b for a, b in zip(whole[q], v))), i) for i, v in enumerate(whole) if i != q)[:20]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


@pytest.mark.parametrize("spread", [0.15, 0.5])
def test_links_by_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(neardup, "ROWS", 64)  # several blocks
    rng = np.random.default_rng(2)
    x = clustered(rng, 400, 8, spread)
    rows = rows_of(x, ODD)
    got = {r.key: (r.n_links, r.component_id) for r in neardup.near_duplicates(table(spark, rows)).collect()}
    ids = [i for i, *_ in rows if i < 1000]
    y = np.array([v for i, v, *_ in rows if i < 1000], float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], label[near[i]].min(initial=10**9)) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    assert near.sum() > 0
    assert {i: got[i] for i in ids} == {i: (int(near[n].sum()), int(label[n])) for n, i in enumerate(ids)}
    assert {i: got[i] for i in range(1000, 1006)} == {i: (0, i) for i in range(1000, 1006)}


def test_no_vectors(spark):
    assert neardup.near_duplicates(table(spark, [])).collect() == []
    assert [tuple(r) for r in neardup.near_duplicates(table(spark, [(7, None, 0, 0, "")])).collect()] == [(7, 0, 7)]


def test_registered_names():
    import __spark_entry__ as entry

    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in queries.QUERIES)] == []
    assert set(queries.ORACLE) <= set(queries.QUERIES) and "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "simhash", "pii", "packing"]


def test_entry_without_these_folders(tmp_path):
    """The rest imports and registers when the subpackage and the pipeline are gone."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "colloquy"), tmp_path / "colloquy", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') for q in e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr[-500:]
    assert out.stdout.split()[1:] == ["False", "False"]


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = corpus_pipeline.read(spark, sf, "documents")
    before, names = docs.count(), docs.columns
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, sf), f"test-{name}")
        if name != "packing":
            assert docs.columns == names and 0 < docs.count() <= before
            before = docs.count()
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} and docs.where("length <= 0 OR length > 4096").isEmpty()


CLASH = ("key", "k", "t", "fp", "line", "score", "features", "__llm_may", "__llm_key", "__llm_fp", "__llm_hits")


def corpus_folder(spark, folder, rows):
    """A folder with documents (their columns and clashing ones) and labels; returns its documents."""
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASH)
    table = [(k, t, "en", "s", None if t is None else len(t), *CLASH) for k, t, _ in rows]
    spark.createDataFrame(table, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, q) for k, _, q in rows if k is not None and q is not None]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.read(spark, str(folder), "documents")


def line_survivors(rows):
    """Every row's text after line dedup, by comparing every line with all earlier ones."""
    seen, out = [], []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept = []
        for x in (t or "").split("\n"):
            s = frozenset(x.split())
            if not s or not any(len(s & y) >= 0.8 * len(s | y) - 1e-9 for y in seen):
                kept.append(x)
            seen += [s] if s else []
        out.append((k, None if t is None else "\n".join(kept)))
    return out


def kept_of_components(rows):
    """The smallest id of each component of fingerprints at most four bits apart."""
    left = {}
    for k, t in rows:
        left.setdefault(print_by_hand(t), []).append(k)
    best = []
    while left:
        x, ids = left.popitem()
        todo = [x]
        while todo:
            x = todo.pop()
            for y in [y for y in left if (x ^ y).bit_count() <= 4]:
                ids += left.pop(y)
                todo.append(y)
        best.append(min((k for k in ids if k is not None), default=None))
    return best


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_pipeline_by_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(21)
    good, bad = [f"plain{i}" for i in range(400)], [f"junk{i}" for i in range(60)]
    line = lambda pool: " ".join(rng.choices(pool, k=rng.randrange(6, 25)))
    rows = [(i, "\n".join(line(bad if i % 5 == 0 else good) for _ in range(rng.randrange(3, 7))), int(i % 5 > 0)) for i in range(150)]
    shared, card = line(good), "4012888888881881"
    for i in (1, 7, 33, 92):
        rows[i] = (i, f"{rows[i][1]}\n{shared}\nplain1 plain2 card {card} of {i}", 1)
    base = [rng.choice(good) for _ in range(400)]
    rows += [(200 + i, "\n".join(" ".join(x if rng.random() > 0.02 else "plain3" for x in base[j : j + 40]) for j in range(0, 400, 40)), None) for i in range(4)]  # near copies
    rows += [(300, rows[2][1], 1), (301, rows[2][1], None), (302, None, None), (303, "", None), (304, " \n\t", None), (305, "plain9 " * 20_000, None), (None, line(good), None), (306, line(good), None)]
    rows.append(rows[-1])  # a row that is there twice
    docs = corpus_folder(spark, tmp_path, rows)
    names, tables = docs.columns, {"start": docs}
    for name, step in corpus_pipeline.STAGES:
        docs = tables[name] = corpus_pipeline.stage(step(spark, docs, str(tmp_path)), f"by-hand-{name}")
        if name != "packing":
            assert docs.columns == names and all(tuple(r[c] for c in CLASH) == CLASH for r in docs.collect())
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in docs.collect())

    # quality: the rows that the scores of op4's path accept, the good ones among them
    labels = corpus_pipeline.read(spark, str(tmp_path), "labels")
    scored = collections.Counter(r.doc_id for r in quality.classify(tables["start"], labels).where("predicted = 1").collect())
    assert collections.Counter(r.doc_id for r in tables["quality"].collect()) == scored
    accepted = {k for k, _ in pairs(tables["quality"])}
    assert sum((k in accepted) == bool(q) for k, _, q in rows if k is not None and k < 150) >= 145
    assert pairs(tables["lines"]) == sorted(line_survivors(pairs(tables["quality"])), key=str)
    kept = kept_of_components(pairs(tables["lines"]))
    assert sorted((k for k, _ in pairs(tables["simhash"])), key=str) == sorted(kept, key=str)
    assert set(pairs(tables["simhash"])) <= set(pairs(tables["lines"]))
    before, after = dict(pairs(tables["simhash"])), dict(pairs(tables["pii"]))
    assert before.keys() == after.keys()
    new = {t.split(" card ")[1].split()[0] for k, t in after.items() if t and " card " in t}
    assert len(new) == 1 and card not in new and all(len(x) == 16 for x in new)  # equal cards stay linked
    assert all(after[k] == (t if t is None else t.replace(card, *new)) for k, t in before.items())

    library, found = Tokenizer.from_file(packing.vocabulary()), collections.defaultdict(list)
    for p in tables["packing"].collect():
        found[p.doc_id].append((p.start, p.length, p.ids_crc32))
    assert found.keys() == after.keys()
    for k, t in after.items():
        ids, at = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for start, length, crc in sorted(found[k]):
            assert start == at and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    corpus_folder(spark, tmp_path, [])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert "doc_id" in out.columns and out.collect() == []


def test_stages_hand_texts_to_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(name)
    docs = spark.createDataFrame([(i, "word " * 200_000) for i in range(12)], "doc_id long, text string").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    try:
        spark.conf.unset(name)
        corpus_pipeline.lines_stage(spark, docs.limit(0), "")
        got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(got) > 12_000_000 > 6_000_000 > max(got)
        spark.conf.set(name, "32m")
        corpus_pipeline.lines_stage(spark, docs.limit(0), "")
        assert spark.conf.get(name) == "32m"  # a user's limit stays
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
