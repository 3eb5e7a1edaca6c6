"""Embedding near-dedup: a subspace pigeonhole join on the sphere.

Unit vectors with cosine >= t have squared distance <= 2 - 2t. They are rotated by the
data's singular vectors; the rotated dimensions are dealt in turn to a few subspaces. Each
subspace gets a part of the squared distance in proportion to its share of the data's
energy, so two near vectors are within the budget of one subspace at least. In each:

* blocks of vectors, sorted by cells of the subspaces' leading coordinates, meet where their
  bounding boxes come within the subspace's budget, each pair of blocks once for all subspaces;
* inside, pairs within the subspace's budget are candidates and are verified by their
  cosine. A pair counts in the first subspace whose budget it meets, so the union over
  subspaces holds it once, and pairs are counted and linked where they are found: only
  link counts and a spanning forest of the links leave the task, never all pairs.

Blocks meet in a Cartesian product: each task reads its two parts of the one stored table of
blocks, so the pairs of blocks, whose number grows with the square of the vectors, are neither
shuffled nor stored. Vectors travel in the numbers of their column.

Equal vectors are one class with a multiplicity, expanded at the end.

Defined cases: vectors that are null, zero, or hold null or non-finite components link
with nothing (own component); shorter vectors count as padded with zeros; null ids take
part but never name a component (null when it has no other id); rows that repeat an id are
separate vectors; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import components, read, small_batches, stage
from colloquy.llm.vectors import gram, longest, matrix, packed, rotation, usable

THRESHOLD, SPACES, ROWS = 0.9, 4, 4096
STRIP = 256  # rows of a block compared at once
SLACK = 1e-4  # far above the rounding of single precision in squared distances of unit vectors
HELD = 1 << 18  # link counts and links that a task holds before it hands them on


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), np.finfo(float).tiny)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), np.finfo(float).tiny)


def number_kind(vectors: DataFrame, vector: str) -> str:
    """How the column's numbers are held as bytes."""
    return "<f4" if vectors.schema[vector].dataType.elementType.typeName() == "float" else "<f8"


def unit_classes(vectors: DataFrame, dims: int, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(every row's key and class hash, null where it links with nothing; the classes with
    a number, smallest key, multiplicity and a vector of theirs as bytes). Rows of one class
    have the same unit vector."""
    good, kind = usable(vector), number_kind(vectors, vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = batch.column(1).to_numpy(zero_copy_only=False)
            x = matrix(batch.column(2), dims)
            ok = ok & (np.abs(x).max(axis=1, initial=0) > 0)
            h = [xxhash.xxh3_128_digest(r.tobytes()) if o else None for r, o in zip((_unit(x) + 0.0).astype("<f8"), ok)]
            raw = [r.tobytes() if o else None for r, o in zip(x.astype(kind), ok)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h, pa.binary()), pa.array(raw, pa.binary())], ["key", "h", "raw"])

    v = F.when(good, F.col(vector)).otherwise(F.array().cast(vectors.schema[vector].dataType))
    rows = vectors.select(F.col(key).alias("key"), F.coalesce(good, F.lit(False)).alias("ok"), v.alias("v")).mapInArrow(
        run, f"key {vectors.schema[key].dataType.simpleString()}, h binary, raw binary"
    )
    rows = stage(rows, "neardup-rows")
    classes = rows.where("h IS NOT NULL").groupBy("h").agg(F.min("key").alias("rep"), F.count("*").alias("mult"), F.first("raw").alias("raw"))
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "neardup-classes")
    return rows.select("key", "h"), classes


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of the links a - b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    leaf = label != np.arange(len(nodes))
    return nodes[leaf], nodes[label[leaf]]


def links(classes: DataFrame, dims: int, threshold: float = THRESHOLD, spaces: int = SPACES, kind: str = "<f8") -> DataFrame:
    """``(id, n, to)``: per task, links of a class counted with multiplicity, or (n = 0) a
    link to ``to`` of the spanning forest."""
    parse = lambda raw: _unit(np.frombuffer(raw, kind).reshape(-1, dims).astype(np.float64)) + 0.0

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = parse(b"".join(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64()))], ["v"])

    g = gram(classes.select("raw").mapInArrow(units, "v array<double>"), "v", dims, lambda x: x)
    turn = rotation(g)
    energy = np.maximum(np.einsum("ij,ik,kj->j", turn, g, turn), 0) + 1e-12 * max(1.0, float(np.trace(g)))
    spaces = max(1, min(spaces, dims))
    parts = [np.arange(s, dims, spaces) for s in range(spaces)]  # dealt in turn: like shares of the energy
    share = np.array([energy[p].sum() for p in parts])
    budget = (2 - 2 * threshold) * share / share.sum() + 1e-9
    radius = np.sqrt(budget)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = parse(b"".join(batch.column(2).to_pylist())) @ turn
            cells = pa.array(list(np.floor(y[:, :spaces] / radius).astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([0] * batch.num_rows, pa.int32()), cells, pa.array(np.ascontiguousarray(y[:, 0])), *batch.columns], ["part", "cells", "c", "id", "mult", "raw"])

    dealt = classes.select("id", "mult", "raw").mapInArrow(deal, "part int, cells array<int>, c double, id long, mult long, raw binary")
    in_order = dealt.repartitionByRange("cells", "c", "id").sortWithinPartitions("cells", "c", "id")
    blocks = packed(in_order, "part", ["id", "mult", "raw"], ROWS)
    turned = np.concatenate(parts)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = [(parse(x) @ turn)[:, turned] for x in batch.column(3).to_pylist()]
            box = [pa.array([op(x, axis=0) for x in y], pa.list_(pa.float64())) for op in (np.min, np.max)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *box, *batch.columns[1:]], ["block", "lo", "hi", "id", "mult", "raw"])

    blocks = stage(blocks.select("block", "id", "mult", "raw").mapInArrow(bounds, "block long, lo array<double>, hi array<double>, id binary, mult binary, raw binary"), "neardup-blocks")
    # a Cartesian product reads both sides where they are stored; which of two blocks is on the left is dealt evenly
    l, r = (blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in blocks.columns)) for side in "lr")
    above = lambda x, y: F.zip_with(x, y, lambda a, b: F.greatest(a - b, F.lit(0.0)))
    gaps = F.zip_with(above("l_lo", "r_hi"), above("r_lo", "l_hi"), lambda a, b: a * a + b * b)  # one of them is zero
    starts = np.cumsum([1, *(len(p) for p in parts)]).tolist()
    near = [F.aggregate(F.slice(gaps, at, len(p)), F.lit(0.0), lambda acc, x: acc + x) <= float(most) for at, p, most in zip(starts, parts, budget)]
    i, j = F.col("l_block"), F.col("r_block")
    once = (i == j) | ((i < j) == ((i.bitwiseXOR(j)).bitwiseAND(F.lit(1)) == 0))
    met = l.join(r.hint("shuffle_replicate_nl"), once & functools.reduce(operator.or_, near))
    met = met.select("l_block", "r_block", F.array(*near).alias("near"), *(f"{side}_{c}" for side in "lr" for c in ("id", "mult", "raw")))

    def single(x: np.ndarray, left: bool) -> np.ndarray:
        """Rows whose products are the squared distances, in single precision."""
        own, one = (x * x).sum(axis=1), np.ones(len(x))
        return np.column_stack([x, own, one] if left else [-2 * x, one, own]).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        a_of, n_of, e_of, f_of = [], [], [], []

        def told() -> pa.RecordBatch:
            ids, back = np.unique(np.concatenate(a_of), return_inverse=True)
            n = np.zeros(len(ids), np.int64)
            np.add.at(n, back, np.concatenate(n_of))
            e, f = forest(np.concatenate(e_of), np.concatenate(f_of))
            for held in (a_of, n_of, e_of, f_of):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in ((ids, e), (n, np.zeros(len(e), np.int64)), (ids, f))], ["id", "n", "to"])

        for batch in batches:
            for row in range(batch.num_rows):
                p_block, q_block, close, p_id, p_mult, p_raw, q_id, q_mult, q_raw = (c[row].as_py() for c in batch.columns)
                if p_block != now:
                    pid, pm, px = np.frombuffer(p_id, "<i8"), np.frombuffer(p_mult, "<i8"), parse(p_raw)
                    py = px @ turn
                    now, lefts = p_block, [single(py[:, p], True) for p in parts]
                qid, qm, qx = np.frombuffer(q_id, "<i8"), np.frombuffer(q_mult, "<i8"), parse(q_raw)
                qy = qx @ turn
                for s in np.flatnonzero(close).tolist():
                    rights = single(qy[:, parts[s]], False).T
                    found = []
                    for at in range(0, len(px), STRIP):
                        k = np.flatnonzero((lefts[s][at : at + STRIP] @ rights).reshape(-1) <= budget[s] + SLACK)
                        found.append((k // len(qx) + at, k % len(qx)))
                    u, v = (np.concatenate(c) for c in zip(*found))
                    if p_block == q_block:
                        u, v = u[u < v], v[u < v]
                    for at in range(0, len(u), 1 << 15):
                        x, y = u[at : at + (1 << 15)], v[at : at + (1 << 15)]
                        ok = np.einsum("nd,nd->n", px[x], qx[y]) >= threshold
                        x, y = x[ok], y[ok]
                        gap = (py[x] - qy[y]) ** 2
                        held = np.column_stack([gap[:, d].sum(axis=1) <= budget[t] for t, d in enumerate(parts)])
                        mine = held[:, s] & ~held[:, :s].any(axis=1)
                        x, y = x[mine], y[mine]
                        if not len(x):
                            continue
                        ids, back = np.unique(np.concatenate([pid[x], qid[y]]), return_inverse=True)
                        a_of.append(ids)
                        n_of.append(np.bincount(back, np.concatenate([qm[y], pm[x]]), len(ids)).astype(np.int64))
                        e, f = forest(pid[x], qid[y])
                        e_of.append(e)
                        f_of.append(f)
                if sum(map(len, a_of)) >= HELD:
                    yield told()
        if a_of:
            yield told()

    return stage(met.mapInArrow(run, "id long, n long, to long"), "neardup-links")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``(key, n_links, component_id)`` for every row."""
    small_batches(vectors.sparkSession)
    dims = max(1, longest(vectors, vector))
    rows, classes = unit_classes(vectors, dims, key, vector)
    found = links(classes, dims, threshold, kind=number_kind(vectors, vector))
    counts = found.where("n > 0").groupBy("id").agg(F.sum("n").alias("n"))
    comp = components(found.where("n = 0").select(F.col("id").alias("a"), F.col("to").alias("b")))
    named = classes.select("id", "h", "rep", "mult").join(counts, "id", "left").join(comp, "id", "left")
    named = named.withColumn("c", F.coalesce("component", "id"))
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "c").select("h", "component_id", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("links"))
    return rows.join(named, "h", "left").select(
        "key", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("h").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every vector."""
    out = near_duplicates(read(spark, sf_dir, "embeddings"))
    return out.select(F.col("key").alias("vec_id"), "n_links", "component_id", (F.col("key") == F.col("component_id")).alias("kept"))
