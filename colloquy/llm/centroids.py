"""Centroid clustering in exact integers, searched by equal averages and equal variances.

Components become floor(256 x). A round sends the centroids (at most K, so bounded) to the
tasks, assigns every vector there, and merges exact sums: a task hands on one row for each
centroid, whatever its number of vectors, so no cluster is ever gathered.

The nearest centroid of a vector is found without looking at all of them. With S the sum
of the d components and V = d * (sum of squares) - S * S, every distance obeys

    d * dist >= (S_x - S_c) ** 2 + (sqrt(V_x) - sqrt(V_c)) ** 2.

Centroids are sorted by S. The scan starts at the vector's own S and goes outward, nearer
side first; it ends for a vector once the first term alone passes its best distance, and a
centroid is skipped when both terms do. What is left is measured in whole numbers. Values
too large for 64-bit sums go the same way in Python's own integers.

Defined cases: vectors that are null, of another length, or with null or non-finite
components take no part; repeated rows are each a vector; a null id counts as an empty
string in the choice of the first centroids, and equal hashes go by components; fewer
vectors than K give as many centroids; an empty table gives an empty result; distances
and inertias beyond a long are null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import read, stage
from colloquy.llm.vectors import usable

DIMS, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
SMALL = 1 << 24  # components up to here: every sum below fits 64 bits
LONG = 1 << 63


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as 64-bit integers if all are small, else as Python's integers."""
    y = np.floor(x * SCALE)
    if (np.abs(y) <= SMALL).all():
        return y.astype(np.int64)
    exact = [[math.floor(v * SCALE) if abs(v) < 1e300 else int(v) * SCALE for v in row] for row in x.tolist()]
    return np.array(exact, dtype=object).reshape(x.shape)


def _spread(x: np.ndarray, s: np.ndarray) -> np.ndarray:
    """sqrt(V) rounded down, at most one off for 64-bit integers."""
    v = x.shape[1] * (x * x).sum(axis=1) - s * s
    if x.dtype == object:
        return np.array([math.isqrt(int(a)) for a in v], dtype=object)
    return np.sqrt(v.astype(np.float64)).astype(np.int64)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of each row's nearest centroid, ties to the smaller number,
    and how many distances were measured."""
    if x.dtype == object or c.dtype == object or x.shape[1] > DIMS:
        x, c = x.astype(object), c.astype(object)
    n, d = x.shape
    total = c.sum(axis=1)
    order = np.argsort(total, kind="stable")
    total, c = total[order], c[order]
    spread = _spread(c, total)
    own = x.sum(axis=1)
    own_spread = _spread(x, own)
    hi = np.searchsorted(total, own)
    lo = hi - 1
    best, number = np.zeros(n, x.dtype), np.full(n, -1)
    live, measured = np.arange(n), 0
    while len(live):
        left, right = lo[live], hi[live]
        gap_left, gap_right = own[live] - total[np.maximum(left, 0)], total[np.minimum(right, len(c) - 1)] - own[live]
        go_left = (left >= 0) & ((right >= len(c)) | (gap_left <= gap_right))
        gap = np.where(go_left, gap_left, gap_right)
        # equal average: all centroids further out are at least as far as this gap says
        on = ((left >= 0) | (right < len(c))) & ((number[live] < 0) | (gap * gap <= d * best[live])).astype(bool)
        live, go_left, gap = live[on], go_left[on], gap[on]
        at = np.where(go_left, lo[live], hi[live])
        lo[live] -= go_left
        hi[live] += ~go_left
        # equal variance; two off covers the rounding of both roots
        apart = np.maximum(np.abs(own_spread[live] - spread[at]) - 2, 0)
        look = ((number[live] < 0) | (gap * gap + apart * apart <= d * best[live])).astype(bool)
        rows, at = live[look], at[look]
        if len(rows):
            diff = x[rows] - c[at]
            dist, who = (diff * diff).sum(axis=1), order[at]
            measured += len(rows)
            win = ((number[rows] < 0) | (dist < best[rows]) | ((dist == best[rows]) & (who < number[rows]))).astype(bool)
            best[rows[win]], number[rows[win]] = dist[win], who[win]
    return number, best, measured


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of DIMS components each, as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _sums(rows: DataFrame, c: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number and exact componentwise sum of each centroid's vectors: at most one row a centroid."""
    dims = c.shape[1]

    def add(held: dict[int, tuple[int, list[int]]], g: int, n: int, s: list[int]) -> None:
        m, t = held.get(g, (0, [0] * dims))
        held[g] = (m + n, [a + b for a, b in zip(t, s)])

    def out(held: dict[int, tuple[int, list[int]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()), pa.array([",".join(map(str, s)) for _, s in held.values()], pa.string())],
            ["g", "n", "s"],
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            x = whole(_rows(batch.column(0)))
            number, _, _ = nearest(x, c)
            for g in np.unique(number).tolist():
                mine = x[number == g]
                add(held, g, len(mine), [int(v) for v in mine.sum(axis=0)])
        yield out(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for g, n, s in zip(*(col.to_pylist() for col in batch.columns)):
                add(held, g, n, [int(v) for v in s.split(",")])
        yield out(held)

    kind = "g int, n long, s string"
    merged = rows.select("v").mapInArrow(partial, kind).repartition(len(c), "g").mapInArrow(merge, kind)
    return {r.g: (r.n, [int(v) for v in r.s.split(",")]) for r in merged.collect()}  # at most len(c) rows


def kept(vectors: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """``(key, v)``: the vectors that take part."""
    x = F.col(vector)
    rows = vectors.where(x.isNotNull() & (F.size(x) == dims) & usable(vector))
    return rows.select(F.col(key).alias("key"), x.cast("array<double>").alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest sha256 of ``seed:id``, in that order (at most k rows come here)."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    chosen = rows.select(drawn.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return whole(np.array([r.v for r in chosen], np.float64)) if chosen else np.zeros((0, 0), np.int64)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``(key, cluster, distance)`` of every vector that takes part, and the final centroids."""
    rows = stage(kept(vectors, key, vector, dims), "centroid-rows")
    c = first_centroids(rows, k, seed)
    kind = f"{key} {rows.schema['key'].dataType.simpleString()}, cluster int, distance long"
    if not len(c):
        return vectors.sparkSession.createDataFrame([], kind), c
    for _ in range(rounds):
        table = c.tolist()
        for g, (n, s) in _sums(rows, c).items():
            table[g] = [v // n for v in s]
        big = any(abs(v) > SMALL for row in table for v in row)
        c = np.array(table, dtype=object if big else np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, best, _ = nearest(whole(_rows(batch.column(1))), c)
            far = [v if v < LONG else None for v in best.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), pa.array(far, pa.int64())], [key, "cluster", "distance"])

    return stage(rows.mapInArrow(assign, kind), "centroid-assigned"), c


def centroid_hash(c) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()


def _long(total: str, of: Column) -> Column:
    """The sum as a long; null if it, or a part of it, does not fit one."""
    return F.when(of, F.expr(f"try_cast({total} AS long)"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty centroids, five rounds, over all embeddings of 64 components."""
    assigned, c = cluster(read(spark, sf_dir, "embeddings"))
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.every(F.col("distance").isNotNull()).alias("ok"))
    sums = [(r.cluster, r.s, r.ok) for r in per.collect()]  # at most K rows
    every, total = all(ok for *_, ok in sums), sum(s or 0 for _, s, _ in sums)
    table = [(g, s, ok, total, every, centroid_hash(c[g])) for g, s, ok in sums]
    # the broadcast table has at most K rows
    known = spark.createDataFrame(table, "cluster int, s decimal(38,0), ok boolean, total decimal(38,0), every boolean, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        _long("s", F.col("ok")).alias("cluster_inertia"),
        _long("total", F.col("every")).alias("inertia"),
        "centroid_sha256",
    )


def _oracle() -> str:
    steps = [
        """v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, e FROM v QUALIFY c < 40)""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS (
  SELECT vec_id, e, c, d FROM (
    SELECT v.vec_id, v.e, t.c,
      list_sum(list_transform(list_zip(v.e, t.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM v CROSS JOIN c{i} t)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""u{i} AS (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{i}),
m{i} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM u{i} GROUP BY c, i),
f{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM m{i} GROUP BY c),
c{i + 1} AS (SELECT c, e FROM f{i} UNION ALL SELECT c, e FROM c{i} WHERE c NOT IN (SELECT c FROM f{i}))"""
            )
    last = ROUNDS
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(t.e, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} t ON a.c = t.c"""
    )


SQL = _oracle()
