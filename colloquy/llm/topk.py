"""Exact top-k inner-product search: norm-sorted blocks, SVD-rotated partial sums.

Components become floor(64 x). Vectors are range-sorted by falling length and packed into
blocks. Queries are packed too, and a block of queries meets a block of vectors at most
once, in a co-group of bounded size:

* the longest vectors go first and give each query a lower bound for its k-th score;
* blocks whose longest vector can't reach the bound of any query of a block (Cauchy-Schwarz)
  are ruled out on the blocks' descriptions, before any vector is sent there, and again for
  each query by itself;
* else partial sums over the leading rotated dimensions, plus the product of the residual
  lengths, bound each score from above; only pairs at or above the bound are scored, in
  exact integers, and each query's best k of the block go on.

Vectors whose integer form is longer than 2 ** 31 are held as whole doubles, in blocks of
their own; their scores are bounded in doubles first, and summed exactly where they may be
among the best.

Defined cases: vectors that are null or hold null or non-finite components take no part (nor
do those whose squared length doesn't fit a double: components over about 1e152); a score
that doesn't fit a long is held at the nearest long; shorter vectors count as padded with zeros; null ids are neither queries nor candidates;
of rows that repeat an id, each is a candidate, but never of its own id's queries; fewer
than k candidates give all; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from colloquy.llm.common import read, stage
from colloquy.llm.vectors import gram, longest, matrix, packed, rotation, usable

K, SCALE = 20, 64.0
ROWS, QUERIES, LEAD = 2048, 1024, 16  # vectors a block, queries a block, leading dimensions
GROUP = 4  # blocks of vectors that meet a block of queries in one co-group
LONG = 2.0**62  # squared length from which integer forms are held as doubles


def _ints(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x)


def integer_rows(vectors: DataFrame, dims: int, key: str, vector: str) -> DataFrame:
    """``(key, square, g, raw)``: id, squared length, whether it is a long vector, and its
    little-endian components (int32; of long vectors whole doubles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                x = _ints(matrix(batch.column(1), dims))
                square = (x * x).sum(axis=1)
            ok = np.isfinite(square)
            x, square = x[ok], square[ok]
            raw = [(r if wide else r.astype("<i4")).tobytes() for r, wide in zip(x, (square >= LONG).tolist())]
            cols = [batch.column(0).filter(pa.array(ok)), pa.array(square), pa.array((square >= LONG).astype(np.int32)), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "square", "g", "raw"])

    rows = vectors.where(F.col(key).isNotNull() & usable(vector)).select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v"))
    return rows.mapInArrow(run, "key long, square double, g int, raw binary")


def _unpacked(key: bytes, raw: bytes, d: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Ids and components of a packed block, and whether it holds long vectors."""
    ids = np.frombuffer(key, "<i8")
    wide = len(raw) > 4 * d * len(ids)
    return ids, np.frombuffer(raw, "<f8" if wide else "<i4").reshape(len(ids), d), wide


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= cut)
        return at[np.lexsort((ids[at], -score[at]))][:k]
    return np.lexsort((ids, -score))[:k]


def _long_scores(x: np.ndarray, length: float, vx: np.ndarray, lengths: np.ndarray, other: np.ndarray, ids: np.ndarray, low: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, exact scores) of one query's best k in a block where products may leave a long.

    A sum of d products in doubles is off by less than d 2 ** -52 times the lengths.
    """
    most, near = (1 << 63) - 1, vx @ x
    slack = (len(x) + 8) * 2.0**-52 * length * lengths
    sure = (near - slack)[other]
    if len(sure) >= k:
        low = max(low, np.partition(sure, len(sure) - k)[len(sure) - k])
    at = np.flatnonzero(other & (near + slack >= min(low, 2.0**63)))
    score = np.full(len(at), most, np.int64)
    q = [int(c) for c in x.tolist()]
    for i in np.flatnonzero((near - slack)[at] < 2.0**63).tolist():
        score[i] = max(-most - 1, min(most, sum(a * int(b) for a, b in zip(q, vx[at[i]].tolist()))))
    first = best(score, ids[at], k)
    return at[first], score[first]


def _scored(queries: pd.DataFrame, blocks: pd.DataFrame, turn: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, vector ids, scores) that may be among the best, for one co-group."""
    d = len(turn)
    for q in queries.itertuples():
        (qid, qi, q_wide), low = _unpacked(q.key, q.raw, d), np.frombuffer(q.low, "<f8").copy()
        qx = qi.astype(np.float64)
        qy = qx @ turn
        qn, qr = np.sqrt((qx * qx).sum(axis=1)), np.sqrt((qy[:, LEAD:] ** 2).sum(axis=1))
        for b in blocks.sort_values("top", ascending=False).itertuples():
            live = np.flatnonzero(qn * np.sqrt(b.top) * (1 + 1e-9) + 1e-6 >= low)
            if not len(live):
                continue
            vid, vi, v_wide = _unpacked(b.key, b.raw, d)
            vx = vi.astype(np.float64)
            vn = np.sqrt((vx * vx).sum(axis=1))
            if q_wide or v_wide:
                for i in live.tolist():
                    at, score = _long_scores(qx[i], qn[i], vx, vn, vid != qid[i], vid, low[i], k)
                    yield np.full(len(at), qid[i]), vid[at], score
                    if len(at) == k:
                        low[i] = max(low[i], float(score[-1]))
                continue
            vy = vx @ turn
            vr = np.sqrt((vy[:, LEAD:] ** 2).sum(axis=1))
            bound = qy[live, :LEAD] @ vy[:, :LEAD].T + np.outer(qr[live], vr)
            bound += 1e-9 * np.outer(qn[live], vn) + 1e-6
            may = bound >= low[live, None]
            exact = float(qn.max()) * np.sqrt(b.top) < 2.0**52  # doubles hold every sum exactly
            if may.mean() > 0.05:
                score = np.rint(qx[live] @ vx.T).astype(np.int64) if exact else qi[live].astype(np.int64) @ vi.T.astype(np.int64)
                for r, i in enumerate(live.tolist()):
                    at = np.flatnonzero((vid != qid[i]) & (score[r] >= low[i]))
                    at = at[best(score[r, at], vid[at], k)]
                    yield np.full(len(at), qid[i]), vid[at], score[r, at]
                    if len(at) == k:
                        low[i] = max(low[i], float(score[r, at[-1]]))
                continue
            r, c = np.nonzero(may)
            keep = vid[c] != qid[live[r]]
            r, c = r[keep], c[keep]
            for at in range(0, len(r), 1 << 16):
                i, j = live[r[at : at + (1 << 16)]], c[at : at + (1 << 16)]
                yield qid[i], vid[j], np.einsum("nd,nd->n", qi[i].astype(np.int64), vi[j].astype(np.int64))


_FOUND = "query_id long, vec_id long, score long"


def search(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other vectors of each query row."""
    spark = vectors.sparkSession
    dims = longest(vectors, vector)
    rows = stage(integer_rows(vectors, dims, key, vector), "topk-rows")
    # long vectors are cut for the Gram matrix: it only chooses the rotation
    turn = rotation(gram(vectors.where(usable(vector)).select(vector), vector, dims, lambda x: np.clip(_ints(x), -(2.0**31), 2.0**31)))
    sorted_rows = rows.repartitionByRange(F.desc("square"), "key").sortWithinPartitions(F.desc("square"), "key")
    blocks = stage(packed(sorted_rows, "g", ["key", "square", "raw"], ROWS), "topk-blocks")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                top = float(np.frombuffer(one.column(1)[0].as_buffer(), "<f8").max())
                yield pa.RecordBatch.from_arrays([one.column(0), pa.array([top]), one.column(2), one.column(3)], ["block", "top", "key", "raw"])

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The squared length below which a vector helps no query of the block."""
        for batch in batches:
            out = []
            for key_, low, raw in zip(*(c.to_pylist() for c in batch.columns[1:])):
                _, x, _ = _unpacked(key_, raw, dims)
                n = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
                gap = np.maximum(np.frombuffer(low, "<f8") - 1e-6, 0.0)
                out.append(float((gap / np.maximum(n, 1.0)).min() ** 2) * (1 - 1e-8))  # whole numbers: a length is 0 or at least 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["block", "need"])

    def query_blocks(df: DataFrame, name: str) -> DataFrame:
        in_order = df.repartition(F.xxhash64("key")).sortWithinPartitions("g", "key")
        return stage(packed(in_order, "g", ["key", "low", "raw"], QUERIES).select("block", "key", "low", "raw"), name)

    blocks = stage(blocks.select("block", "square", "key", "raw").mapInArrow(tops, "block long, top double, key binary, raw binary"), "topk-tops")
    asking = rows.where(is_query(F.col("key")))
    queries = query_blocks(asking.withColumn("low", F.lit(-float("inf"))), "topk-queries")
    if queries.isEmpty() or blocks.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # number the blocks by falling length; the table of their descriptions is small beside them
    longest_first = Window.orderBy(F.desc("top"), "block")
    bno = blocks.select("block", "top").withColumn("b", F.row_number().over(longest_first) - 1)
    b = blocks.join(bno.select("block", "b"), "block").withColumn("grp", F.floor(F.col("b") / GROUP))

    def meet(q: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
        """Best k of each query in each of the ``pairs`` (block of queries, group of blocks)."""
        left = q.join(pairs, "block").select(F.col("block").alias("q"), "grp", "key", "low", "raw")
        right = b.select("grp", "top", "key", "raw").join(pairs.withColumnRenamed("block", "q"), "grp")

        def run(ql: pd.DataFrame, bl: pd.DataFrame) -> pd.DataFrame:
            got = list(_scored(ql, bl, turn, k))
            cols = [np.concatenate(c) for c in zip(*got)] if got else [np.zeros(0, np.int64)] * 3
            out = pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols)))
            out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            return out.groupby("query_id").head(k)

        return left.groupBy("q", "grp").cogroup(right.groupBy("q", "grp")).applyInPandas(run, _FOUND)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = stage(meet(queries, b.where("grp = 0"), queries.select("block", F.lit(0).cast("long").alias("grp"))), "topk-first")
    low = first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select(F.col("query_id").alias("key"), F.col("score").cast("double").alias("low"))
    again = query_blocks(asking.join(low.distinct(), "key", "left").withColumn("low", F.coalesce("low", F.lit(-float("inf")))), "topk-bounded")
    # how many blocks are long enough for a block of queries: a running count over descriptions
    described = again.mapInArrow(needs, "block long, need double").select("block", F.col("need").alias("size"), F.lit(0).alias("counts"))
    described = described.unionByName(bno.select("block", F.col("top").alias("size"), F.lit(1).alias("counts")))
    reach = F.sum("counts").over(Window.orderBy(F.desc("size"), F.desc("counts")).rowsBetween(Window.unboundedPreceding, 0))
    pairs = described.withColumn("reach", reach).where(f"counts = 0 AND reach > {GROUP}")
    pairs = stage(pairs.select("block", F.explode(F.expr(f"sequence(1L, (reach - 1) div {GROUP})")).alias("grp")), "topk-pairs")
    rest = meet(again, b.where("grp > 0"), pairs)
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 of every vec_id divisible by 20, against all other rows."""
    return search(read(spark, sf_dir, "embeddings"), lambda key: F.pmod(key, F.lit(20)) == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
