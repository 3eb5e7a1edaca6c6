"""Approximate nearest neighbours by cosine: multi-index hashing over learned binary codes.

A code has one bit for each of the leading (at most 64) principal directions, after a
rotation learned so that rounding to bits loses least. Rotation and directions are fitted
on at most SAMPLE vectors (those of smallest hashed id); every vector is coded and indexed.

Vectors are range-sorted by code into blocks, and each block keeps an index of PARTS
substrings of its codes. Within radius r, some substring differs by at most r div PARTS
bits, and only the first r mod PARTS + 1 substrings may use up that many; so probing the
buckets near enough finds every code within r. What is found is checked on the whole
code, then on the vectors themselves.

* First, queries look inside the block that holds their own code.
* The k-th cosine c found so far sets the radius: bits of a vector at cosine c or more
  differ with chance acos(c) / pi each, and the radius covers the mean and SIGMAS standard
  deviations of that. A query with fewer than k hits uses the largest radius, so it meets
  every vector.
* Queries, sorted by radius and code, then meet the other blocks. Narrow block
  descriptions (the bits that all codes of a block share) say first which blocks can hold
  a code within the radius; vectors travel to these only. The radius shrinks as better
  neighbours turn up. A task hands on the best k of each query, never pairs.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no
part; shorter vectors count as padded with zeros; null ids are neither queries nor
candidates; an id of several rows asks with one of them and is found once, by its best
score, and never by its own query; of equal vectors only the k + 1 smallest ids can be anybody's k
nearest, so the others are dropped as candidates (exactly); fewer than k candidates give
all; an empty table gives an empty result; other columns are ignored.
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
from colloquy.llm.vectors import longest, matrix, packed, usable

K = 5
SAMPLE, STEPS = 20_000, 25  # vectors and rounds that fit the rotation
PARTS, SIGMAS = 8, 2.0
ROWS, QUERIES, GROUP, STRIP = 4096, 2048, 4, 128  # of a block, of a block of queries, blocks a co-group, queries at once


class Coder:
    """Bits of centred, rotated unit vectors."""

    def __init__(self, unit: np.ndarray, dims: int):
        self.mean = unit.mean(axis=0) if len(unit) else np.zeros(dims)
        z = unit - self.mean
        bits = min(dims, 64)
        lead = np.linalg.eigh(z.T @ z)[1][:, ::-1][:, :bits]
        y = z @ lead
        turn = np.linalg.qr(np.random.default_rng(12).normal(size=(bits, bits)))[0]
        for _ in range(STEPS if len(unit) else 0):  # the rotation nearest to the signs, again and again
            u, _, vt = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
            turn = (u @ vt).T
        self.bits, self.map = bits, lead @ turn

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        on = (unit - self.mean) @ self.map > 0
        out = np.zeros((len(unit), 64), np.uint8)
        out[:, 64 - self.bits :] = on
        return np.packbits(out, axis=1).view(">u8").astype(np.uint64).reshape(-1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two (exact), so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def parts(code: np.ndarray) -> np.ndarray:
    """The PARTS substrings of each code, one row a part."""
    wide = 64 // PARTS
    return np.stack([(code >> np.uint64(wide * i)) & np.uint64((1 << wide) - 1) for i in range(PARTS)])


class Index:
    """Buckets of one block: for each substring the values present and the rows of each."""

    def __init__(self, code: np.ndarray):
        self.code, self.of = code, []
        for part in parts(code):
            order = np.argsort(part, kind="stable")
            value, first = np.unique(part[order], return_index=True)
            self.of.append((value, first, np.diff(np.append(first, len(code))), order))

    def within(self, query: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, row) places whose codes differ by at most the query's radius."""
        found = np.zeros((len(query), len(self.code)), bool)
        deep, rest = radius // PARTS, radius % PARTS
        for i, (part, (value, first, size, order)) in enumerate(zip(parts(query), self.of)):
            may = deep - (i > rest)
            q, bucket = np.nonzero(np.bitwise_count(part[:, None] ^ value[None, :]) <= may[:, None])
            n = size[bucket]
            at = np.repeat(first[bucket] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found[np.repeat(q, n), order[at]] = True
        q, row = np.nonzero(found)
        ok = np.bitwise_count(query[q] ^ self.code[row]) <= radius[q]
        return q[ok], row[ok]


def reach(cosine: np.ndarray, bits: int) -> np.ndarray:
    """Radius that nearly every code of a vector at ``cosine`` or more lies in (all, if none is known)."""
    p = np.arccos(np.clip(np.where(np.isfinite(cosine), cosine, -1.0), -1.0, 1.0)) / np.pi
    r = np.ceil(bits * p + SIGMAS * np.sqrt(bits * p * (1 - p)) + 1)
    return np.where(np.isfinite(cosine), np.minimum(r, bits), bits).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, k: int):
        self.ids, self.low, self.k = ids, low.copy(), k
        self.rows: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)

    def add(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.rows[i][0], score]), np.concatenate([self.rows[i][1], ids])
        at = np.lexsort((ids, -score))
        at = at[np.sort(np.unique(ids[at], return_index=True)[1])][: self.k]  # an id once, by its best score
        self.rows[i] = score[at], ids[at]
        if len(at) == self.k:
            self.low[i] = max(self.low[i], score[at[-1]])

    def frame(self) -> pd.DataFrame:
        n = [len(s) for s, _ in self.rows]
        cat = lambda j, kind: np.concatenate([r[j] for r in self.rows]) if n else np.zeros(0, kind)
        return pd.DataFrame({"query_id": np.repeat(self.ids, n), "vec_id": cat(1, np.int64), "score": cat(0, float)})


def probe(best: Best, qcode: np.ndarray, qx: np.ndarray, index: Index, ids: np.ndarray, x: np.ndarray, bits: int) -> None:
    """Search one block: codes within each query's radius, then their cosines."""
    qn, n = np.sqrt((qx * qx).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    u = x / n[:, None]
    for s in range(0, len(qcode), STRIP):
        strip = slice(s, s + STRIP)
        q, row = index.within(qcode[strip], reach(best.low[strip], bits))
        near = (qx[strip] / qn[strip, None]) @ u.T
        ok = (near[q, row] >= best.low[strip][q] - 1e-9) & (ids[row] != best.ids[strip][q])
        q, row = q[ok] + s, row[ok]
        # at most k of a block go on, so the rest is left out before exact scores
        for i, a, b in zip(*_runs(q)):
            mine = row[a:b]
            if len(mine) > 4 * best.k:
                rough = near[i - s, mine]
                mine = mine[rough >= np.partition(rough, len(mine) - best.k)[len(mine) - best.k] - 1e-9]
            score = (qx[i] * x[mine]).sum(axis=1) / (qn[i] * n[mine])
            best.add(i, score, ids[mine])


def _runs(q: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(value, start, end) of each run of a sorted array."""
    value, first = np.unique(q, return_index=True)
    return value.tolist(), first.tolist(), np.append(first, len(q))[1:].tolist()


def _numbers(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(raw, kind)


_FOUND = "query_id long, vec_id long, score double"


def prepared(vectors: DataFrame, is_query, key: str, vector: str, k: int) -> DataFrame:
    """``(key, v, cand, ask)``: what can be found, and what asks (one row of an id)."""
    x = F.col(vector)
    rows = vectors.where(F.col(key).isNotNull() & usable(vector) & F.exists(x, lambda c: c != 0))
    rows = rows.select(F.col(key).cast("long").alias("key"), x.cast("array<double>").alias("v"))
    same = F.transform("v", lambda c: c + F.lit(0.0))  # -0.0 is 0.0
    rows = rows.withColumn("h1", F.xxhash64(same)).withColumn("h2", F.xxhash64(F.lit("other"), same))
    ask = rows.where(is_query(F.col("key"))).dropDuplicates(["key"]).select("key", "v", F.lit(False).alias("cand"), F.lit(True).alias("ask"))
    # distinct ids first: an id that repeats a vector counts once among the k + 1
    one = rows.groupBy("h1", "h2", "key").agg(F.min("v").alias("v"))
    order = Window.partitionBy("h1", "h2").orderBy("key")
    found = one.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    return found.select("key", "v", F.lit(True).alias("cand"), F.lit(False).alias("ask")).unionByName(ask)


def sample(rows: DataFrame, dims: int) -> np.ndarray:
    """Unit vectors of at most SAMPLE rows, by smallest hash of the id; the one thing fitted on a part."""
    drawn = rows.where("cand").select(F.xxhash64("key").alias("h"), "key", "v").orderBy("h", "key").limit(SAMPLE)
    got = drawn.select("v").toArrow().column(0).combine_chunks()
    return units(scaled(matrix(got, dims))) if len(got) else np.zeros((0, dims))


def search(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each query row."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = longest(vectors.where(usable(vector)), vector)
    if not dims:
        return empty
    rows = stage(prepared(vectors, is_query, key, vector, k), "hamming-vectors")
    coder = Coder(sample(rows, dims), dims)
    bits = coder.bits

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(matrix(batch.column(1), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(coder(units(x)).view(np.int64)), pa.array([r.tobytes() for r in x], pa.binary()), *batch.columns[2:]],
                ["key", "code", "raw", "cand", "ask"],
            )

    coded = rows.select("key", "v", "cand", "ask").mapInArrow(code, "key long, code long, raw binary, cand boolean, ask boolean")
    coded = coded.withColumn("g", F.lit(0)).withColumn("kind", F.col("cand").cast("long"))
    sort = [F.col("code"), F.col("key"), F.col("kind")]
    blocks = stage(packed(coded.repartitionByRange(*sort).sortWithinPartitions(*sort), "g", ["key", "code", "kind", "raw"], ROWS), "hamming-blocks").drop("g", "n")

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries against their own block, whatever the radius."""
        for batch in batches:
            for i in range(batch.num_rows):
                ids, codes, cand, x = _block(*(batch.column(j)[i].as_py() for j in (1, 2, 3, 4)), dims)
                if cand.any() and not cand.all():
                    best = Best(ids[~cand], np.full((~cand).sum(), -np.inf), k)
                    probe(best, codes[~cand], x[~cand], Index(codes[cand]), ids[cand], x[cand], bits)
                    yield pa.RecordBatch.from_pandas(best.frame(), schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]), preserve_index=False)

    first = stage(blocks.mapInArrow(inside, _FOUND), "hamming-first")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    low = first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select(F.col("query_id").alias("key"), F.col("score").alias("low"))
    asked = coded.where("ask").join(low, "key", "left").withColumn("low", F.coalesce("low", F.lit(-float("inf"))))
    sort = [F.col("low").desc(), F.col("code"), F.col("key")]
    queries = stage(packed(asked.repartitionByRange(*sort).sortWithinPartitions(*sort), "g", ["key", "code", "low", "raw"], QUERIES), "hamming-queries").drop("g", "n")

    pairs = _within(_described(queries, bits), _described(blocks, bits))
    left = queries.select(F.col("block").alias("q"), F.col("key").alias("qkey"), F.col("code").alias("qcode"), "low", F.col("raw").alias("qraw"))
    right = blocks.select(F.col("block").alias("b"), "key", "code", "kind", "raw").join(pairs, "b").withColumn("part", F.pmod(F.xxhash64("b"), F.col("spread")))
    left = left.join(pairs.select("q", "spread").distinct(), "q").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("spread") - 1)))

    def meet(ql: pd.DataFrame, bl: pd.DataFrame) -> pd.DataFrame:
        got = []
        for q in ql.itertuples():
            x = np.frombuffer(q.qraw, "<f8").reshape(-1, dims)
            best = Best(_numbers(q.qkey, "<i8"), _numbers(q.low, "<f8"), k)
            codes = _numbers(q.qcode, "<i8").view(np.uint64)
            for b in bl.sort_values("b").itertuples():
                ids, other, cand, y = _block(b.key, b.code, b.kind, b.raw, dims)
                probe(best, codes, x, Index(other[cand]), ids[cand], y[cand], bits)
            got.append(best.frame())
        return pd.concat(got) if got else Best(np.zeros(0, np.int64), np.zeros(0), k).frame()

    rest = left.groupBy("q", "part").cogroup(right.drop("spread").groupBy("q", "part")).applyInPandas(meet, _FOUND)
    # a query's own block is met again, so results may repeat
    every = first.unionByName(rest).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _block(key: bytes, code: bytes, kind: bytes, raw: bytes, dims: int) -> tuple[np.ndarray, ...]:
    """(ids, codes, which can be found, vectors) of one block."""
    return _numbers(key, "<i8"), _numbers(code, "<i8").view(np.uint64), _numbers(kind, "<i8") == 1, np.frombuffer(raw, "<f8").reshape(-1, dims)


def _described(blocks: DataFrame, bits: int) -> DataFrame:
    """``(block, ones, zeros, radius)``: bits set, and bits clear, in all codes of a block."""
    low = "low" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ones, zeros, radius = [], [], []
            for i in range(batch.num_rows):
                codes = np.frombuffer(batch.column(1)[i].as_py(), "<i8")
                ones.append(int(np.bitwise_and.reduce(codes)))
                zeros.append(int(np.bitwise_and.reduce(~codes)))
                radius.append(int(reach(np.frombuffer(batch.column(2)[i].as_py(), "<f8"), bits).max()) if low else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ones, pa.int64()), pa.array(zeros, pa.int64()), pa.array(radius, pa.int32())], ["block", "ones", "zeros", "radius"])

    return blocks.select("block", "code", "low" if low else "kind").mapInArrow(run, "block long, ones long, zeros long, radius int")


def _within(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(q, b, spread)``: narrow block pairs that can hold a code within the radius, and how
    many co-groups a query block's share is dealt over."""
    # every block of the stated queries against every block, narrow rows only, dealt over the tasks
    deal = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = queries.selectExpr("block AS q", "ones AS q1", "zeros AS q0", "radius").withColumn("deal", F.pmod(F.xxhash64("q"), F.lit(deal)))
    right = blocks.selectExpr("block AS b", "ones AS b1", "zeros AS b0").withColumn("deal", F.explode(F.expr(f"sequence(0L, {deal - 1}L)")))
    found = left.join(right, "deal").where("bit_count((q1 & b0) | (q0 & b1)) <= radius")
    found = stage(found.select("q", "b"), "hamming-pairs")
    count = found.groupBy("q").agg(F.ceil(F.count("*") / GROUP).alias("spread"))
    return found.join(count, "q").select("q", "b", F.col("spread").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest found of every vec_id divisible by 50, among all other rows."""
    return search(read(spark, sf_dir, "embeddings"), lambda key: F.pmod(key, F.lit(50)) == 0)
