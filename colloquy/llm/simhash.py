"""SimHash near-dedup by Golay-code fuzzy hashing.

Fingerprints: 64-bit SimHash over word shingles (XXH64, seed 42). Distinct fingerprints
are linked when at most four bits differ, exactly:

* The 64 bits are dealt to three segments of 22, 21 and 21 bits, each set into a 23-bit
  word of the perfect binary Golay code. A word's keys are the codewords within distance
  four of it: one, or six when it lies three away from the nearest. Any two words that
  differ in at most two bits share such a key (tests check all error patterns).
* Of four errors, some two of three segments hold at most two together, so each of the
  three pairs of segments gives keys made of one codeword index from either segment.
  Fingerprints are grouped by (pair, two indices) and verified by their distance.
* In a group, a breadth-first walk over the members not reached yet emits a spanning
  forest of the links, never all pairs. Groups hold 8 bytes a distinct fingerprint.
* Connected components over the forest give each fingerprint its class.

Defined cases: null and empty texts have fingerprint zero, linked like any other; fewer
words than the shingle make one shingle of them all; null ids get the component of their
fingerprint but never name one (null when a class has no other id); repeated ids or rows
are handled row by row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from colloquy.llm.common import components, own_names, read, stage

SHINGLE, MAX_BITS = 4, 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and length
PAIRS = ((0, 1), (0, 2), (1, 2))
_GENERATOR = 0b101011100011  # of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
_STEP = 1 << 16  # shingles hashed at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, in memory bounded by the text and _STEP hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(size + 1) - size - 1
    ends = (starts + size)[shingle - 1 :]
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _STEP):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : min(at + _STEP, n)].tolist(), ends[at : at + _STEP].tolist())], dtype=">u8")
        total += _bit_sums(h)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def _bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the big-endian hashes have each of the 64 bits set, highest first."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):  # sums of bytes that can't overflow
        out += np.add.reduce(bits[at : at + 255], axis=0, dtype=np.uint8)
    return out


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``(key, fp)`` for every row; ``fp`` is the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], ["key", "fp"])

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, fp long")


def _remainder(v: np.ndarray) -> np.ndarray:
    for i in range(22, 10, -1):
        v = np.where((v >> i) & 1, v ^ (_GENERATOR << (i - 11)), v)
    return v


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each of the 2048 syndromes: how many keys, and the error words that lead to them."""
    codewords = np.arange(4096, dtype=np.int64) << 11
    codewords ^= _remainder(codewords)
    light = codewords[np.bitwise_count(codewords) <= 7]
    places = np.arange(23)
    leaders = [0, *(1 << places)]
    leaders += [(1 << a) | (1 << b) for a in range(23) for b in range(a)]
    leaders += [(1 << a) | (1 << b) | (1 << c) for a in range(23) for b in range(a) for c in range(b)]
    count, errors = np.zeros(2048, np.int64), np.zeros((2048, 6), np.int64)
    for e in map(int, leaders):
        near = [e ^ int(c) for c in light if int(e ^ c).bit_count() <= 4]
        s = int(_remainder(np.array(e)))
        count[s], errors[s, : len(near)] = len(near), near
    return count, errors


def segment_keys(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(keys a word, 12-bit codeword indices padded to six) of 23-bit words."""
    count, errors = tables
    s = _remainder(words)
    return count[s], (words[:, None] ^ errors[s]) >> 11


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all fuzzy keys of unsigned 64-bit fingerprints; keys carry their pair."""
    tables = golay_tables()
    seg = [segment_keys(((fp >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64), tables) for at, n in SEGMENTS]
    rows, keys = [], []
    for p, (i, j) in enumerate(PAIRS):
        (ni, ki), (nj, kj) = seg[i], seg[j]
        for a in range(6):
            for b in range(6):
                at = np.flatnonzero((ni > a) & (nj > b))
                rows.append(at)
                keys.append((p << 24) | (ki[at, a] << 12) | kj[at, b])
    return np.concatenate(rows), np.concatenate(keys)


def forest(x: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct unsigned fingerprints."""
    edges: list[tuple[int, int]] = []
    rest = x
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            step, front = front[: max(1, (1 << 20) // len(rest))], front[max(1, (1 << 20) // len(rest)) :]
            near = np.bitwise_count(step[:, None] ^ rest[None, :]) <= max_bits
            hit = near.any(axis=0)
            if hit.any():
                via = near[:, hit].argmax(axis=0)
                edges += zip(step[via].tolist(), rest[hit].tolist())
                front, rest = np.concatenate([front, rest[hit]]), rest[~hit]
    return edges


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: spanning links of the distinct fingerprints in column ``fp``."""
    if max_bits > MAX_BITS:
        raise ValueError("three segments find at most four differing bits")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 13):
                fp = batch.column(0)[at : at + (1 << 13)].to_numpy(zero_copy_only=False)
                row, k = golay_keys(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(fp[row])], ["k", "fp"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held = np.zeros(0, np.int32), np.zeros(0, np.uint64)

        def found(k: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.diff(k)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(k)]])
            size = ends - starts
            pairs: list[tuple[int, int]] = []
            two = starts[size == 2]  # most groups
            near = two[np.bitwise_count(x[two] ^ x[two + 1]) <= max_bits]
            pairs += zip(x[near].tolist(), x[near + 1].tolist())
            for a, b in zip(starts[size > 2].tolist(), ends[size > 2].tolist()):
                pairs += forest(x[a:b], max_bits)
            e = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(e[:, 0])), pa.array(np.ascontiguousarray(e[:, 1]))], ["a", "b"])

        for batch in batches:
            k = np.concatenate([held_k, batch.column(0).to_numpy(zero_copy_only=False)])
            x = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(k):
                continue
            whole = int(np.searchsorted(k, k[-1]))  # the last key may go on in the next batch
            if whole:
                yield found(k[:whole], x[:whole])
            held_k, held = k[whole:], x[whole:]
        if len(held):
            yield found(held_k, held)

    keyed = distinct.select("fp").mapInArrow(expand, "k int, fp long")
    return keyed.repartition("k").sortWithinPartitions("k", "fp").mapInArrow(scan, "a long, b long")


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, class_fp, component_id)``: each distinct fingerprint's class and smallest key reachable."""
    groups = prints.groupBy("fp").agg(F.min("key").alias("least"))
    found = components(links(groups, max_bits))
    named = groups.join(found, groups["fp"] == found["id"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("c")
    )
    least = named.groupBy("c").agg(F.min("least").alias("component_id"))
    return named.join(least, "c").select("fp", F.col("c").alias("class_fp"), "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(key, fp, component_id)`` for every row of ``docs``."""
    prints = stage(fingerprints(docs, text, key, shingle), "simhash")
    return prints.join(classes(prints, max_bits), "fp").select("key", "fp", "component_id")


@own_names
def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    A component of null ids only keeps one row of its smallest fingerprint; rows that
    repeat the kept id and fingerprint count as the same document.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in batches:
            got = np.array([fingerprint(t, shingle) for t in batch.column(at).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*names, "__llm_fp"])

    printed = stage(docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__llm_fp", LongType())])), "simhash-docs")
    prints = printed.select(F.col(key).alias("key"), F.col("__llm_fp").alias("fp"))
    of = prints.join(classes(prints, max_bits), "fp")
    best = of.groupBy("class_fp").agg(F.min(F.struct(F.col("key").isNull().alias("no"), "key", "fp")).alias("m"))
    best = best.select(F.col("m.key").alias("__llm_key"), F.col("m.fp").alias("__llm_best"))
    return (
        printed.join(best, printed[key].eqNullSafe(best["__llm_key"]) & (printed["__llm_fp"] == best["__llm_best"]), "left_semi")
        .dropDuplicates([key, "__llm_fp"]).select(*names)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every document."""
    return near_duplicates(read(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
