"""Quality classifier: random-indexing word vectors, pooled, scored by a small network.

1. Every task turns its documents into word buckets (a fixed hash of the normalised
   word into ``buckets`` slots, so the table never grows with the vocabulary) and adds,
   for each occurrence, the sparse random index vectors of the words within two places.
   The sums over the whole corpus are exact integers; they are merged by a shuffle on
   slot ranges and make one table of ``buckets x dims`` numbers, whatever the corpus size.
2. A document is the frequency-weighted mean and spread of its words' vectors.
3. A two-layer network is fitted on at most ``max_train`` labelled rows (those with the
   smallest hash of their id) and its probabilities are calibrated by a temperature
   found on a fifth of them that the network did not see.

Neither id, language, source nor labels enter a score. Null or empty texts have the
zero vector and are scored like any other row. Repeated rows are scored each by itself.
With no labelled rows of either class the score is the share of 1s seen (0.5 if none).
An empty table gives an empty result. Other columns of the input are left untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import stage

BUCKETS, DIMS, NONZERO, REACH = 1 << 14, 32, 2, 2
SLOTS = 256  # buckets per shuffled piece of the table
MAX_TRAIN = 20_000
REPEAT = 1  # bucket of "the same word again"
_ODD = "!?*#$%&|=<>{}[]\\/_~^@+"


def bucket_of(word: str) -> int:
    """Slot of a white-space token: its lower-case letters, or its shape when it is odd.

    Words glued to runs of signs, and words wholly in capitals, go by their shape, so
    unseen words of such kinds share one slot. Slots 0 and 1 are reserved.
    """
    core = word.strip(".,;:'\"()-")
    if not core:
        key = "p:" + word[:4]
    else:
        odd = "".join(dict.fromkeys(c for c in core if c in _ODD))
        letters = core.strip(_ODD)
        if not letters:
            key = "s:" + odd
        elif odd or (len(letters) > 3 and letters.isupper()):
            key = ("U:" if len(letters) > 1 and letters.isupper() else "w:") + odd
        elif letters.isdigit():
            key = f"d:{min(len(letters), 20)}"
        else:
            key = letters.lower()
    return 2 + zlib.crc32(key.encode("utf-8", "replace")) % (BUCKETS - 2)


class _Slots(dict):
    """Word to slot, filled on demand; emptied when it holds too many words."""

    LIMIT = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        got = bucket_of(word)
        if len(word) <= 200:  # longer words are hashed whole too, but not remembered
            self[word] = got
        return got


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of each slot's nonzero entries (fixed by the slot alone)."""
    rng = np.random.default_rng(20240229)
    return rng.integers(0, DIMS, (NONZERO, BUCKETS)), rng.choice([-1.0, 1.0], (NONZERO, BUCKETS))


def _runs(texts: Iterable[str | None], slots: _Slots, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots of several documents end to end, each one's length), about ``most`` words at once."""
    ids: list[int] = []
    sizes: list[int] = []
    for text in texts:
        before = len(ids)
        if text:
            ids.extend([slots[w] for w in text.split()])
        sizes.append(len(ids) - before)
        if len(ids) >= most:
            yield _marked(ids, sizes)
            ids, sizes = [], []
    if sizes:
        yield _marked(ids, sizes)


def _marked(ids: list[int], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    got, n = np.array(ids, dtype=np.int64), np.array(sizes, dtype=np.int64)
    if len(got) > 1:
        same = np.zeros(len(got), dtype=bool)
        same[1:] = got[1:] == got[:-1]
        starts = (np.cumsum(n) - n)[n > 0]
        same[starts] = False
        got = np.where(same, REPEAT, got)
    return got, n


def context_sums(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(slot_range, sums)``: the corpus's context vectors and word counts, in pieces.

    ``sums`` is the little-endian int64 matrix of SLOTS rows and DIMS + 1 columns; the
    last column counts the words. A word has a place in its own document only.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = _index_vectors()
        total = np.zeros(BUCKETS * DIMS)
        count = np.zeros(BUCKETS)
        slots, some = _Slots(), False
        for batch in batches:
            for ids, sizes in _runs((t.as_py() for t in batch.column(0)), slots, 1 << 18):
                some = some or len(ids) > 0
                doc = np.repeat(np.arange(len(sizes)), sizes)
                count += np.bincount(ids, minlength=BUCKETS)
                for off in range(1, REACH + 1):
                    left, right = ids[:-off], ids[off:]
                    near = doc[:-off] == doc[off:]
                    left, right = left[near], right[near]
                    for k in range(NONZERO):
                        total += np.bincount(left * DIMS + place[k][right], weights=sign[k][right], minlength=BUCKETS * DIMS)
                        total += np.bincount(right * DIMS + place[k][left], weights=sign[k][left], minlength=BUCKETS * DIMS)
        if some:
            table = np.column_stack([total.reshape(BUCKETS, DIMS), count]).astype("<i8")
            pieces = range(0, BUCKETS, SLOTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p // SLOTS for p in pieces], pa.int32()), pa.array([table[p : p + SLOTS].astype("<i4" if abs(table).max() < 2**31 else "<i8").tobytes() for p in pieces], pa.binary())],
                ["slot_range", "sums"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                wide = len(raw) == SLOTS * (DIMS + 1) * 8
                got = np.frombuffer(raw, "<i8" if wide else "<i4").astype(np.int64)
                sums[r] = sums[r] + got if r in sums else got
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in sums.values()], pa.binary())],
                ["slot_range", "sums"],
            )

    kind = "slot_range int, sums binary"
    parts = docs.select(F.col(text)).mapInArrow(partial, kind)
    return parts.repartition(BUCKETS // SLOTS, "slot_range").mapInArrow(merge, kind)


def word_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit word vectors, weighted by rarity: BUCKETS x (DIMS + 1) numbers, the weight last."""
    sums = np.zeros((BUCKETS, DIMS + 1))
    for row in context_sums(docs, text).collect():  # BUCKETS / SLOTS rows, a fixed size
        sums[row.slot_range * SLOTS : (row.slot_range + 1) * SLOTS] = np.frombuffer(row.sums, "<i8").reshape(SLOTS, DIMS + 1)
    count = sums[:, DIMS]
    vec = sums[:, :DIMS] / np.maximum(count, 1)[:, None]
    mean = vec[count > 0].mean(axis=0) if (count > 0).any() else 0.0
    vec = np.where(count[:, None] > 0, vec - mean, 0.0)
    vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)
    share = count / max(count.sum(), 1)
    return np.column_stack([vec, 1e-3 / (1e-3 + share)]).astype(np.float32)


def pooled(texts: Iterable[str | None], table: np.ndarray, slots: _Slots) -> np.ndarray:
    """One row per text: weighted mean and spread of its word vectors, and its log length."""
    rows = []
    for ids, sizes in _runs(texts, slots, 1 << 18):
        out = np.zeros((len(sizes), 2 * DIMS + 2))
        full = sizes > 0
        if full.any():
            vec, weight = table[ids, :DIMS], table[ids, DIMS].astype(np.float64)
            at = (np.cumsum(sizes) - sizes)[full]
            n = np.add.reduceat(weight, at)
            mean = np.add.reduceat(vec * weight[:, None].astype(np.float32), at, axis=0, dtype=np.float64) / n[:, None]
            plain = np.add.reduceat(vec, at, axis=0, dtype=np.float64) / sizes[full][:, None]
            out[full, :DIMS], out[full, DIMS : 2 * DIMS] = mean, plain
            out[full, 2 * DIMS] = np.log1p(sizes[full]) / 8
            out[full, 2 * DIMS + 1] = np.add.reduceat((ids == REPEAT).astype(np.float64), at) / sizes[full]
        rows.append(out)
    return np.concatenate(rows) if rows else np.zeros((0, 2 * DIMS + 2))


def with_vectors(docs: DataFrame, table: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, features)`` for every row of ``docs``; features are little-endian float32."""
    known = docs.sparkSession.sparkContext.broadcast(table)  # BUCKETS x (DIMS + 1) x 4 bytes, always

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for batch in batches:
            x = pooled((t.as_py() for t in batch.column(1)), known.value, slots).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["key", "features"])

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, features binary")


@dataclass
class Network:
    """Standardisation, two layers and the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 150, seed: int = 7) -> Network:
    """Adam on the log loss with weight decay; then the temperature on the held fifth."""
    d = x.shape[1]
    if len(y) < 10 or y.min() == y.max():
        p = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    z, t = (x[fit] - mean) / scale, y[fit].astype(float)
    p = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for _ in range(epochs):
        mix = rng.permutation(len(t))
        for at in range(0, len(t), 512):
            i = mix[at : at + 512]
            h = np.tanh(z[i] @ p[0] + p[1])
            out = 1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30)))
            e = (out - t[i]) / len(i)
            back = np.outer(e, p[2]) * (1 - h * h)
            grads = [z[i].T @ back + 1e-3 * p[0], back.sum(axis=0), h.T @ e + 1e-3 * p[2], np.array([e.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    raw, truth = net.logits(x[held]), y[held].astype(float)

    def loss(temp: float) -> float:
        return float(np.mean(np.logaddexp(0, raw / temp) - truth * raw / temp))

    net.temperature = float(min(np.geomspace(0.25, 8, 60), key=loss)) if len(held) else 1.0
    return net


@dataclass
class QualityModel:
    table: np.ndarray
    net: Network


def held_out(key: str = "doc_id"):
    """True for rows that may not be learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_train: int = MAX_TRAIN) -> tuple[QualityModel, DataFrame]:
    """The fitted model, and the feature vectors ``(key, features)`` of all documents (staged).

    Word vectors cover all documents. Labels come from at most ``max_train`` rows outside
    ``held_out``; null labels are not learnt from, and a key labelled twice counts by its
    smallest label.
    """
    table = word_table(docs, text)
    vectors = stage(with_vectors(docs, table, key, text), "quality-vectors")
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(F.col(label).cast("int")).alias("y"))
    rows = (
        vectors.where(~held_out("key")).join(known, "key")
        .orderBy(F.xxhash64("key"), "key", "features").limit(max_train).select("features", "y").collect()
    )
    x = np.array([np.frombuffer(r.features, "<f4") for r in rows], dtype=float).reshape(len(rows), 2 * DIMS + 2)
    return QualityModel(table, train(x, np.array([r.y for r in rows], dtype=int))), vectors


def score_vectors(vectors: DataFrame, model: QualityModel) -> DataFrame:
    """``(key, score)`` from staged feature vectors."""
    net = vectors.sparkSession.sparkContext.broadcast(model.net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([np.frombuffer(r, "<f4") for r in batch.column(1).to_pylist()], dtype=float).reshape(batch.num_rows, 2 * DIMS + 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.value.probability(x), pa.float64())], ["key", "score"])

    return vectors.mapInArrow(run, f"key {vectors.schema['key'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, all columns as they were."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    at, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, m = _Slots(), shared.value
        for batch in batches:
            x = pooled((t.as_py() for t in batch.column(at)), m.table, slots).astype("<f4").astype(float)
            keep = batch.filter(pa.array(m.net.probability(x) >= threshold))
            yield pa.RecordBatch.from_arrays(keep.columns, names)

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document."""
    model, vectors = fit(docs, labels)
    return score_vectors(vectors, model).select(
        F.col("key").alias("doc_id"), held_out("key").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from colloquy.llm.common import read

    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
