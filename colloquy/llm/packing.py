"""Packing along a space-filling curve.

1. Each document is tokenized once (ids and an end id) and its ids are projected by fixed
   random signs to four numbers, which place it on a Hilbert curve. Ids and curve key are
   staged, so the tokenizer doesn't run again when ranges are sampled or a task is redone.
2. Rows are range-sorted by (key, id). Equal keys are split by id, so no key is hot.
3. Every range cuts its stream of documents into sequences of ``size`` tokens. What is
   left at its end is cut into sequences whose lengths are powers of two, so nothing is
   padded. A sequence is known by its range and its place there.

Defined cases: null or empty text is the end id alone; null ids sort first; rows that
repeat an id are packed each by itself; an empty table gives an empty result; other
columns of the input are ignored. A text of any length is cut over sequences.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import read, shared_dir
from colloquy.llm.wordcache import WordCache, in_steps

SIZE, END_ID = 4096, 2
DIMS, CURVE_BITS = 4, 10
VOCABULARY = "word_bpe_49k.json"
#: Texts made of these characters only are split here; all others go to the library whole.
SIMPLE = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
#: The vocabulary's own word pattern, for lower-case text of SIMPLE characters; most words are the first kind.
WORD = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9ß-öø-ÿ]+")
#: New words are encoded TOGETHER at a time. BETWEEN is a digit: a word of its own, in no other word.
BETWEEN, TOGETHER = "0", 64
STEP = 1 << 21  # characters of text split at once; a word is looked up once in each step


def hilbert(coords: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of non-negative integers below 2 ** bits."""
    x = [coords[:, i].astype(np.int64) for i in range(coords.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:  # undo the rotations, from the coarsest cell down
        low = level - 1
        for i in range(len(x)):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        level >>= 1
    for i in range(1, len(x)):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where(x[-1] & level, flip ^ (level - 1), flip)
        level >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = (out << 1) | (((v ^ flip) >> b) & 1)
    return out


def signs(vocabulary: int, dims: int = DIMS) -> np.ndarray:
    return np.random.default_rng(4096).choice(np.array([-1, 1], np.int8), (vocabulary, dims))


def lanes_of(table: np.ndarray) -> np.ndarray:
    """A row's signs as one number: 16 bits for each dimension, 1 for plus."""
    return ((table > 0).astype(np.uint64) << (np.arange(table.shape[1], dtype=np.uint64) * np.uint64(16))).sum(axis=1, dtype=np.uint64)


def sign_sums(ids: np.ndarray, lanes: np.ndarray) -> list[int]:
    """The sums of the ids' signs, exact."""
    plus = [0] * DIMS
    for at in range(0, len(ids), 1 << 15):
        got = int(lanes[ids[at : at + (1 << 15)]].sum(dtype=np.uint64))
        plus = [p + (got >> 16 * d & 0xFFFF) for d, p in enumerate(plus)]
    return [2 * p - len(ids) for p in plus]


def curve_keys(docs: list[np.ndarray], lanes: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents' ids: each one's hashed bag of tokens in DIMS numbers."""
    v = np.array([np.array(sign_sums(ids, lanes), np.int64) / max(1, len(ids)) ** 0.5 for ids in docs]).reshape(len(docs), DIMS)
    cell = np.clip((np.tanh(v / 4) + 1) * (1 << (CURVE_BITS - 1)), 0, (1 << CURVE_BITS) - 1)
    return hilbert(cell.astype(np.int64), CURVE_BITS)


_ENCODERS: dict[str, tuple] = {}


def encoder(path: str):
    """(texts to bytes of little-endian ids, bytes an id, vocabulary size); kept by worker."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        size = max(tok.get_vocab(with_added_tokens=True).values()) + 1
        kind = "<u2" if size <= 1 << 16 else "<u4"
        pack = lambda texts: (np.array(e.ids, kind).tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False))
        between = np.frombuffer(next(iter(pack([BETWEEN]))), kind)

        def pack_words(ws: list[str]) -> list[bytes]:
            """Ids of words of WORD; many go to the library as one text, a digit between each two."""
            if len(between) != 1:
                return list(pack(ws))
            others, out = [w for w in ws if w != BETWEEN], []
            joined = [BETWEEN.join(others[i : i + TOGETHER]) for i in range(0, len(others), TOGETHER)]
            for raw in pack(joined):
                cut = np.flatnonzero(np.frombuffer(raw, kind) == between[0]) * between.itemsize
                out += [raw[a:b] for a, b in zip([0, *(cut + between.itemsize).tolist()], [*cut.tolist(), len(raw)])]
            if len(others) < len(ws):
                out.insert(ws.index(BETWEEN), between.tobytes())
            return out

        words = WordCache(pack_words)

        def encode(texts: list[str]) -> list[bytes]:
            split = [WORD.findall(t.lower()) if "<|" not in t and SIMPLE.fullmatch(t) else None for t in texts]
            known = set().union(*(w for w in split if w))
            if max(map(len, known), default=0) > words.longest:
                split = [w if w is not None and max(map(len, w), default=0) <= words.longest else None for w in split]
                known = set().union(*(w for w in split if w))
            words.learn(known)
            whole = iter(list(pack([t for t, w in zip(texts, split) if w is None])))
            return [next(whole) if w is None else words.join(w) for w in split]

        _ENCODERS[path] = (encode, kind, size)
    return _ENCODERS[path]


def tokenized(docs: DataFrame, path: Callable[[], str], text: str = "text", key: str = "doc_id", end: int = END_ID) -> DataFrame:
    """``(key, ids, at)``: each row's ids with the end id, and its place on the curve.

    ``path`` is called on the executors and gives the vocabulary file's place there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind, size = encoder(path())
        lanes, last = lanes_of(signs(size)), np.array([end], kind).tobytes()
        for batch in batches:
            at = 0
            for texts in in_steps(batch.column(1).to_pylist(), STEP):
                ids = [x + last for x in encode(texts)]
                places = curve_keys([np.frombuffer(x, kind) for x in ids], lanes)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + len(ids)], pa.array(ids, pa.binary()), pa.array(places), pa.array([np.dtype(kind).itemsize] * len(ids), pa.int32())], ["key", "ids", "at", "width"])
                at += len(ids)

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids binary, at long, width int")


def pack(docs: DataFrame, path: Callable[[], str], text: str = "text", key: str = "doc_id", size: int = SIZE, end: int = END_ID) -> DataFrame:
    """One row per piece: key, start, length, ids (bytes), doc_tokens, sequence_id, offset, crc."""
    spark = docs.sparkSession
    rows = tokenized(docs, path, text, key, end)
    where = f"{shared_dir(spark)}/llm/packing-{os.urandom(8).hex()}"
    rows.write.option("compression", "zstd").parquet(where)
    rows = spark.read.schema(rows.schema).parquet(where)
    ordered = rows.repartitionByRange("at", "key").sortWithinPartitions("at", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        number, fill = 0, 0
        open_: list[tuple] = []  # pieces of the sequence being filled: key, start, ids, doc_tokens

        def rows_of(pieces: list[tuple], n: int) -> list[tuple]:
            out, offset = [], 0
            for k, start, ids, total in pieces:
                raw = ids.astype("<u4").tobytes()
                out.append((k, start, len(ids), zlib.crc32(raw), total, base + n, offset))
                offset += len(ids)
            return out

        def batch_of(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])], names)

        key_type = pa.int64()
        for batch in batches:
            key_type, out = batch.schema.field(0).type, []
            for k, raw, width in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids, at = np.frombuffer(raw.as_buffer(), f"<u{width}"), 0
                while at < len(ids):
                    take = min(size - fill, len(ids) - at)
                    open_.append((k, at, ids[at : at + take].copy(), len(ids)))
                    at, fill = at + take, fill + take
                    if fill == size:
                        out += rows_of(open_, number)
                        number, fill, open_ = number + 1, 0, []
            yield batch_of(out, key_type)
        out = []
        while fill:  # the rest, in powers of two
            room, pieces = 1 << (fill.bit_length() - 1), []
            fill -= room
            while room:
                k, start, ids, total = open_.pop(0)
                take = min(room, len(ids))
                pieces.append((k, start, ids[:take], total))
                room -= take
                if take < len(ids):
                    open_.insert(0, (k, start + take, ids[take:], total))
            out += rows_of(pieces, number)
            number += 1
        if out:
            yield batch_of(out, key_type)

    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = rows.schema["key"].dataType.simpleString()
    return ordered.select("key", "ids", "width").mapInArrow(run, f"key {kind}, " + ", ".join(f"{n} long" for n in names[1:]))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents."""
    return pack(read(spark, sf_dir, "documents"), vocabulary).withColumnRenamed("key", "doc_id")
