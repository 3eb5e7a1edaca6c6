"""Byte-level BPE as a bounded-lookahead streaming transducer, and its decoder.

Encoding. Text is split by the vocabulary's word pattern; merges never cross words. Inside
a word, merges run by rank. Appending bytes to a known prefix can change its tokens only
near its end: when a merge (u, v) takes v from beyond the agreed part, the agreement moves
back by the length of u, and the next merge that moves it further has a higher rank and a
right side that begins with a token at the new border. ``sufficient_lookahead`` follows
these chains through the merge list, in rank order, and returns the largest total, L. A
token that ends at least L bytes before the known end is stable. As the tokens left and
right of a token border never interact, the rest may be encoded from that border on. So a
word of any length is encoded with a window of a few L bytes; short words are remembered.

Decoding. Ids become bytes, and an incremental UTF-8 machine, whose state is at most three
bytes, turns these into text; text and hashes are made piece by piece.

Defined cases: null text is empty (no ids; the hashes of nothing); special tokens written
in a text get their own id, as in the library; repeated rows and ids are encoded each by
itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import read
from colloquy.llm.wordcache import WordCache, in_steps

VOCABULARY = "byte_bpe_50k.json"
PIECE = 1 << 16  # ids decoded at once
#: Fixed: the word pattern of the byte-level vocabulary.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for texts of these characters only, in the faster engine.
SIMPLE = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
SIMPLE_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files, by its rule: printable
    Latin-1 signs stand for themselves, the other bytes follow from code point 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens' bytes, merge ranks and special tokens of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        plain = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.bytes = [b""] * (1 + max([*plain.values(), *special.values()]))
        for word, i in plain.items():
            self.bytes[i] = bytes(letter[c] for c in word)
        for word, i in special.items():
            self.bytes[i] = word.encode()
        self.of_byte = [plain[c] for c, _ in sorted(letter.items(), key=lambda x: x[1])]
        self.size = len(self.bytes)
        self.merges: list[tuple[int, int, int]] = []
        for m in spec["model"]["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges.append((plain[a], plain[b], plain[a + b]))
        #: (left, right) as one number: (rank, merged id)
        self.rank = {}
        for r, (a, b, c) in enumerate(self.merges):
            self.rank.setdefault(a * self.size + b, (r, c))
        self.lookahead = sufficient_lookahead(self.merges, [len(b) for b in self.bytes])
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def merge(self, word: bytes) -> list[int]:
        """Tokens of one word, all of it known: merges by rank, leftmost first."""
        ids = [self.of_byte[b] for b in word]
        rank, size = self.rank, self.size
        while len(ids) > 1:
            best, at = None, -1
            for i in range(len(ids) - 1):
                got = rank.get(ids[i] * size + ids[i + 1])
                if got is not None and (best is None or got[0] < best[0]):
                    best, at = got, i
            if best is None:
                break
            a, b, out, i = ids[at], ids[at + 1], ids[:at], at
            while i < len(ids):  # every place of this pair, from the left
                if i + 1 < len(ids) and ids[i] == a and ids[i + 1] == b:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stream(self, parts: Iterable[bytes]) -> Iterator[int]:
        """Tokens of one word that comes in parts, each as soon as it is stable."""
        known = b""
        window = 2 * self.lookahead + 64
        for part in parts:
            for at in range(0, len(part), window):
                known += part[at : at + window]
                if len(known) <= 2 * self.lookahead:
                    continue
                done = 0
                for t in self.merge(known):
                    if done + len(self.bytes[t]) > len(known) - self.lookahead:
                        break
                    done += len(self.bytes[t])
                    yield t
                known = known[done:]
        yield from self.merge(known)

    def word(self, word: str) -> Iterator[int]:
        raw = word.encode("utf-8", "surrogatepass")
        if len(raw) <= 4 * self.lookahead:
            return iter(self.merge(raw))
        return self.stream([raw])


def sufficient_lookahead(merges: list[tuple[int, int, int]], length: list[int]) -> int:
    """Bytes beyond a token's end that fix it (see the module's first paragraph)."""
    left = {}  # first part of each merged token
    reach = [0] * len(length)  # by the token at the border: how far the border has moved
    for u, v, uv in merges:
        x, most = v, reach[v]
        while x in left:
            x = left[x]
            most = max(most, reach[x])
        most += length[u]
        reach[u], reach[uv] = max(reach[u], most), max(reach[uv], most)
        left.setdefault(uv, u)
    return max(reach, default=0) + max(length, default=0)


class Decoder:
    """Ids to text, piece by piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = vocabulary.bytes
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


class Encoder:
    """Whole texts to ids, with the words met remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = WordCache(lambda ws: (np.fromiter(vocabulary.word(w), "<u4").tobytes() for w in ws))

    def split(self, text: str) -> Iterator[list[str]]:
        """Lists of words of ``text``; a list of one special token stands alone."""
        for part in self.vocabulary.splitter.split(text) if self.vocabulary.splitter and "<" in text else [text]:
            if part in self.vocabulary.special:
                yield [part]
                continue
            pattern = SIMPLE_WORDS if SIMPLE.fullmatch(part) else WORDS
            if len(part) <= 1 << 20:
                yield pattern.findall(part)
                continue
            held: list[str] = []
            for m in pattern.finditer(part):
                held.append(m.group())
                if len(held) >= PIECE:
                    yield held
                    held = []
            yield held

    def encode(self, text: str) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids, piece by piece."""
        for words in self.split(text):
            if len(words) == 1 and words[0] in self.vocabulary.special:
                yield np.array([self.vocabulary.special[words[0]]], "<u4").tobytes()
                continue
            longest = max(map(len, words), default=0)
            if longest > self.words.longest:
                for w in words:
                    yield from _pieces(self.vocabulary.word(w))
                continue
            self.words.learn(words)
            yield self.words.join(words)


def _pieces(ids: Iterator[int]) -> Iterator[bytes]:
    held: list[int] = []
    for t in ids:
        held.append(t)
        if len(held) >= PIECE:
            yield np.array(held, "<u4").tobytes()
            held = []
    yield np.array(held, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary(path))
    return _ENCODERS[path]


def encode(docs: DataFrame, path: Callable[[], str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, ids)``: the ids of each row's text as an array of integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path())
        for batch in batches:
            at = 0
            for texts in in_steps(batch.column(1).to_pylist()):
                ids = [np.frombuffer(b"".join(enc.encode(t)), "<u4").astype(np.int32) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + len(ids)], pa.array(ids, pa.list_(pa.int32()))], ["key", "ids"])
                at += len(ids)

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids array<int>")


def decode(rows: DataFrame, path: Callable[[], str], ids: str = "ids", key: str = "key") -> DataFrame:
    """``(key, text)`` of rows of ids; null ids give null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path()).vocabulary
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                machine = Decoder(vocabulary)
                out.append(None if x is None else "".join([*(machine.feed(x[i : i + PIECE]) for i in range(0, len(x), PIECE)), machine.finish()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "text"])

    kind = rows.select(F.col(key)).schema[0].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, text string")


def digests(docs: DataFrame, path: Callable[[], str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256)``: each text encoded and decoded in
    one stream, so neither its ids nor its decoded text are ever held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path())
        for batch in batches:
            n, a, b = [], [], []
            for t in batch.column(1).to_pylist():
                count, ids, back, machine = 0, hashlib.sha256(), hashlib.sha256(), Decoder(enc.vocabulary)
                for raw in enc.encode(t or ""):
                    ids.update(raw)
                    got = np.frombuffer(raw, "<u4")
                    count += len(got)
                    for i in range(0, len(got), PIECE):
                        back.update(machine.feed(got[i : i + PIECE].tolist()).encode("utf-8"))
                back.update(machine.finish().encode("utf-8"))
                n.append(count)
                a.append(ids.hexdigest())
                b.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every document."""
    return digests(read(spark, sf_dir, "documents"), vocabulary).withColumnRenamed("key", "doc_id")
