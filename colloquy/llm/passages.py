"""Substring dedup with compact windows: near-duplicate passages across documents.

A passage is a run of at least ``least`` words, seen as its five-word shingles; two
passages match when the Jaccard similarity of their shingle sets is at least
``threshold``. A passage is removed from a document when an earlier document (smaller id;
of one id, smaller hash of the text) has a match.

1. A passage with a match has most of its shingles in another document too. Shingles are dealt
   by their hashes (40 bits) to find those that occur again; what is dense enough in them makes
   the stretches of a document, trimmed to such shingles. Nothing outside can match. Of equal
   stretches the first document's stands for all: the others are whole copies of it.
2. For each of ``HASHES`` hash functions, the Cartesian tree over a stretch's shingle
   hashes gives its compact windows (l, c, r): every subsequence from l..c to c..r has its
   minimum at c. Only windows that hold a whole passage count; they are found from the
   minima of sliding windows, and their borders by a stack over those minima alone.
3. Windows with equal minimum meet. In a group of up to ``ALL`` such windows all pairs meet.
   Larger groups (common phrases) are split first: two windows of one stretch that share a
   passage make a sketch, keyed by both minima, and sketches of equal key meet all, up to
   ``ALL`` again. Of what is still larger each meets the first and its predecessor. That only
   finds first matches: after verification the stretches of every larger group meet all others
   of it, except for pairs that can't change anything, where the later one is found in earlier
   documents from end to end and the earlier one is shared from end to end.
   Those with as many common shingles as a passage needs are verified as a whole, so one
   common minimum is enough there.
4. Per pair of stretches in small groups, and of sketches, the windows' intervals are joined
   along the diagonal; runs met by ``ENOUGH`` different functions are candidate passages.
5. Candidates are verified on the shingles themselves (32 bits of their hashes): places
   whose shingle occurs in the other passage are dense enough over a passage's length, and
   the Jaccard similarity of what they span reaches the threshold. A stretch that fails as
   a whole (passages in another order, or with a gap between them on one side) is split
   where its diagonal changes, and its parts are verified.

Defined cases: null or empty texts, and texts of fewer words than a passage, have none;
null ids rank before all others; rows that share an id (or have none) are told apart by a
64-bit hash of their text, so only rows equal in both are one document, whose copies don't
match each other; passages repeated inside one document alone are not this operator's;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import read, small_batches, stage, unstage
from colloquy.llm.lines import STEP, _bytes, word_hashes

LEAST, SHINGLE, THRESHOLD = 50, 5, 0.8
HASHES, ENOUGH = 6, 2
ALL = 64  # windows of equal minimum that all meet each other
CHUNK = 1 << 19  # shingles in a row of many documents
SLICE = 4096  # stretches of a larger group that one task compares with all others of it
NO_ID = -(1 << 63)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, shingle: int) -> np.ndarray:
    """Hash of the shingle that begins at each word."""
    n = len(words) - shingle + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(shingle):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(out)


def _slide(x: np.ndarray, size: int, op) -> np.ndarray:
    """``op`` over every window of ``size`` values, by doubling."""
    out, have = x, 1
    while have * 2 <= size:
        out = op(out[:-have], out[have:])
        have *= 2
    rest = size - have
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def compact_windows(h: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of the compact windows of at least ``least`` values; 0 stands for a border.

    The minimum is the leftmost of equals: l follows the last value at most h[c], r comes
    before the next one below it.
    """
    if len(h) < least:
        return (np.zeros(0, np.int64),) * 3
    low = _slide(h, least, np.minimum)
    edge = np.zeros(least - 1, np.uint64)
    high = _slide(np.concatenate([edge, low, edge]), least, np.maximum)
    at = np.flatnonzero(h == high)  # minima of some window, and borders
    pos, val = at.tolist(), h[at].tolist()
    left, right, stack = [0] * len(pos), [len(h) - 1] * len(pos), []
    for i, v in enumerate(val):
        while stack and val[stack[-1]] > v:
            right[stack.pop()] = pos[i] - 1
        left[i] = pos[stack[-1]] + 1 if stack else 0
        stack.append(i)
    l, r = np.array(left, np.int64), np.array(right, np.int64)
    ok = (r - l + 1 >= least) & (h[at] > 0)
    return l[ok], at[ok], r[ok]


def _sequences(batch: pa.RecordBatch, least: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(key, hash of the text, shingle hashes) of the documents long enough to hold a passage."""
    keys, hashes = (c.to_pylist() for c in batch.columns[:2])
    raw, borders = _bytes(batch.column(2))
    done = 0
    while done < len(keys):  # texts of some STEP bytes at once
        end = max(done + 1, int(np.searchsorted(borders, borders[done] + STEP, "right")) - 1)
        inner = borders[done : end + 1] - borders[done]
        at, words = word_hashes(raw[borders[done] : borders[end]], inner)
        cuts = np.searchsorted(at, inner)
        s = shingle_hashes(words, SHINGLE)
        for i in np.flatnonzero(np.diff(cuts) >= least).tolist():
            yield keys[done + i], hashes[done + i], s[cuts[i] : cuts[i + 1] - SHINGLE + 1]
        done = end


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64(text).alias("t"), F.col(text).alias("x"))


def _wide(low: bytes, high: bytes) -> np.ndarray:
    """Hashes of 40 bits from their low 32 and high 8 bits."""
    return np.frombuffer(low, "<u4").astype(np.uint64) | np.frombuffer(high, np.uint8).astype(np.uint64) << np.uint64(32)


def shingled(docs: DataFrame, text: str, key: str, least: int) -> DataFrame:
    """``(chunk, k, t, n, low, high)``: about ``CHUNK`` shingle hashes of whole documents a row;
    their keys, lengths, and the low 32 and high 8 bits of 40, each end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def row(keys: list[tuple[int, int]], seqs: list[np.ndarray]) -> pa.RecordBatch:
            s = np.concatenate(seqs) >> np.uint64(24)
            k, t = np.array(keys, "<i8").T
            cols = (k, t, np.array([len(x) for x in seqs], "<i8"), s.astype("<u4"), (s >> np.uint64(32)).astype(np.uint8))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in cols)], ["chunk", "k", "t", "n", "low", "high"])

        keys, seqs, n = [], [], 0
        for batch in batches:
            for k, t, s in _sequences(batch, least):
                keys.append((k, t))
                seqs.append(s)
                n += len(s)
                if n >= CHUNK:
                    yield row(keys, seqs)
                    number += 1
                    keys, seqs, n = [], [], 0
        if keys:
            yield row(keys, seqs)

    return _keyed(docs, text, key).mapInArrow(run, "chunk long, k binary, t binary, n binary, low binary, high binary")


def _dealt(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(high bits, places that have them) of a chunk."""
    order = np.argsort(high, kind="stable")
    cuts = np.searchsorted(high[order], np.arange(257))
    for i in range(256):
        if cuts[i] < cuts[i + 1]:
            yield i, order[cuts[i] : cuts[i + 1]]


def repeated(chunks: DataFrame) -> DataFrame:
    """``(chunk, high, bits)``: of a chunk's places with these high bits, whether the hash occurs again anywhere."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                low = np.frombuffer(low, "<u4")
                parts = [(i, low[at].tobytes()) for i, at in _dealt(low, np.frombuffer(high, np.uint8))]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([chunk] * len(parts), pa.int64()), pa.array([x for _, x in parts], pa.binary())], ["high", "chunk", "low"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            x = np.sort(np.concatenate([np.frombuffer(low, "<u4") for _, low in held]))
            twice = np.unique(x[1:][x[1:] == x[:-1]])
            twice = np.append(twice, twice[-1:] if len(twice) else x[:1] ^ np.uint32(1))  # never empty, and no place past its end
            for chunk, low in held:
                low = np.frombuffer(low, "<u4")
                bits = np.packbits(twice[np.searchsorted(twice[:-1], low)] == low).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([now], pa.int32()), pa.array([bits], pa.binary())], ["chunk", "high", "bits"])

        for batch in batches:
            for high, chunk, low in zip(*(c.to_pylist() for c in batch.columns)):
                if high != now and held:
                    yield from close()
                    held = []
                now = high
                held.append((chunk, low))
        if held:
            yield from close()

    dealt = chunks.select("chunk", "low", "high").mapInArrow(deal, "high int, chunk long, low binary")
    return dealt.repartition("high").sortWithinPartitions("high").mapInArrow(mark, "chunk long, high int, bits binary")


def dense(hit: np.ndarray, size: int, share: float) -> list[tuple[int, int]]:
    """Ranges [lo, hi) of at least ``size`` places, joined from windows of that size with this
    share of hits, and trimmed to hits."""
    if len(hit) < size:
        return []
    total = np.concatenate([[0], np.cumsum(hit)])
    at = np.flatnonzero(total[size:] - total[:-size] >= share * size - 1e-9)
    if not len(at):
        return []
    first = np.flatnonzero(np.diff(at, prepend=at[0] - size - 1) > size)
    out = []
    for lo, hi in zip(at[first].tolist(), (at[np.append(first[1:], len(at)) - 1] + size).tolist()):
        inside = np.flatnonzero(hit[lo:hi])
        if inside[-1] - inside[0] + 1 >= size:
            out.append((lo + int(inside[0]), lo + int(inside[-1]) + 1))
    return out


def stretches(docs: DataFrame, text: str, key: str, least: int, threshold: float) -> DataFrame:
    """``(k, t, lo, digest, low, high)``: the parts of documents that other places have too, from
    shingle ``lo`` on, and a 128-bit hash of them."""
    size = least - SHINGLE + 1
    # the share that passages need (see ``matched``), lessened by as many misses again: words put in on one side only
    share = 4 * threshold / (1 + threshold) - 1
    chunks = stage(shingled(docs, text, key, least), "passage-shingles")
    marks = stage(repeated(chunks), "passage-marks").groupBy("chunk").agg(F.collect_list(F.struct("high", "bits")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, t, n, low, high, marks in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = np.frombuffer(low, "<u4"), np.frombuffer(high, np.uint8)
                bits = {m["high"]: m["bits"] for m in marks}
                hit = np.zeros(len(low), bool)
                for i, at in _dealt(low, high):
                    hit[at] = np.unpackbits(np.frombuffer(bits[i], np.uint8), count=len(at)).astype(bool)
                ends = np.cumsum(np.frombuffer(n, "<i8"))
                out = []
                for k_, t_, a, b in zip(np.frombuffer(k, "<i8").tolist(), np.frombuffer(t, "<i8").tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                    for lo, hi in dense(hit[a:b], size, share):
                        x, y = low[a + lo : a + hi].tobytes(), high[a + lo : a + hi].tobytes()
                        out.append((k_, t_, lo, xxhash.xxh3_128_digest(x + y), x, y))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out) if out else [()] * 6, kinds)], ["k", "t", "lo", "digest", "low", "high"])

    whole = chunks.join(marks, "chunk").select("k", "t", "n", "low", "high", "marks")
    out = stage(whole.mapInArrow(cut, "k long, t long, lo int, digest binary, low binary, high binary"), "passage-stretches")
    unstage(chunks)
    return out


def contents(found: DataFrame) -> DataFrame:
    """``(c, k, t, digest, many, n, low, high)``: distinct stretches, numbered in the order of their
    first documents (k, t); many: another document has it too; n: its shingles."""
    doc = F.struct("k", "t")
    one = found.groupBy("digest").agg(F.min(F.struct("k", "t", "lo")).alias("at"), (F.min(doc) != F.max(doc)).alias("many"), F.first("low").alias("low"), F.first("high").alias("high"))
    one = one.select("at.*", "digest", "many", F.length("high").alias("n"), "low", "high")
    in_order = one.repartitionByRange("k", "t", "lo").sortWithinPartitions("k", "t", "lo")
    return stage(in_order.withColumn("c", F.monotonically_increasing_id()).drop("lo"), "passage-contents")


def windows(distinct: DataFrame, least: int = LEAST) -> DataFrame:
    """``(v, k, t, lc, r)``: compact windows of stretches, whose number is k and t; the low 3 bits of
    v tell the function, the high half of lc is l, the low one c."""
    size = least - SHINGLE + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(keys: list[int], seqs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            starts = np.cumsum([0] + [len(s) + 1 for s in seqs])[:-1]
            all_ = np.concatenate([x for s in seqs for x in (s, np.zeros(1, np.uint64))])
            border = np.zeros(len(all_), bool)
            border[starts + np.array([len(s) for s in seqs])] = True
            ids = np.array(keys, np.int64)
            for f in range(HASHES):
                h = mixed(all_ + np.uint64((f + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
                h = np.maximum(h & ~np.uint64(7), np.uint64(8)) | np.uint64(f)
                h[border] = 0
                l, c, r = compact_windows(h, size)
                of = np.searchsorted(starts, c, side="right") - 1
                base = starts[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[c].view(np.int64)), pa.array(ids[of]), pa.array(ids[of]), pa.array((l - base) << 32 | (c - base)), pa.array((r - base).astype(np.int32))], ["v", "k", "t", "lc", "r"]
                )

        keys, seqs, n = [], [], 0
        for batch in batches:
            for k, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                keys.append(k)
                seqs.append(_wide(low, high))
                n += len(seqs[-1])
                if n >= CHUNK:
                    yield from rows(keys, seqs)
                    keys, seqs, n = [], [], 0
        if keys:
            yield from rows(keys, seqs)

    return distinct.select("c", "low", "high").mapInArrow(run, "v long, k long, t long, lc long, r int")


def _pairs(keys: list[np.ndarray], at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j), i before j, inside groups of 2 to ``most`` rows; the groups begin at ``at``."""
    n = len(keys[0])
    size = np.diff(np.append(at, n))
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for m in np.unique(size[(size > 1) & (size <= most)]).tolist():
        i, j = np.triu_indices(m, 1)
        base = at[size == m][:, None]
        out.append(((base + i).ravel(), (base + j).ravel()))
    i, j = (np.concatenate(x) for x in zip(*out))
    ok = keys[1][i] != keys[1][j]  # one text does not match itself
    return i[ok], j[ok]


def _changes(*cols: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before it."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in cols], axis=0)
    return new


MEETING = "a long, at long, b long, bt long, bits int, ca int, cb int, left int, right int, v long"


def _met(k, t, c, left, right, bits, i, j) -> list[pa.Array]:
    """Rows of ``MEETING`` for the windows i and j, the earlier document first."""
    swap = (k[i] > k[j]) | ((k[i] == k[j]) & (t[i] > t[j]))
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    ints = (bits[j], c[i], c[j], np.minimum(left[i], left[j]), np.minimum(right[i], right[j]))
    return [pa.array(x) for x in (k[i], t[i], k[j], t[j])] + [pa.array(x.astype(np.int32)) for x in ints] + [pa.array(np.zeros(len(i), np.int64))]


def meetings(found: DataFrame) -> DataFrame:
    """``(a, at, b, bt, bits, ca, cb, left, right, v)``: windows of equal minimum in documents (a, at) < (b, bt).

    ``left`` and ``right`` tell how far both reach from their minima. Of one text the first
    document stands for all: each copy meets it alone, which covers the copy whole. In groups
    of at most ``ALL`` such windows all pairs meet; windows of larger ones are given one by one
    (``v``: their minimum, else 0; ``a``, ``ca``, ``left``, ``right``: the window) for ``sketches``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the open group: its first documents' rows, or those of the last text
        seen, last, large = 0, None, False

        def rows(cols: list[np.ndarray], fresh: np.ndarray, ended: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, seen, large
            v, t, k, lc, r = cols
            group, of_text, of_doc = _changes(v), _changes(v, t), _changes(v, t, k)
            n = np.arange(len(v))
            text_at, doc_at = (np.maximum.accumulate(np.where(x, n, 0)) for x in (of_text, of_doc))
            first = doc_at == text_at
            l, c = lc >> 32, lc & 0xFFFFFFFF
            sides = (k, t, c, c - l, r - c, np.int64(1) << (v & 7))
            copy = np.flatnonzero(fresh & ~first)
            of_first = text_at[copy] + copy - doc_at[copy]
            reps = np.flatnonzero(first)
            at = np.flatnonzero(group[reps])
            size = np.diff(np.append(at, len(reps)))
            open_ = 0 if ended else int(size[-1])  # the last group may go on
            big = size > ALL
            if large:
                big[0] = True
            # groups that ended and are small
            small = np.repeat(~big, size)
            if open_:
                small[len(small) - open_ :] = False
            kept = reps[small]
            i, j = _pairs([v[kept], t[kept]], np.flatnonzero(_changes(v[kept])) if len(kept) else np.zeros(0, np.int64), ALL)
            pairs = _met(*sides, np.concatenate([of_first, kept[i]]), np.concatenate([copy, kept[j]]))
            # windows of large groups, each once: what was held of a group is given when it proves large
            told = np.repeat(big, size)
            if large:
                told[: size[0]] &= fresh[reps[: size[0]]]
            w = reps[told]
            zero = np.zeros(len(w), np.int64)
            alone = [pa.array(x) for x in (k[w], t[w], zero, zero)] + [pa.array(x[w].astype(np.int32)) for x in (sides[5], c)]
            alone += [pa.array(zero.astype(np.int32))] + [pa.array(x[w].astype(np.int32)) for x in (sides[3], sides[4])] + [pa.array(v[w])]
            names = [x.split()[0] for x in MEETING.split(", ")]
            yield pa.RecordBatch.from_arrays(pairs, names)
            yield pa.RecordBatch.from_arrays(alone, names)
            if not ended:
                large = bool(big[-1])
                stay = first & (n >= (text_at[-1] if large else reps[at[-1]]))
                stay |= n >= doc_at[-1]
                held = [x[stay] for x in cols]

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            new = _changes(*cols[:4]) if len(cols[0]) else np.zeros(0, bool)
            if last is not None and len(new):
                new &= np.any([c != x for c, x in zip(cols[:4], last)], axis=0)
            cols = [c[new] for c in cols]  # rows equal in id and text are one document
            if not len(cols[0]):
                continue
            last = [int(c[-1]) for c in cols[:4]]
            seen = len(held[0]) if held is not None else 0
            if held is not None:
                cols = [np.concatenate([p, c]) for p, c in zip(held, cols)]
            yield from rows(cols, np.arange(len(cols[0])) >= seen, False)
        if held is not None:
            yield from rows(held, np.zeros(len(held[0]), bool), True)

    in_order = found.select("v", "t", "k", "lc", "r").repartition("v").sortWithinPartitions("v", "t", "k", "lc")
    return in_order.mapInArrow(run, MEETING)


def _sketches(cols: list[np.ndarray], size: int) -> list[tuple]:
    """Of one document's windows of large groups: each two that hold a common passage, as
    (lo, hi, key of both minima, their functions, place of the first minimum)."""
    _, _, _, _, bits, c, _, left, right, v = cols
    lo, hi = c - left, c + right
    order = np.lexsort((lo, v))
    merged: list[list[int]] = []
    for x in order.tolist():  # windows of one minimum that overlap (a repeated line) are one
        if merged and merged[-1][2] == v[x] and merged[-1][1] >= lo[x]:
            merged[-1][1] = max(merged[-1][1], int(hi[x]))
        else:
            merged.append([int(lo[x]), int(hi[x]), int(v[x]), int(bits[x]), int(c[x])])
    merged.sort()
    low = np.array([w[0] for w in merged])
    out = []
    for i, (l, h, v1, f1, c1) in enumerate(merged):
        for j in range(i + 1, int(np.searchsorted(low, h - size + 2))):
            l2, h2, v2, f2, c2 = merged[j]
            if f1 != f2 and min(h, h2) - l2 + 1 >= size:
                (p, _, place), (q, _, _) = sorted([(v1, f1, c1), (v2, f2, c2)], key=lambda w: w[1])
                out.append((l2, min(h, h2), p, q, f1 | f2, place))
    return out


def candidates(met: DataFrame, least: int = LEAST, enough: int = ENOUGH) -> DataFrame:
    """``(a, at, a_lo, a_hi, b, bt, b_lo, b_hi)``: shingle ranges met by enough hash functions.

    With a negative ``b_lo`` the row is a sketch of the range (a_lo, a_hi) of document
    (a, at): ``b`` is its key, ``bt`` the functions, ``b_hi`` the place of a minimum.
    """
    size = least - SHINGLE + 1
    drift = size // 4
    names = ["a", "at", "a_lo", "a_hi", "b", "bt", "b_lo", "b_hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def found(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            alone = cols[9] != 0
            if alone.any():
                yield sketched([c[alone] for c in cols])
            cols = [c[~alone] for c in cols]
            a, at_, b, bt, bits, ca, cb, left, right, _ = cols
            diag = ca - cb
            lo, hi = cb - left, cb + right
            # runs of overlapping intervals along a diagonal, in order of their minimum
            new = _changes(a, at_, b, bt)
            new[1:] |= (np.abs(diag[1:] - diag[:-1]) > drift) | (cb[1:] - cb[:-1] > 2 * size)
            at = np.flatnonzero(new)
            if not len(at):
                return
            bits = np.bitwise_or.reduceat(bits, at)
            b_lo, b_hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            a_lo, a_hi = np.minimum.reduceat(lo + diag, at), np.maximum.reduceat(hi + diag, at)
            ok = (np.bitwise_count(bits) >= enough) & (b_hi - b_lo + 1 >= size)
            at = at[ok]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[at]), pa.array(at_[at]), *(pa.array(x[ok].astype(np.int32)) for x in (a_lo, a_hi)), pa.array(b[at]), pa.array(bt[at]), *(pa.array(x[ok].astype(np.int32)) for x in (b_lo, b_hi))], names
            )

        def sketched(cols: list[np.ndarray]) -> pa.RecordBatch:
            at = np.flatnonzero(_changes(cols[0], cols[1])).tolist()
            rows = [(cols[0][i], cols[1][i], *s) for i, e in zip(at, [*at[1:], len(cols[0])]) for s in _sketches([c[i:e] for c in cols], size)]
            a, at_, lo, hi, p, q, bits, place = (np.array(x, np.int64) for x in (zip(*rows) if rows else [()] * 8))
            key = mixed(mixed(p.view(np.uint64)) + q.view(np.uint64)).view(np.int64)
            small = [pa.array(x.astype(np.int32)) for x in (lo, hi, np.full(len(a), -1), place)]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(at_), small[0], small[1], pa.array(key), pa.array(bits), small[2], small[3]], names)

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate([p, c]) for p, c in zip(held, cols)]
            if not len(cols[0]):
                continue
            same = np.all([c == c[-1] for c in (*cols[:4], cols[9] != 0)], axis=0)  # the last pair may go on
            whole = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if whole:
                yield from found([c[:whole] for c in cols])
            held = [c[whole:] for c in cols]
        if held is not None and len(held[0]):
            yield from found(held)

    # near-equal diagonals stand together, so passages moved inside a document stay apart
    band = F.floor((F.col("ca") - F.col("cb")) / (4 * size))
    pair = ["a", "at", "b", "bt"]
    return met.repartition(*pair).sortWithinPartitions(*pair, F.col("v") != 0, band, "cb").mapInArrow(run, "a long, at long, a_lo int, a_hi int, b long, bt long, b_lo int, b_hi int")


def sketch_pairs(sketches: DataFrame) -> DataFrame:
    """Rows of ``MEETING`` from sketches of equal key: all pairs in groups of at most ``ALL``, else
    each with the first of its group and with its predecessor; ``left_over`` has the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        large = False

        def rows(cols: list[np.ndarray], ended: bool) -> pa.RecordBatch:
            nonlocal held, large
            key, t, k, lo, hi, bits, c = cols
            at = np.flatnonzero(_changes(key))
            size = np.diff(np.append(at, len(key)))
            big = size > ALL
            big[0] |= large
            done = np.ones(len(at), bool)
            done[-1] = ended
            small = np.repeat(~big & done, size)
            kept = np.flatnonzero(small)
            i, j = _pairs([key[kept], t[kept]], np.flatnonzero(_changes(key[kept])) if len(kept) else kept, ALL)
            # large groups: the first and the predecessor; of a held group only its first and last row are left
            n = np.arange(len(key))
            hub = np.repeat(at, size)
            late = np.repeat(big, size) & (n > hub)
            if large:
                late &= n >= 2
            q = np.flatnonzero(late)
            near = q[(q - 1 != hub[q])] - 1
            x, y = np.concatenate([kept[i], hub[q], near]), np.concatenate([kept[j], q, near + 1])
            ok = t[x] != t[y]
            got = _met(k, t, c, c - lo, hi - c, bits, x[ok], y[ok])
            if not ended:
                large = bool(big[-1])
                held = [x[[at[-1], len(key) - 1]] for x in cols] if large else [x[at[-1] :] for x in cols]
            return pa.RecordBatch.from_arrays(got, [x.split()[0] for x in MEETING.split(", ")])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate([p, c]) for p, c in zip(held, cols)]
            yield rows(cols, False)
        if held is not None and not large:
            yield rows(held, True)

    in_order = sketches.select("key", "t", "k", "lo", "hi", "bits", "c").repartition("key").sortWithinPartitions("key", "k", "t", "lo")
    return in_order.mapInArrow(run, MEETING)


def _closed(ends: DataFrame, spans: DataFrame) -> DataFrame:
    """``(k, t, shared, gone)``: whether the words [begin, words) of ``ends`` all are in spans, and in later ones; only where shared."""
    s = F.struct("lo", "hi")
    lists = spans.groupBy("k", "t").agg(F.array_sort(F.collect_set(s)).alias("x"), F.array_sort(F.collect_set(F.when(F.col("later"), s))).alias("y"))
    whole = lambda c: F.exists(merged(c), lambda m: (m["lo"] <= F.col("begin")) & (m["hi"] >= F.col("words")))
    return ends.join(lists, ["k", "t"]).select("k", "t", whole("x").alias("shared"), whole("y").alias("gone")).where("shared")


def left_over(sketches: DataFrame, spans: DataFrame, ends: DataFrame | None = None, over: int = ALL) -> DataFrame:
    """Rows of ``MEETING`` for all pairs in groups of more than ``over`` sketches, except where the
    later document was found in earlier ones from end to end and the earlier one is shared from
    end to end. ``ends``: (k, t, words); without it a document is as long as its sketches reach.

    The pairs written out, as tests of ``rest`` take them: the query has ``rest`` look at them where they meet.
    """
    large = sketches.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > over).select("key")
    members = sketches.join(large, "key")
    if ends is None:
        ends = members.groupBy("k", "t").agg(F.min("lo").alias("begin"), (F.max("hi") + SHINGLE).alias("words"))
    else:
        ends = ends.select("k", "t", F.lit(0).alias("begin"), "words")
    marked = members.join(_closed(ends, spans), ["k", "t"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("shared", "gone")})
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    earlier = (x("k") < y("k")) | ((x("k") == y("k")) & (x("t") < y("t")))
    met = lambda a, b: a.alias("x").join(b.alias("y"), (x("key") == y("key")) & (x("t") != y("t")) & earlier).select(
        x("k").alias("a"), x("t").alias("at"), y("k").alias("b"), y("t").alias("bt"), x("bits").alias("bits"), x("c").alias("ca"), y("c").alias("cb"),
        F.least(x("c") - x("lo"), y("c") - y("lo")).alias("left"), F.least(x("hi") - x("c"), y("hi") - y("c")).alias("right"), F.lit(0).cast("long").alias("v"),
    )
    return met(marked, marked.where("NOT gone")).unionByName(met(marked.where("NOT shared"), marked.where("gone")))


def _stretches(inside: np.ndarray, values: np.ndarray, y: np.ndarray, order: np.ndarray, drift: int) -> Iterator[tuple[int, int, int]]:
    """(lo, hi, shift): runs of common shingles along one diagonal.

    Each shingle takes the occurrence in ``y`` nearest to the diagonal before it; runs of a
    few shingles are strays, and what stands on either side of them is joined again.
    """
    ys, places = y[order], order.tolist()
    runs: list[list] = []
    begin, end = np.searchsorted(ys, values), np.searchsorted(ys, values, side="right")
    if (end - begin == 1).all():  # one occurrence each: nothing to choose
        diagonal = order[begin] - inside
        cuts = np.flatnonzero(np.abs(np.diff(diagonal)) > drift) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(inside)]):
            runs.append([int(inside[i]), int(inside[j - 1]) + 1, diagonal[i:j].tolist()])
        begin = end = inside = inside[:0]
    for i, a, b in zip(inside.tolist(), begin.tolist(), end.tolist()):
        want = i + (runs[-1][2][-1] if runs else places[a] - i)
        at = bisect_left(places, want, a, b)
        near = min((places[j] for j in (at - 1, at) if a <= j < b), key=lambda p: abs(p - want))
        if runs and abs(near - want) <= drift:
            runs[-1][1] = i + 1
            runs[-1][2].append(near - i)
        else:
            runs.append([i, i + 1, [near - i]])
    joined: list[list] = []
    for run in runs:
        if len(run[2]) < drift:
            continue
        if joined and abs(joined[-1][2][-1] - run[2][0]) <= drift:
            joined[-1][1] = run[1]
            joined[-1][2] += run[2]
        else:
            joined.append(run)
    for lo, hi, diagonals in joined:
        yield lo, hi, int(np.median(diagonals))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def matched(x: np.ndarray, y: np.ndarray, size: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """Verified passages: shingle ranges [lo, hi) of ``x`` and of ``y``."""
    need = 2 * threshold / (1 + threshold)  # share of common shingles at that similarity
    if len(x) < size or len(y) < size:
        return []
    order = np.argsort(y, kind="stable")
    ys = y[order]
    at = np.minimum(np.searchsorted(ys, x), len(y) - 1)
    hit = ys[at] == x
    if hit.sum() < need * size - 1e-9:
        return []
    first = order[at]
    total = np.concatenate([[0], np.cumsum(hit)])
    dense = total[size:] - total[:-size] >= need * size - 1e-9
    if not dense.any():
        return []
    cover = np.zeros(len(x) + 1, np.int64)
    at = np.flatnonzero(dense)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    on = np.concatenate([[0], (np.cumsum(cover)[:-1] > 0).astype(np.int8), [0]])
    out = []

    def alike(lo: int, hi: int, shift: int) -> tuple[int, int, int, int] | None:
        a, b = max(0, lo + shift), min(len(y), hi + shift)
        p, q = _distinct(x[lo:hi]), _distinct(y[a:b])
        both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(q) else 0
        return (lo, hi, a, b) if both >= threshold * (len(p) + len(q) - both) - 1e-9 else None

    for lo, hi in zip(np.flatnonzero(np.diff(on) == 1).tolist(), np.flatnonzero(np.diff(on) == -1).tolist()):
        inside = np.flatnonzero(hit[lo:hi]) + lo
        lo, hi = int(inside[0]), int(inside[-1]) + 1
        if hi - lo < size:
            continue
        # where the other passage lies: the median diagonal of the common shingles
        whole = alike(lo, hi, int(np.median(first[inside] - inside)))
        if whole:
            out.append(whole)
            continue
        parts = [alike(*r) for r in _stretches(inside, x[inside], y, order, size // 4) if r[1] - r[0] >= size]
        out += [p for p in parts if p]
    return out


def verified(ranges: DataFrame, distinct: DataFrame, least: int, threshold: float) -> DataFrame:
    """``(k, t, lo, hi, later)``: passages (word ranges) of stretches (k and t: their number) with a
    match; later: in an earlier document."""
    size = least - SHINGLE + 1
    own = distinct.select("c", F.struct("k", "t").alias("doc"), "many", "low")
    a, b = (own.select(*(F.col(c).alias(f"{side}_{c}") for c in own.columns)) for side in "ab")
    cut = F.substring("a_low", F.col("a_lo") * 4 + 1, (F.col("a_hi") - F.col("a_lo") + 1) * 4)
    low = lambda c: F.greatest(c, F.lit(0)).alias(c)
    asks = ranges.select("a", low("a_lo"), "a_hi", "b", low("b_lo"), "b_hi").distinct().join(a, F.col("a") == F.col("a_c"))
    asks = asks.select("b", "a", "a_lo", "b_lo", "b_hi", "a_doc", "a_many", cut.alias("low"))
    # a stretch, then those that it is compared with
    none = {c: F.lit(None).cast(asks.schema[c].dataType) for c in ("a", "a_lo", "b_lo", "b_hi")}
    bodies = b.join(ranges.select("b").distinct(), F.col("b") == F.col("b_c"), "left_semi").select(
        F.col("b_c").alias("b"), *(none[c].alias(c) for c in none), F.col("b_doc").alias("a_doc"), F.col("b_many").alias("a_many"), F.col("b_low").alias("low")
    )
    rows = bodies.unionByName(asks).select("b", "a", "a_lo", "b_lo", "b_hi", "a_doc.k", "a_doc.t", F.col("a_many").alias("many"), "low")
    rows = rows.repartition("b").sortWithinPartitions("b", F.col("a").asc_nulls_first(), "a_lo")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, doc, many = None, None, False
        for batch in batches:
            out: list[tuple[int, int, int, int, bool]] = []
            for b, a, a_lo, b_lo, b_hi, k, t, more, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if a is None:
                    own, doc, many = np.frombuffer(raw, "<u4"), (k, t), more
                    continue
                inside = doc == (k, t)  # both first in one document: only other documents that have them count
                if inside and not (many or more):
                    continue
                for lo, hi, u, v in matched(own[b_lo : b_hi + 1], np.frombuffer(raw, "<u4"), size, threshold):
                    out.append((b, b, b_lo + lo, b_lo + hi + SHINGLE - 1, not inside))
                    out.append((a, a, a_lo + u, a_lo + v + SHINGLE - 1, False))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out) if out else [()] * 5, kinds)], ["k", "t", "lo", "hi", "later"])

    return rows.mapInArrow(check, "k long, t long, lo int, hi int, later boolean").distinct()


def _hits(seqs: list[np.ndarray]) -> Callable[[int], np.ndarray]:
    """A function of i: how many places of sequence i have a hash that sequence j has, for every j before i."""
    size = np.array([len(x) for x in seqs])
    _, number = np.unique(np.concatenate(seqs), return_inverse=True)
    key = np.unique(number.astype(np.int64) * len(seqs) + np.repeat(np.arange(len(seqs)), size))
    of = key % len(seqs)  # sequences that have hash 0, then hash 1, ..., in order
    starts = np.searchsorted(key, np.arange(int(number.max()) + 2, dtype=np.int64) * len(seqs))
    ends = np.cumsum(size)

    def run(i: int) -> np.ndarray:
        own, n = np.unique(number[ends[i] - size[i] : ends[i]], return_counts=True)
        often = starts[own + 1] - starts[own]
        own, n, often = own[often > 1], n[often > 1], often[often > 1]
        at = np.arange(often.sum()) + np.repeat(starts[own] - np.cumsum(often) + often, often)
        return np.bincount(of[at], np.repeat(n, often), len(seqs))[:i]

    return run


def rest(large: DataFrame, spans: DataFrame, distinct: DataFrame, least: int, threshold: float) -> DataFrame:
    """Further rows like those of ``verified``: in each group (``key``) of ``large`` all pairs of
    stretches (``k``) are verified as a whole, in the first group that both are in.

    Left out is only what can't add a place: pairs with fewer common shingles than a passage needs,
    and those whose later one is found in earlier documents from end to end and whose earlier
    one is shared from end to end. Pairs are looked at where their group is and never written.
    """
    size = least - SHINGLE + 1
    need = 2 * threshold / (1 + threshold) * size - 1e-9
    ends = distinct.select(F.col("c").alias("k"), F.col("c").alias("t"), F.lit(0).alias("begin"), (F.col("n") + SHINGLE - 1).alias("words"))
    closed = _closed(ends, spans).select(F.col("k").alias("c"), "shared", "gone")
    member = large.select(F.col("key").alias("v"), F.col("k").alias("c")).distinct()
    slices = member.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    groups = member.groupBy("c").agg(F.array_sort(F.collect_list("v")).alias("groups"))
    bodies = distinct.select("c", "k", "t", "many", "low").join(groups, "c").join(closed, "c", "left")
    rows = member.join(slices, "v").join(bodies, "c").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    rows = rows.select("v", "slice", "slices", "c", "k", "t", "many", F.coalesce("shared", F.lit(False)).alias("shared"), F.coalesce("gone", F.lit(False)).alias("gone"), "groups", "low")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close() -> pa.RecordBatch:
            v, part, parts = now
            out: list[tuple[int, int, int, int, bool]] = []
            seqs = [np.frombuffer(h[-1], "<u4") for h in held]
            # places of each that are shared, and found in earlier documents
            shared, gone = ([np.full(len(x) + SHINGLE - 1, h[i]) for x, h in zip(seqs, held)] for i in (4, 5))
            over = [bool(h[4]) for h in held]
            hits, sets = _hits(seqs), [set(h[6]) for h in held]
            for i in range(part, len(held), parts):
                for j in np.flatnonzero(hits(i) >= need).tolist():
                    if over[j] and gone[i].all() or next(w for w in held[j][6] if w in sets[i]) != v:
                        continue
                    (a, *doc_a, many_a), (b, *doc_b, many_b) = held[j][:4], held[i][:4]
                    inside = doc_a == doc_b
                    if inside and not (many_a or many_b):
                        continue
                    for lo, hi, x, y in matched(seqs[i], seqs[j], size, threshold):
                        hi, y = hi + SHINGLE - 1, y + SHINGLE - 1
                        out += [(b, b, lo, hi, not inside), (a, a, x, y, False)]
                        shared[i][lo:hi] = shared[j][x:y] = True
                        gone[i][lo:hi] |= not inside
                    over[j] = bool(shared[j].all())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*set(out)) if out else [()] * 5, kinds)], ["k", "t", "lo", "hi", "later"])

        for batch in batches:
            for v, part, parts, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (v, part, parts) != now:
                    if len(held) > 1:
                        yield close()
                    now, held = (v, part, parts), []
                held.append(row)
        if len(held) > 1:
            yield close()

    return rows.repartition("v", "slice").sortWithinPartitions("v", "slice", "c").mapInArrow(check, "k long, t long, lo int, hi int, later boolean").distinct()


def merged(spans: str):
    """A sorted array of (lo, hi) structures joined where they touch."""
    return F.expr(f"""
        aggregate({spans}, cast(array() AS array<struct<lo:int,hi:int>>), (acc, s) ->
          CASE WHEN size(acc) > 0 AND element_at(acc, -1).hi >= s.lo
               THEN concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).lo AS lo, greatest(element_at(acc, -1).hi, s.hi) AS hi)))
               ELSE concat(acc, array(struct(s.lo AS lo, s.hi AS hi))) END)""")


def near_duplicate_passages(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, threshold: float = THRESHOLD) -> DataFrame:
    """``(k, t, shared, removed)``: per document, the word ranges [lo, hi) that match another
    document's, and those that match an earlier one's (``k``: the id, or NO_ID for null;
    ``t``: Spark's xxhash64 of the text)."""
    small_batches(docs.sparkSession)
    parts = stretches(docs, text, key, least, threshold)
    distinct = contents(parts)
    met = stage(meetings(windows(distinct, least)), "passage-meetings")
    found = stage(candidates(met, least), "passage-candidates")
    ranges = found.where("b_lo >= 0")
    sketches = found.where("b_lo < 0").select(F.col("b").alias("key"), F.col("a").alias("k"), F.col("at").alias("t"), F.col("a_lo").alias("lo"), F.col("a_hi").alias("hi"), F.col("bt").alias("bits"), F.col("b_hi").alias("c"))
    if not sketches.isEmpty():
        ranges = ranges.unionByName(candidates(sketch_pairs(sketches), least))
    spans = stage(verified(ranges, distinct, least, threshold), "passages")
    # stretches in larger groups all meet, whatever their sketches found
    large = met.where("v <> 0").select(F.col("v").alias("key"), F.col("a").alias("k"))
    if not large.isEmpty():
        spans = spans.unionByName(rest(large, spans, distinct, least, threshold))
    # from stretches to documents: the first has the passages found, the others are copies of it
    own = F.struct("k", "t")
    of = parts.select(own.alias("doc"), "lo", "digest").distinct().join(distinct.select("digest", "c", F.struct("k", "t").alias("first"), "many", "n"), "digest")
    whole = of.where("many").select("doc", "lo", (F.col("lo") + F.col("n") + SHINGLE - 1).alias("hi"), (F.col("doc") != F.col("first")).alias("later"))
    some = of.where(F.col("doc") == F.col("first")).select("doc", F.col("lo").alias("base"), "c").join(spans.select(F.col("k").alias("c"), "lo", "hi", "later"), "c")
    spans = whole.unionByName(some.select("doc", (F.col("base") + F.col("lo")).alias("lo"), (F.col("base") + F.col("hi")).alias("hi"), "later")).select("doc.*", "lo", "hi", "later")
    s = F.struct("lo", "hi")
    lists = spans.groupBy("k", "t").agg(F.array_sort(F.collect_set(s)).alias("x"), F.array_sort(F.collect_set(F.when(F.col("later"), s))).alias("y"))
    return lists.select("k", "t", merged("x").alias("shared"), merged("y").alias("removed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_words, n_shared, n_removed, spans)`` for every document; spans are the
    word ranges to remove, n_shared also counts a passage's first document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicate_passages(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(x.split()) if x else 0 for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "t", "n_words"])

    words = docs.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(count, "doc_id long, t long, n_words long")
    size = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda acc, s: acc + s["hi"] - s["lo"]), F.lit(0).cast("long"))
    joined = words.withColumn("k", F.coalesce("doc_id", F.lit(NO_ID))).join(found, ["k", "t"], "left")
    return joined.select("doc_id", "n_words", size("shared").alias("n_shared"), size("removed").alias("n_removed"), F.coalesce("removed", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))
