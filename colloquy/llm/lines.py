"""Line dedup by an exact set-similarity join.

A line is the set of its white-space separated words; two lines match when the Jaccard
similarity of their sets is at least ``threshold``. Lines are ordered by (document id,
line number); a line goes when any earlier line of the input matches it, whether or not
that earlier line stays itself.

1. Word frequencies over the whole corpus are counted into a table of fixed size.
2. Each line's words are sorted by rarity; a row goes out for each word of its prefix
   (the rarest ``n - ceil(t n) + 1``) that the corpus holds more than once. Lines that
   repeat in a task go out once; the later places are marked as gone.
3. Rows are dealt by word. Within a word's group, lines are compared under the length
   filter, the prefix filter (the shorter partner needs only ``n - ceil(2t/(1+t) n) + 1``),
   the positional filter and a parity-bitmap bound on the symmetric difference. A line
   gets up to ``ENOUGH`` earlier candidates from each group, so a large group (copies of
   one line) gives few pairs a line, not all.
4. Pairs are verified on the words themselves. Lines that may have had more candidates and
   were matched by none of theirs are then compared with all earlier members.

Defined cases: null text stays null and has no lines; lines without words always stay;
null ids rank before all others; rows that share an id (or have none) are told apart by a
hash of their text, and ordered by it; of rows equal in id and text one counts as the first,
and the others lose all lines that have words; an empty table gives an empty result. Equal
lines in one document go too, from the second on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import bit_table, has_bit, mark_maybe, own_names, read, slots, stage

THRESHOLD = 0.8
SLOTS, PIECES = 1 << 24, 64  # frequency counters; shuffled pieces of them
STEP = 1 << 20  # bytes of text worked on at once, in whole lines
LONG_WORD = 64  # longer words (in bytes) are hashed one by one
LINES_KEPT = 200_000  # line hashes a task remembers, to send equal lines' prefixes once
NO_ID = -(1 << 63)
_SPACE = "[ \\t\\n\\r\\f\\x0B\\x1C-\\x1F\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"


_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
#: White space of three bytes in UTF-8, as numbers.
_WIDE = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def _blank(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space, as ``str.split`` takes it."""
    out = _BLANK[raw]
    if len(raw) and raw.max() >= 0x80:
        two = np.flatnonzero(raw[:-1] == 0xC2)
        two = two[(raw[two + 1] == 0x85) | (raw[two + 1] == 0xA0)]
        three = np.flatnonzero((raw[:-2] >= 0xE1) & (raw[:-2] <= 0xE3))
        code = raw[three].astype(np.int64) << 16 | raw[three + 1].astype(np.int64) << 8 | raw[three + 2]
        three = three[np.isin(code, _WIDE)]
        for at, n in ((two, 2), (three, 3)):
            for i in range(n):
                out[at + i] = True
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and 64-bit hash of each word in ``raw``, UTF-8 texts that start at ``borders``."""
    word = ~_blank(raw)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    borders = borders[borders < len(raw)]
    first[borders] = word[borders]
    ends = borders[borders > 0] - 1
    last[ends] = word[ends]
    at = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - at
    whole = np.zeros((len(raw) >> 3) + 2 + LONG_WORD // 8, np.uint64)
    whole.view(np.uint8)[: len(raw)] = raw
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    of = np.arange(len(at))
    for done in range(0, LONG_WORD, 8):  # eight bytes of every word that has them
        of = of[size[of] > done]
        if not len(of):
            break
        place = at[of] + done
        shift = (place & 7).astype(np.uint64) << np.uint64(3)
        eight = whole[place >> 3] >> shift | whole[(place >> 3) + 1] << np.uint64(1) << (np.uint64(63) - shift)
        over = (8 - np.minimum(size[of] - done, 8)).astype(np.uint64) << np.uint64(3)
        h[of] = _mixed(h[of] ^ (eight << over >> over))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[at[i] : at[i] + size[i]].tobytes())
    return at, h


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and the borders of its texts (null: empty)."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, raw = texts.buffers()
    borders = np.frombuffer(at, np.int64, len(texts) + 1, texts.offset * 8)
    return np.frombuffer(raw, np.uint8)[borders[0] : borders[-1]] if raw else np.zeros(0, np.uint8), borders - borders[0]


def words_by_line(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(word hashes, words of each line, its text, its number there)`` for all lines that have
    words, in order, some STEP bytes at a time; a longer line comes by itself."""
    raw, borders = _bytes(texts)
    ends = np.flatnonzero(raw == 10)
    starts = np.unique(np.concatenate([borders[:-1], ends + 1]))  # an empty line may share its start with the next
    low = 0
    while low < len(raw):
        high = int(starts[np.searchsorted(starts, low + STEP, "right") - 1])
        if high <= low:
            later = np.searchsorted(starts, low, "right")
            high = int(starts[later]) if later < len(starts) else len(raw)
        elif low + STEP >= len(raw):
            high = len(raw)
        inner = borders[np.searchsorted(borders, low) : np.searchsorted(borders, high)] - low
        at, h = word_hashes(raw[low:high], inner)
        line = starts[np.searchsorted(starts, low) : np.searchsorted(starts, high)]
        n = np.diff(np.append(np.searchsorted(at, line - low), len(at)))
        line, n = line[n > 0], n[n > 0]
        text = np.searchsorted(borders, line, "right") - 1
        yield h, n, text, np.searchsorted(ends, line) - np.searchsorted(ends, borders[text])
        low = high


def rarity_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """For each of SLOTS hash slots, its words' corpus count on a logarithmic byte scale.

    0 stands for none and 1 for exactly one occurrence in the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.uint32)
        for batch in batches:
            for h, *_ in words_by_line(batch.column(0)):
                np.add.at(total, (h & np.uint64(SLOTS - 1)).astype(np.int64), np.uint32(1))
        at = np.flatnonzero(total)
        part = at // (SLOTS // PIECES)
        cut = np.searchsorted(part, np.arange(PIECES + 1))
        for p in range(PIECES):
            i = at[cut[p] : cut[p + 1]]
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([(i % (SLOTS // PIECES)).astype("<u4").tobytes()], pa.binary()), pa.array([total[i].astype("<u4").tobytes()], pa.binary())],
                    ["piece", "at", "n"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                into = sums.setdefault(p, np.zeros(SLOTS // PIECES, dtype=np.uint64))
                into[np.frombuffer(at, "<u4")] += np.frombuffer(n, "<u4")
        for p, s in sums.items():
            level = np.where(s < 2, s, np.minimum(255, 2 + 5 * np.log2(np.maximum(s, 2) / 2))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["piece", "level"])

    parts = docs.select(F.col(text)).mapInArrow(count, "piece int, at binary, n binary").repartition(PIECES, "piece").mapInArrow(merge, "piece int, level binary")
    table = np.zeros(SLOTS, dtype=np.uint8)
    for row in parts.collect():  # PIECES rows, SLOTS bytes in all
        table[row.piece * (SLOTS // PIECES) : (row.piece + 1) * (SLOTS // PIECES)] = np.frombuffer(row.level, np.uint8)
    return table


def placed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``__llm_key`` (the id, or NO_ID for null) and ``__llm_t``: a hash of the
    text where the id may not be the row's own, else 0."""
    keyed = docs.withColumn("__llm_key", F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)))
    twice = stage(keyed.groupBy("__llm_key").count().where(f"count > 1 OR __llm_key = {NO_ID}").select("__llm_key"), "line-ids")
    marked = mark_maybe(keyed, "__llm_key", twice, "__llm_key", "__llm_may")
    return marked.withColumn("__llm_t", F.when(F.col("__llm_may"), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))).drop("__llm_may")


def prefix_batches(batches: Iterator[pa.RecordBatch], level: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """Prefix rows of batches (key, hash of the text, text); ``level`` is the rarity table."""
    low, once = np.uint64((1 << 56) - 1), np.uint64(2 << 56)
    digest = xxhash.xxh3_128_digest
    sent: dict[bytes, tuple[int, int, int]] = {}
    for batch in batches:
        keys, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for h, times, text, line in words_by_line(batch.column(2)):
            m = len(times)
            if not m:
                continue
            number = level[(h & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | (h >> np.uint64(8)) & low
            of, bits = np.repeat(np.arange(m), times), np.uint64(m.bit_length())
            near = of.astype(np.uint64) << (np.uint64(64) - bits) | number >> bits
            order = np.argsort(near)
            got = number[order]
            if np.any((np.diff(near[order]) == 0) & (got[1:] < got[:-1])):  # they differ in their last bits only
                order = np.lexsort((number, of))
                got = number[order]
            of = of[order]
            keep = np.append(True, (of[1:] != of[:-1]) | (got[1:] != got[:-1]))
            words, of = got[keep], of[keep]
            n = np.bincount(of, minlength=m)
            begin = np.cumsum(n) - n
            packed, live, gone = memoryview(words.tobytes()), np.ones(m, bool), []
            k, x = keys[text], hashes[text]
            for i, (a, size, *place) in enumerate(zip((8 * begin).tolist(), (8 * n).tolist(), k.tolist(), x.tolist(), line.tolist())):
                d, here = digest(packed[a : a + size]), tuple(place)
                before = sent.get(d)
                if before is not None and before <= here:
                    live[i] = False
                    if before != here:
                        gone.append(here)
                    continue
                if before is not None:  # an earlier place came later
                    gone.append(before)
                if len(sent) >= LINES_KEPT:
                    sent.clear()
                sent[d] = here
            bit = words % np.uint64(96)
            odd = np.bitwise_xor.reduceat((bit < 64).astype(np.uint64) << (bit & np.uint64(63)), begin)
            odd32 = np.bitwise_xor.reduceat((bit >= 64).astype(np.uint32) << (bit & np.uint64(31)).astype(np.uint32), begin)
            pos = np.arange(len(words)) - begin[of]
            most = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
            index = n - np.ceil(2 * threshold / (1 + threshold) * n - 1e-9).astype(np.int64) + 1
            go = np.flatnonzero(live[of] & (pos < most[of]) & (words >= once))  # words seen once have no partner
            of, pos = of[go], pos[go]
            word = (words[go] >> np.uint64(8) << np.uint64(32)).view(np.int64)
            g = np.array(gone, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([word | n[of] << 1 | (pos >= index[of]), g[:, 0] << 32 ^ g[:, 2] << 40])),
                    pa.array(np.concatenate([odd.view(np.int64)[of], np.zeros(len(g), np.int64)])),
                    pa.array(np.concatenate([k[of], g[:, 0]])),
                    pa.array(np.concatenate([pos << 32 | line[of], ~g[:, 2]])),
                    pa.array(np.concatenate([x[of], g[:, 1]])),
                    pa.array(np.concatenate([odd32.view(np.int32)[of], np.zeros(len(g), np.int32)])),
                ],
                ["w", "g", "k", "pl", "t", "g32"],
            )


def prefix_rows(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Prefix rows ``(w, g, k, pl, t, g32)`` of ``placed`` rows; pl < 0 marks a line as gone (~pl).

    ``w`` holds 32 bits of the word's hash, the line's number of words (31 bits) and 0 for a
    word of the shorter prefix, so rows sort by it alone; ``g`` and ``g32`` are the parity
    bitmap; ``pl`` holds the word's position and the line's number.
    """
    table = docs.sparkSession.sparkContext.broadcast(rarity_table(docs, text).tobytes())  # SLOTS bytes, always

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from prefix_batches(batches, np.frombuffer(table.value, np.uint8), threshold)

    return docs.select("__llm_key", "__llm_t", F.col(text)).mapInArrow(run, "w long, g long, k long, pl long, t long, g32 int")


_PAIR = "a_k long, a_t long, a_line int, b_k long, b_t long, b_line int, more boolean, w long, g long, pl long, g32 int"
ENOUGH, CHUNK = 4, 1 << 18


class _Group:
    """Rows of whole word groups as columns, and the filters on pairs of them."""

    def __init__(self, w, g, k, pl, text, g32, t: float):
        self.k, self.line, self.text, self.t = k, (pl & 0xFFFFFFFF).astype(np.int32), text, t
        self.g, self.g32 = g.view(np.uint64), g32.view(np.uint32)
        self.n, self.pos = ((w & 0xFFFFFFFF) >> 1).astype(np.float64), (pl >> 32).astype(np.float64)
        self.index = w & 1 == 0  # in the shorter partner's prefix

    def later(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a's place comes after b's."""
        k, t, line = self.k, self.text, self.line
        return (k[a] > k[b]) | ((k[a] == k[b]) & ((t[a] > t[b]) | ((t[a] == t[b]) & (line[a] > line[b]))))

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a and b are different places."""
        return (self.k[a] != self.k[b]) | (self.text[a] != self.text[b]) | (self.line[a] != self.line[b])

    def passes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which places of (a, b) pass the length, prefix, positional and bitmap filters."""
        n, pos, t = self.n, self.pos, self.t
        na, nb = n[a], n[b]
        at = np.flatnonzero((np.minimum(na, nb) >= t * np.maximum(na, nb) - 1e-9) & ((self.index[a] & (na <= nb)) | (self.index[b] & (nb <= na))))
        a, b, na, nb = a[at], b[at], na[at], nb[at]
        need = np.ceil(t / (1 + t) * (na + nb) - 1e-9)
        ok = np.flatnonzero(np.minimum(na - pos[a], nb - pos[b]) >= need)
        at, a, b, room = at[ok], a[ok], b[ok], (na + nb - 2 * need)[ok]
        return at[np.bitwise_count(self.g[a] ^ self.g[b]) + np.bitwise_count(self.g32[a] ^ self.g32[b]) <= room]

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = self.passes(a, b)
        return a[ok], b[ok]


def candidate_pairs(rows: DataFrame, threshold: float = THRESHOLD, wanted: str | None = None) -> DataFrame:
    """Pairs (earlier line a, later line b) that pass the filters; a null ``a`` means b is gone.

    ``more`` tells that b may have candidates beyond its ``ENOUGH``; such rows and all that
    they may meet follow as they came (b with ``w``), so none need be made again.
    With ``wanted``, a boolean column of ``rows``, only lines b that have it set are
    compared, with all earlier members of their groups; else see the module's step 3.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cols: list[np.ndarray]) -> pa.RecordBatch:
            gone, live = np.flatnonzero(cols[3] < 0), np.flatnonzero(cols[3] >= 0)
            word = cols[0][live] >> 32
            r = _Group(*(c[live] for c in cols[:6]), threshold)
            cut = np.flatnonzero(np.diff(word)) + 1
            starts = np.concatenate([[0], cut]).astype(np.int64)
            size = np.diff(np.concatenate([starts, [len(word)]]))
            out = [(np.zeros(0, np.int64),) * 2]
            over = np.zeros(len(word), bool)  # lines that may have candidates left out
            if wanted:
                mine = cols[6][live].astype(bool)
                for s in np.flatnonzero((size > 1) & (np.add.reduceat(mine, starts) > 0) if len(word) else size > 1).tolist():
                    order = starts[s] + np.lexsort([x[starts[s] : starts[s] + size[s]] for x in (r.line, r.text, r.k)])
                    for b in np.flatnonzero(mine[order]).tolist():
                        out.append(r.pairs(order[:b], np.full(b, order[b])))
            else:
                # rows stand by size: b's shorter partners are the indexed rows before it
                index = np.flatnonzero(r.index)
                before = np.concatenate([[0], np.cumsum(r.index)])[:-1]  # indexed rows before each row
                room = before - np.repeat(before[starts] if len(starts) else before, size)  # of its own group
                count = np.zeros(len(word), np.int32)
                b, lag = np.flatnonzero(room > 0), 1
                while len(b):
                    b = b[room[b] >= lag]
                    a = index[before[b] - lag]
                    near = r.n[a] >= threshold * r.n[b] - 1e-9
                    a, b = a[near], b[near]
                    late = np.where(r.later(a, b), a, b)
                    full = count[late] >= ENOUGH
                    over[late[full]] = True
                    open_ = np.flatnonzero(~full & r.apart(a, b))
                    got = r.passes(a[open_], b[open_])
                    got = open_[got]
                    out.append((a[got], b[got]))
                    np.add.at(count, late[got], 1)
                    lag += 1
            a, b = (np.concatenate(x) for x in zip(*out))
            later = r.later(a, b)
            a, b = np.where(later, b, a), np.where(later, a, b)
            other = r.apart(a, b)
            a, b = a[other], b[other]
            again = np.zeros(0, np.int64)
            if over.any():
                # rows stand by word and size: what such lines may meet is near them in size
                at = np.repeat(np.arange(len(starts)), size) * float(1 << 32)
                marked = (at + r.n)[over]
                low = np.searchsorted(marked, at + np.ceil(threshold * r.n - 1e-9))
                high = np.searchsorted(marked, at + np.floor(r.n / threshold + 1e-9), "right")
                again = np.flatnonzero(high > low)
            nothing = lambda n, kind: pa.nulls(n, kind)
            n_pair, n_rest = len(a), len(gone) + len(again)
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(r.k[a]), nothing(n_rest, pa.int64())]), pa.concat_arrays([pa.array(r.text[a]), nothing(n_rest, pa.int64())]), pa.concat_arrays([pa.array(r.line[a]), nothing(n_rest, pa.int32())]),
                    pa.array(np.concatenate([r.k[b], cols[2][gone], r.k[again]])), pa.array(np.concatenate([r.text[b], cols[4][gone], r.text[again]])), pa.array(np.concatenate([r.line[b], (~cols[3][gone]).astype(np.int32), r.line[again]])),
                    pa.array(np.concatenate([over[b], np.zeros(len(gone), bool), over[again]])),
                    *(pa.concat_arrays([nothing(n_pair + len(gone), kind), pa.array(cols[c][live][again])]) for c, kind in ((0, pa.int64()), (1, pa.int64()), (3, pa.int64()), (5, pa.int32()))),
                ],
                ["a_k", "a_t", "a_line", "b_k", "b_t", "b_line", "more", "w", "g", "pl", "g32"],
            )

        held: list[list[np.ndarray]] = []
        count = 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            count += batch.num_rows
            if count >= CHUNK:
                cols = [np.concatenate(c) for c in zip(*held)]
                word = cols[0] >> 32
                whole = int(np.searchsorted(word, word[-1]))  # the last word may go on
                held, count = [[c[whole:] for c in cols]], 0
                if whole:
                    yield found([c[:whole] for c in cols])
        if held:
            yield found([np.concatenate(c) for c in zip(*held)])

    cols = ["w", "g", "k", "pl", "t", "g32", *([wanted] if wanted else [])]
    return rows.select(*cols).repartition(F.shiftright("w", 32)).sortWithinPartitions("w").mapInArrow(run, _PAIR)


def _lines_at(places: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``(k, t, line, x)``: the lines at ``places`` (k, t, line), and some others."""
    mix = F.col("k").bitwiseXOR(F.col("t")).bitwiseXOR(F.shiftleft(F.col("line").cast("long"), 36))
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(places.select(mix)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            k, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            raw, borders = _bytes(batch.column(2))
            ends = np.flatnonzero(raw == 10)
            first = np.searchsorted(ends, borders)  # line ends before each text
            n = np.where(np.diff(borders) > 0, np.diff(first) + 1, 0)
            of = np.repeat(np.arange(len(n)), n)
            line = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            hit = np.flatnonzero(has_bit(table, slots((k ^ t)[of] ^ line << 36)))
            of, line = of[hit], line[hit]
            ends = np.append(ends, 0)
            low = np.where(line > 0, ends[first[of] + line - 1] + 1, borders[of])
            high = np.where(line < n[of] - 1, ends[first[of] + line], borders[of + 1])
            x = [raw[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(k[of]), pa.array(t[of]), pa.array(line.astype(np.int32)), pa.array(x, pa.binary()).cast(pa.string())], ["k", "t", "line", "x"])

    return docs.select("__llm_key", "__llm_t", F.col(text)).mapInArrow(run, "k long, t long, line int, x string")


def _place(side: str) -> list:
    return [F.col(f"{side}_{c}").alias(c) for c in ("k", "t", "line")]


def _verified(pairs: DataFrame, docs: DataFrame, text: str, threshold: float) -> DataFrame:
    """``(k, t, line)`` of the later lines of those pairs whose words' Jaccard similarity suffices."""
    pairs = pairs.where("a_k IS NOT NULL").select("a_k", "a_t", "a_line", "b_k", "b_t", "b_line")
    need = pairs.select(*_place("a")).unionByName(pairs.select(*_place("b")))  # repeats set the same bits, so nothing is shuffled here
    pairs = pairs.distinct()
    lines = stage(_lines_at(need, docs, text), "line-texts")
    a, b = (lines.toDF(*(f"{side}_{c}" for c in ("k", "t", "line", "x"))) for side in "ab")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                if x == y:
                    ok.append(True)
                    continue
                p, q = set(x.split()), set(y.split())
                both = len(p & q)
                ok.append(both >= threshold * (len(p) + len(q) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays(batch.columns[:3], ["k", "t", "line"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(a, ["a_k", "a_t", "a_line"]).join(b, ["b_k", "b_t", "b_line"]).select("b_k", "b_t", "b_line", "a_x", "b_x")
    return both.mapInArrow(check, "k long, t long, line int").distinct()


def removed_places(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(k, t, line)`` of the lines of ``placed`` rows that go."""
    rows = prefix_rows(docs, text, threshold)
    pairs = stage(candidate_pairs(rows, threshold), "line-pairs")
    gone = pairs.where("a_k IS NULL AND w IS NULL").select(*_place("b"))
    gone = stage(gone.unionByName(_verified(pairs, docs, text, threshold)).distinct(), "line-gone")
    left = pairs.where("more").select(*_place("b")).distinct().join(gone, ["k", "t", "line"], "left_anti")
    left = stage(left, "line-left")
    if not left.isEmpty():
        # only the words of lines that are still open; most marked lines are gone by now
        held = pairs.where("w IS NOT NULL").select(F.shiftright("w", 32).alias("word"), "w", "g", "g32", *_place("b"), "pl", "more")
        words = held.where("more").join(left, ["k", "t", "line"], "left_semi").select("word").distinct()
        held = held.join(words, "word", "left_semi").drop("word", "more")
        marked = held.join(left.withColumn("wanted", F.lit(True)), ["k", "t", "line"], "left").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
        rest = stage(candidate_pairs(marked, threshold, "wanted"), "line-rest")
        gone = gone.unionByName(_verified(rest, docs, text, threshold)).distinct()
    return gone


def without_copies(keyed: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """``placed`` rows with one of each set of rows equal in id and text, and the other rows (None: no such sets).

    Only rows of shared ids (or none) can be such; the sets are counted map-side, and the first
    of each is found by a row number that is written down before it is used.
    """
    twin = keyed.where("__llm_t <> 0").withColumn("__llm_md5", F.coalesce(F.md5(F.col(text)), F.lit("")))
    group = ["__llm_key", "__llm_t", "__llm_md5"]
    sets = stage(twin.groupBy(*group).count().where("count > 1").select(*group), "line-sets")
    if sets.isEmpty():
        return keyed, None
    rows = stage(twin.join(sets, group, "left_semi").withColumn("__llm_row", F.monotonically_increasing_id()), "line-equal")
    first = rows.groupBy(*group).agg(F.min("__llm_row").alias("__llm_row")).select("__llm_row")
    own = keyed.where("__llm_t = 0").unionByName(twin.join(sets, group, "left_anti").select(*keyed.columns))
    ones = rows.join(first, "__llm_row", "left_semi").select(*keyed.columns)
    return own.unionByName(ones), rows.join(first, "__llm_row", "left_anti").select(*keyed.columns)


@own_names
def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay; other columns unchanged.

    ``counts`` names two more columns: the text's lines, and those removed.
    """
    keyed, copies = without_copies(placed(docs, text, key), text)
    gone = stage(removed_places(keyed, text, threshold), "line-removed")
    lists = gone.groupBy(F.col("k").alias("__llm_key"), F.col("t").alias("__llm_t")).agg(F.collect_set("line").alias("__llm_gone"))
    keyed = mark_maybe(keyed, "__llm_key", gone, "k", "__llm_may")
    lines = F.split(F.col(text), "\n", -1)
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    same = [F.col(c) for c in docs.columns] + ([n.alias(counts[0]), F.lit(0).cast("long").alias(counts[1])] if counts else [])
    words = "[^" + _SPACE[1:-2] + "]"
    stays = F.filter(lines, lambda x, i: ~F.coalesce(F.array_contains("__llm_gone", i), F.lit(False)) | ~x.rlike(words))
    cut = keyed.where("__llm_may").join(lists, ["__llm_key", "__llm_t"], "left").withColumn("__llm_lines", stays)
    cols = [F.when(F.col(text).isNotNull(), F.array_join("__llm_lines", "\n")).alias(text) if c == text else F.col(c) for c in docs.columns]
    if counts:
        cols += [n.alias(counts[0]), (n - F.coalesce(F.size("__llm_lines"), F.lit(0)).cast("long")).alias(counts[1])]
    out = keyed.where("NOT __llm_may").select(*same).unionByName(cut.select(*cols))
    if copies is not None:
        out = out.unionByName(copies.withColumn("__llm_lines", F.filter(lines, lambda x: ~x.rlike(words))).select(*cols))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_lines, n_removed, kept_sha256)`` for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, counts=("n_lines", "n_removed"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
