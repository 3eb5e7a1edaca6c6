"""Substring dedup on bytes: every 200-byte string that occurs twice, by difference cover.

A byte goes when a ``size``-byte string over it also starts anywhere else in the corpus.

1. Partition by content. Of the ``GRAM``-byte grams in each ``size``-byte window the one
   with the smallest hash is the window's anchor, so equal windows have equal anchors at
   equal places. Each run of starts with one anchor, and the bytes their windows cover,
   is that anchor's context; an anchor seen once has no equal window anywhere and is left
   out (a count over all anchors, then a bit table of fixed size that lets some pass).
   An anchor in more than ``HOT`` places is dealt again by more of the content: starts lie 0
   to size - GRAM bytes before the anchor, and all windows of one half of these distances
   share bytes beyond it; equal windows have equal ones. Halves still held by more than
   ``HOT`` contexts are halved again, down to single starts, whose shared bytes are the window.
2. Contexts that repeat as a whole make all their starts repeated. Only anchors whose
   contexts differ send them, so all texts that may hold one string meet.
3. There the difference cover {1, 2} modulo 3 is sorted: names of three bytes at sampled
   places; triples of names, sorted, become the names of the next level (9, 27, 81 bytes),
   places a level apart being sampled too; four such names make one of size - 2 bytes.
   Any two starts have both i + d and j + d sampled for some d below 3, so the remaining
   suffixes are merged by (d bytes, name, 2 - d bytes) for each d, and starts whose sorted
   neighbour has an equal prefix are repeated. Names are ranks, not hashes: exact.
4. Repeated starts of each document are joined into byte ranges and cut.

Contexts are matched as wholes by a 128-bit hash; rows of one id are told apart by a hash
of their text. Defined cases: null text counts as empty; texts shorter than ``size`` stay;
rows that repeat an id and text remove each other's strings like any two rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import bit_table, has_bit, mark_maybe, read, slots, stage
from colloquy.llm.passages import compact_windows, mixed

SIZE, GRAM = 200, 72
FILTER_BITS = 26  # 8 MB a bit table
NO_ID = -(1 << 63)
STEP, CHUNK, ROWS = 1 << 19, 1 << 20, 256  # bytes of text and of contexts, and rows, handled at once
HOT = 1 << 12  # contexts of one group sorted in one task
FEW = 1 << 18  # keys of hot groups that may be broadcast (8 or 16 bytes each); more are joined plainly


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place, by doubling."""
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = {1: base}
    h, have = x.astype(np.uint64) + np.uint64(1), 1
    parts = {1: h}
    while have * 2 <= gram:
        h = h[:-have] * powers[have] + h[have:]
        powers[have * 2] = powers[have] * powers[have]
        have *= 2
        parts[have] = h
    at = have
    for p in sorted(parts, reverse=True):  # the rest of the length, in powers of two
        while at + p <= gram:
            n = len(x) - at - p + 1
            h = h[:n] * powers[p] + parts[p][at : at + n]
            at += p
    return mixed(h)


def anchors(texts: list[bytes], size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, place of the anchor, first and last start, hash) of all anchors of long texts."""
    none = np.zeros(0, np.int64)
    whole = [i for i, t in enumerate(texts) if len(t) >= size]
    if not whole:
        return none, none, none, none, none
    with np.errstate(over="ignore"):
        parts = [np.maximum(gram_hashes(np.frombuffer(texts[i], np.uint8), gram), np.uint64(1)) for i in whole]
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
    h = np.concatenate([v for p in parts for v in (p, np.zeros(1, np.uint64))])
    width = size - gram + 1
    l, c, r = compact_windows(h, width)
    of = np.searchsorted(starts, c, side="right") - 1
    first, last = np.maximum(l, c - width + 1), np.minimum(c, r - width + 1)
    base = starts[of]
    return np.array(whole)[of], c - base, first - base, last - base, h[c].view(np.int64)


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("k"), F.col(text).cast("binary").alias("t"))


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    keys, texts, n = [], [], 0
    for part in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if t and len(t) >= SIZE:
                keys.append(k)
                texts.append(t)
                n += len(t)
                if n >= STEP:
                    yield keys, texts
                    keys, texts, n = [], [], 0
    if keys:
        yield keys, texts


def repeated(text: np.ndarray, starts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Which of ``starts`` have an equal ``size``-byte string at another of them."""
    n = len(text)
    ranks = lambda key: np.unique(key, return_inverse=True)[1].astype(np.int64)  # noqa: E731  sort, then name
    t = text.astype(np.int64)
    sampled = np.flatnonzero(np.arange(n) % 3)
    names, have = {}, 3
    at = sampled[sampled + 3 <= n]
    names[3] = np.zeros(n, np.int64)
    names[3][at] = ranks((t[at] << 16) | (t[at + 1] << 8) | t[at + 2])
    while have * 3 <= size - 2:
        at = sampled[sampled + 3 * have <= n]
        old = names[have]
        pair = ranks((old[at] << 32) | old[at + have])
        names[have * 3] = np.zeros(n, np.int64)
        names[have * 3][at] = ranks((pair << 32) | old[at + 2 * have])
        have *= 3
    # a name of size - 2 bytes out of a few names, all places apart by multiples of three
    need = np.unique(np.concatenate([starts, starts + 1, starts + 2]))
    need = need[(need % 3 > 0) & (need + size - 2 <= n)]
    full, done = None, 0
    while done < size - 2:
        span = max(s for s in names if done + s <= size - 2 or s == 3)
        place = min(done, (size - 2 - span) // 3 * 3)
        if place + span < done + 1:
            break
        more = names[span][need + place]
        full = more if full is None else ranks((full << 32) | more)
        done = place + span
    for i in range(done, size - 2):  # what multiples of three leave over
        full = ranks((full << 8) | t[need + i])
    name = np.zeros(n, np.int64)
    name[need] = ranks(full)
    out = np.zeros(len(starts), bool)
    for d in range(3):  # merge the suffixes whose (i + d) is sampled
        mine = np.flatnonzero((starts + d) % 3 > 0)
        i = starts[mine]
        key = name[i + d]
        for b in [*range(d), *range(size - 2 + d, size)]:
            key = (key << 8) | t[i + b]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        hit = np.zeros(len(i), bool)
        hit[1:] |= same
        hit[:-1] |= same
        out[mine[order[hit]]] = True
    return out


def _halves(at: int, x: int, y: int, raw: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Halves (x, y) of the distances [x, y] from start to anchor at which the context ``raw``
    (its anchor at ``at``) has starts, with the digest of what all windows of that half share."""
    m = (x + y) // 2
    for u, v in ((x, m), (m + 1, y)):
        if max(u, at - len(raw) + SIZE) <= min(v, at):
            yield u, v, xxhash.xxh3_128_digest(b"%d,%d," % (u, v) + raw[at - u : at - v + SIZE])


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8")[::2].astype(np.int64)


def _few(keys: DataFrame, name: str) -> DataFrame:
    """Staged keys, broadcast only when counted to be at most ``FEW``; else joined plainly."""
    keys = stage(keys, name)
    return F.broadcast(keys) if keys.count() <= FEW else keys


def _dealt_again(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups ``(g, c, base, raw)`` of at most ``HOT`` contexts for the contexts ``(c, at, x, y,
    raw)`` of hot anchors, and the repeated starts ``(c, from, to)`` of groups that stay larger."""
    spark, groups, done = nodes.sparkSession, None, None
    nodes = stage(nodes, "suffix-hot")
    for _ in range((SIZE - GRAM).bit_length()):

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                g = [d for row in zip(*(x.to_pylist() for x in batch.columns)) for _, _, d in _halves(*row)]
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.binary()), pa.array(_words(g))], ["g", "w"])

        n = nodes.select("at", "x", "y", "raw").mapInArrow(count, "g binary, w long").groupBy("g", "w").count().where("count > 1")
        n = stage(n, "suffix-halves")
        shared = spark.sparkContext.broadcast(bit_table(n.select("w"), bits=FILTER_BITS))

        def deal(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [(d, c, at, u, v, raw) for c, at, x, y, raw in zip(*(x.to_pylist() for x in batch.columns)) for u, v, d in _halves(at, x, y, raw)]
                ok = has_bit(shared.value, slots(_words([r[0] for r in out]), FILTER_BITS)).tolist()
                cols = list(zip(*(r for r, o in zip(out, ok) if o))) or [()] * 6
                kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["g", "c", "at", "x", "y", "raw"])

        halves = stage(nodes.select("c", "at", "x", "y", "raw").mapInArrow(deal, "g binary, c binary, at int, x int, y int, raw binary"), "suffix-dealt")
        large = _few(n.where(F.col("count") > HOT).select("g"), "suffix-large")
        base = F.greatest(F.col("at") - F.col("y"), F.lit(0))
        piece = F.substring("raw", base + 1, F.col("at") - F.col("x") + SIZE - base)
        small = halves.join(large, "g", "left_anti").select("g", "c", base.alias("base"), piece.alias("raw"))
        groups = small if groups is None else groups.unionByName(small)
        nodes = halves.join(large, "g").select("c", "at", "x", "y", "raw")
        start = (F.col("at") - F.col("x")).alias("from")
        single = nodes.where("x = y").select("c", start, start.alias("to"))
        done = single if done is None else done.unionByName(single)
        nodes = nodes.where("x < y")
        if nodes.isEmpty():
            break
    return groups, done


def repeated_starts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(k, t, lo, hi)``: ranges of starts (last included) whose string starts elsewhere too."""
    spark = docs.sparkSession

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _steps(batches):
            of, c, lo, hi, h = anchors(texts, SIZE, GRAM)
            digest = xxhash.xxh3_64_intdigest
            ctx = np.array([digest(texts[o][a : b + SIZE]) for o, a, b in zip(of.tolist(), lo.tolist(), hi.tolist())], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ctx)], ["h", "c"])

    rows = _rows(docs, text, key)
    seen = rows.select("k", "t").mapInArrow(first, "h long, c long").groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("x"), F.max("c").alias("y"))
    seen = stage(seen.where("n > 1").select("h", "n", (F.col("x") != F.col("y")).alias("differ")), "suffix-anchors")
    shared = spark.sparkContext.broadcast(bit_table(seen.select("h"), bits=FILTER_BITS))
    differ = spark.sparkContext.broadcast(bit_table(seen.where("differ").select("h"), bits=FILTER_BITS))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for keys, texts in _steps(batches):
            of, c, lo, hi, h = anchors(texts, SIZE, GRAM)
            at = np.flatnonzero(has_bit(shared.value, slots(h, FILTER_BITS)))
            of, c, lo, hi, h = of[at], c[at], lo[at], hi[at], h[at]
            send = has_bit(differ.value, slots(h, FILTER_BITS)).tolist()
            ids = {o: xxhash.xxh64_intdigest(texts[o], 42) for o in set(of.tolist())}
            ids = {o: x - (1 << 64) if x >> 63 else x for o, x in ids.items()}
            ctx, raw = [], []
            for o, a, b, s in zip(of.tolist(), lo.tolist(), hi.tolist(), send):
                body = texts[o][a : b + SIZE]
                d = xxhash.xxh3_128_digest(body)
                ctx.append(d)
                if s and d not in sent:
                    if len(sent) > 300_000:
                        sent.clear()
                    sent.add(d)
                    raw.append(body)
                else:
                    raw.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h), pa.array(ctx, pa.binary()), pa.array([keys[o] for o in of.tolist()], pa.int64()), pa.array([ids[o] for o in of.tolist()], pa.int64()),
                    pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array((c - lo).astype(np.int32)), pa.array(raw, pa.binary()),
                ],
                ["h", "c", "k", "t", "lo", "hi", "at", "raw"],
            )

    found = stage(rows.select("k", "t").mapInArrow(second, "h long, c binary, k long, t long, lo int, hi int, at int, raw binary"), "suffix-contexts")
    whole = found.groupBy("c").count().where("count > 1").select("c", F.lit(0).alias("from"), F.lit(SIZE).alias("to"))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranges(ctx: list[bytes], at: list[int], raw: list[bytes]) -> pa.RecordBatch:
            text = np.frombuffer(b"".join(raw), np.uint8)
            length = np.array([len(r) for r in raw], np.int64)
            base, n = np.cumsum(length) - length, length - SIZE + 1
            of = np.repeat(np.arange(len(raw)), n)
            starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + base[of]
            hit = repeated(text, starts)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            a, b = edge[::2], edge[1::2] - 1
            cut = of[a] != of[b]  # a run over several contexts: one range for each
            out_c, out_a, out_b = [], [], []
            for i, j, over in zip(a.tolist(), b.tolist(), cut.tolist()):
                while over and of[i] != of[j]:
                    end = int(np.searchsorted(of, of[i], side="right")) - 1
                    out_c.append(ctx[of[i]])
                    out_a.append(int(starts[i] - base[of[i]]) + at[of[i]])
                    out_b.append(int(starts[end] - base[of[i]]) + at[of[i]])
                    i = end + 1
                out_c.append(ctx[of[i]])
                out_a.append(int(starts[i] - base[of[i]]) + at[of[i]])
                out_b.append(int(starts[j] - base[of[j]]) + at[of[j]])
            return pa.RecordBatch.from_arrays([pa.array(out_c, pa.binary()), pa.array(out_a, pa.int32()), pa.array(out_b, pa.int32())], ["c", "from", "to"])

        ctx: list[bytes] = []
        at: list[int] = []
        raw: list[bytes] = []
        group_at, n, now, last = 0, 0, None, None
        for batch in batches:
            for g, c, b, r in zip(*(x.to_pylist() for x in batch.columns)):
                if g != now:
                    if len(ctx) - group_at == 1:  # alone with its anchor: nothing to compare
                        n -= len(raw.pop())
                        ctx.pop()
                        at.pop()
                    if n >= CHUNK:
                        yield ranges(ctx, at, raw)
                        ctx, at, raw, n = [], [], [], 0
                    now, last, group_at = g, None, len(ctx)
                if c != last:
                    ctx.append(c)
                    at.append(b)
                    raw.append(r)
                    n += len(r)
                    last = c
        if len(ctx) - group_at == 1:
            ctx.pop()
            at.pop()
            raw.pop()
        if ctx:
            yield ranges(ctx, at, raw)

    texts = found.where("raw IS NOT NULL")
    hot = _few(seen.where("differ").where(F.col("n") > HOT).select("h"), "suffix-hot")
    groups = texts.join(hot, "h", "left_anti").select(F.col("h").cast("string").cast("binary").alias("g"), "c", F.lit(0).alias("base"), "raw")
    nodes = texts.join(hot, "h").select("c", "at", F.lit(0).alias("x"), F.lit(SIZE - GRAM).alias("y"), "raw").dropDuplicates(["c"])
    more, single = _dealt_again(nodes)
    texts = groups.unionByName(more).repartition("g").sortWithinPartitions("g", "c")
    parts = texts.mapInArrow(sort, "c binary, from int, to int").unionByName(single)
    spans = found.select("c", "k", "t", "lo", "hi").join(whole.unionByName(parts), "c")
    return spans.select("k", "t", (F.col("lo") + F.col("from")).alias("lo"), F.least(F.col("hi"), F.col("lo") + F.col("to")).alias("hi"))


def cut_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept)``: every text's bytes without the repeats."""
    ranges = stage(repeated_starts(docs, text, key), "suffix-ranges")
    lists = ranges.groupBy("k", "t").agg(F.collect_set(F.struct("lo", "hi")).alias("r"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("x")).withColumn("t", F.xxhash64("x"))
    marked = mark_maybe(rows, "t", ranges, "t", "may")
    size = F.octet_length("x").cast("long")
    zero = F.lit(0).cast("long")
    same = marked.where("NOT may").select("key", size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("x").cast("binary").alias("kept"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for x, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept, at, n = [], 0, 0
                for lo, hi in sorted((p["lo"], p["hi"] + SIZE) for p in r or []):
                    if n and lo <= at:
                        at = max(at, hi)
                        continue
                    kept.append(x[at:lo])
                    at, n = hi, n + 1
                kept.append(x[at:])
                body = b"".join(kept)
                for c, v in zip(out, (len(x), len(x) - len(body), n, body)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())], ["key", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    touched = marked.where("may").join(lists, ["k", "t"], "left").select("key", F.col("x").cast("binary").alias("x"), "r")
    return same.unionByName(touched.mapInArrow(cut, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every document."""
    out = cut_repeats(read(spark, sf_dir, "documents"))
    return out.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
