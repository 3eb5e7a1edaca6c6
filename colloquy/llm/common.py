"""Helpers shared by the training-data operators: staging, components, column care."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch one only on plain local masters."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="colloquy-llm-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back (cuts the lineage).

    The folder name is unique for each call, so nothing is overwritten; what a later
    reader needs survives the loss of any executor.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a scratch table that ``stage`` wrote and nothing reads any more."""
    jvm = df.sparkSession._jvm
    if files := df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(files[0])).getParent()
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands texts to Python about BATCH_BYTES at a time (the default
    is 64 MB), so what a task holds of them on either side doesn't follow the texts' size.

    A limit that the user has set stays; a text longer than the limit goes by itself.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


def reliable(df: DataFrame) -> DataFrame:
    """Eager checkpoint into the shared folder, for small tables of iterative steps."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def own_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator on ``docs`` whose further columns may be named like its working columns
    (``__llm_...``): they have other names while it works, and their own again after."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        free = "__kept"
        while any(c.startswith(free) for c in docs.columns):
            free += "_"
        away = {c: f"{free}{i}" for i, c in enumerate(docs.columns) if c.startswith("__llm_")}
        if not away:
            return operator(docs, *args, **kwargs)
        out = operator(docs.withColumnsRenamed(away), *args, **kwargs)
        return out.withColumnsRenamed({inside: c for c, inside in away.items()})

    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` holds undirected pairs of comparable ids (nulls and loops are ignored).
    Returns one row ``(id, component)`` per id that has an edge; ``component`` is the
    smallest id reachable. Every step is a grouped minimum and an equi-join, so a hub
    with many neighbours is aggregated map-side; no group is collected. Between steps
    the edge table is checkpointed reliably.
    """
    e = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))
        .distinct()
    )
    e = reliable(e.select("u", "v"))
    while True:
        # large star: neighbours above u go to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        small = reliable(small)
        # a star forest: nobody is both a centre and a leaf, and each leaf has one centre
        again = small.groupBy("u").count().where("count > 1").select("u").unionByName(
            small.select("u").join(small.select(F.col("v").alias("u")), "u", "left_semi")
        )
        done = again.isEmpty()
        e = small
        if done:
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


BITS = 23  # the bit tables always hold 2 ** BITS bits (1 MB)


def slots(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Slot of each 64-bit key in a bit table."""
    return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def has_bit(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def bit_table(keys: DataFrame, ready: bool = False, bits: int = BITS) -> np.ndarray:
    """One bit a slot for the keys in the first (long) column; ``ready``: it holds slots.

    The table has a fixed size, whatever the number of keys: tasks set bits for their own
    keys, and the tables are merged by ranges. It lets through every key and some others,
    so an exact join must follow; it only spares that join the rows that can't match.
    """
    size, pieces, n_bits = 1 << bits, 16, bits
    width = size // 8 // pieces

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            x = x if ready else slots(x, n_bits)
            np.bitwise_or.at(bits, x >> 3, (128 >> (x & 7)).astype(np.uint8))
        raw = bits.tobytes()
        found = [i for i in range(pieces) if any(raw[i * width : (i + 1) * width])]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([raw[i * width : (i + 1) * width] for i in found], pa.binary())], ["piece", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = np.frombuffer(raw, np.uint8)
                got[i] = got[i] | b if i in got else b
        yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([b.tobytes() for b in got.values()], pa.binary())], ["piece", "bits"])

    kind = "piece int, bits binary"
    parts = keys.select(F.col(keys.columns[0]).cast("long").alias("x")).where("x IS NOT NULL").mapInArrow(mark, kind)
    table = np.zeros(size // 8, np.uint8)
    for row in parts.repartition(pieces, "piece").mapInArrow(merge, kind).collect():  # at most ``pieces`` rows of a fixed size
        table[row.piece * width : (row.piece + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return table


def mark_maybe(df: DataFrame, key: str, keys: DataFrame, name: str, into: str) -> DataFrame:
    """``df`` with the boolean column ``into``: false where ``key`` is surely not in ``keys.name``.

    The bits travel as a broadcast table of at most 2 ** (BITS - 6) rows of two numbers.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << BITS))
    bits = np.unpackbits(bit_table(keys.select(slot(name)), ready=True))
    words = np.packbits(bits, bitorder="little").view("<i8")  # bit i of word w is slot 64 w + i
    at = np.flatnonzero(words)
    known = df.sparkSession.createDataFrame(pd.DataFrame({"__llm_w": at.astype(np.int64), "__llm_bits": words[at]}), "__llm_w long, __llm_bits long")
    out = df.withColumn("__llm_slot", slot(key)).withColumn("__llm_w", F.shiftright("__llm_slot", 6))
    out = out.join(F.broadcast(known), "__llm_w", "left")
    hit = F.expr("bit_get(coalesce(__llm_bits, 0L), cast(__llm_slot & 63 AS int)) = 1")
    return out.withColumn(into, hit).drop("__llm_w", "__llm_slot", "__llm_bits")
