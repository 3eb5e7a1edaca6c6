"""Vectors for the search and near-duplicate operators: cleaning, Gram matrix, packed blocks.

Null vectors, and vectors with null or non-finite components, are left out here. Shorter
vectors count as padded with zeros up to the table's longest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def longest(df: DataFrame, vector: str) -> int:
    """Components of the longest vector (0 for an empty table)."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0


def usable(vector: str):
    x = F.col(vector)
    return x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, padded with zeros, as doubles."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(offsets)
    out = np.zeros((len(column), dims))
    at = np.repeat(np.arange(len(size)), size) * dims + np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], size)
    out.reshape(-1)[at] = flat[offsets[0] : offsets[-1]]
    return out


def gram(df: DataFrame, vector: str, dims: int, prepare: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of x x^T for the prepared vectors x; merged row by row of the matrix."""
    if not dims:
        return np.zeros((0, 0))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = prepare(matrix(batch.column(0), dims))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "row"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[i] = sums.get(i, 0.0) + np.frombuffer(raw)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["i", "row"])

    kind = "i int, row binary"
    out = np.zeros((dims, dims))
    for r in df.select(vector).mapInArrow(partial, kind).repartition(min(dims, 16), "i").mapInArrow(merge, kind).collect():  # dims rows
        out[r.i] = np.frombuffer(r.row)
    return out


def rotation(g: np.ndarray) -> np.ndarray:
    """Orthonormal columns, by falling singular value of the data behind the Gram matrix."""
    return np.linalg.eigh(g)[1][:, ::-1].copy() if len(g) else g


def packed(df: DataFrame, group: str, columns: list[str], size: int) -> DataFrame:
    """Sorted rows (id long, ..., raw binary) in blocks of at most ``size``, within partitions.

    ``df`` must be sorted inside its partitions. A block holds rows of one value of the
    integer column ``group`` only. Returns (block, group, n, one binary for each of
    ``columns``): long and double columns as little-endian numbers, binaries end to end.
    """
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[list] = [[] for _ in columns]
        of = None

        def block() -> pa.RecordBatch:
            cols = [b"".join(h) if kinds[c] == "binary" else np.array(h, "<f8" if kinds[c] == "double" else "<i8").tobytes() for c, h in zip(columns, held)]
            return pa.RecordBatch.from_arrays(
                [pa.array([base + number], pa.int64()), pa.array([of], pa.int32()), pa.array([len(held[0])], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)],
                ["block", group, "n", *columns],
            )

        for batch in batches:
            groups = batch.column(0).to_pylist()
            values = [c.to_pylist() for c in batch.columns[1:]]
            for i, g in enumerate(groups):
                if held[0] and (g != of or len(held[0]) >= size):
                    yield block()
                    number += 1
                    held = [[] for _ in columns]
                of = g
                for h, v in zip(held, values):
                    h.append(v[i])
        if held[0]:
            yield block()

    return df.select(group, *columns).mapInArrow(run, f"block long, {group} int, n int, " + ", ".join(f"{c} binary" for c in columns))
