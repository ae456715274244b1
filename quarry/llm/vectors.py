"""Reading embedding columns: shared by the two vector operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (vec_id long, v binary) with the components as little-endian
    doubles; v is null for vectors that are null, empty, zero or hold a null or
    a non-finite component.  Equal vectors have equal bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(1)
            values = column.flatten()  # of the rows that aren't null, in order
            x = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) + 0.0  # no -0.0
            size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            end = np.cumsum(size)
            out = []
            for a, e in zip((end - size).tolist(), end.tolist()):
                v = x[a:e]
                good = e > a and np.isfinite(v).all() and (v != 0).any()
                out.append(v.astype("<f8").tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("e")).mapInArrow(run, "vec_id long, v binary")


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a binary column (all of one size) as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    data = [x.as_buffer() for x in column]
    return np.frombuffer(b"".join(data), dtype="<f8").reshape(len(data), -1) if data else np.zeros((0, 0))


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component below
    one: products stay in the range of doubles, and cosines are the same."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, initial=0))[1][:, None])


def norms(v: np.ndarray) -> np.ndarray:
    """Lengths, also where the squares leave the range of doubles."""
    top = np.abs(v).max(1, initial=0)
    top[top == 0] = 1
    return top * np.sqrt(np.einsum("ij,ij->i", v / top[:, None], v / top[:, None]))
