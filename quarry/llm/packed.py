"""Compact rows for shuffles of many small values: columns of numbers and
batches of rows travel as compressed bytes, one row for each pair of places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import tidy

#: Of the compression of what is shuffled.
LEVEL = 6


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as differences, each in its smallest width:
    most of what travels is sorted or small."""
    parts = [len(columns[0]).to_bytes(8, "little")]
    for c in columns:
        step = np.diff(c.astype(np.int64), prepend=0)
        width = next(w for w in (1, 2, 4, 8) if not len(step) or (step.min() >= -(1 << 8 * w - 1) and step.max() < 1 << 8 * w - 1))
        parts += [bytes([width]), step.astype(f"<i{width}").tobytes()]
    return b"".join(parts)


def columns(data: bytes, count: int) -> tuple[list[np.ndarray], int]:
    """The columns of packed(), and where they end."""
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for _ in range(count):
        width = data[at]
        out.append(np.cumsum(np.frombuffer(data, dtype=f"<i{width}", count=n, offset=at + 1), dtype=np.int64))
        at += 1 + n * width
    return out, at


def expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(rows: list[bytes]) -> pa.Table | None:
    tables = [pa.ipc.open_stream(r).read_all() for r in rows]
    return pa.concat_tables(tables) if tables else None


def packed_blocks(rows: DataFrame) -> DataFrame:
    """Rows whose last column is a block number, as (block, data): all other
    columns of a batch's rows of one block as one value of unpack()."""
    names = rows.columns[:-1]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(len(names)).to_numpy(zero_copy_only=False)
            order = np.argsort(at, kind="stable")
            ends = np.flatnonzero(np.append(np.diff(at[order]) != 0, True)) + 1
            part = pa.RecordBatch.from_arrays(b.columns[:-1], names=names)
            cuts = [order[a:e] for a, e in zip([0, *ends[:-1].tolist()], ends.tolist())] if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array([int(at[c[0]]) for c in cuts], pa.int32()), pa.array([ipc(part.take(pa.array(c))) for c in cuts], pa.binary())], names=["block", "data"])

    return rows.mapInArrow(tidy(pack), "block int, data binary")
