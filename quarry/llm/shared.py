"""Which 64-bit keys do several texts have: a distributed exact count whose
shuffle takes about three bytes a key.

Every block of texts sends its keys to buckets, and a bucket returns to each
block the keys that two texts have, with the number of texts.  A key travels as
its bucket (from the upper bits) and its lowest three bytes; keys that agree in
both are counted as one, so a count may be too large, never too small."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from quarry.llm.common import row_slices, text_sizes
from quarry.llm.packed import columns, expand, packed, squeeze

SLICE_BYTES = 2 << 20
#: Keys that a task holds at a time.
FLUSH = 500_000
SCHEMA = "block int, bucket int, data binary"

KeySets = Callable[[list[bytes]], list[np.ndarray]]


def slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) of a text column in bounded parts."""
    for lo, hi in row_slices(text_sizes(column), SLICE_BYTES):
        yield lo, [(t or "").encode("utf-8") for t in column.slice(lo, hi - lo).to_pylist()]


def place(key: np.ndarray, buckets: int) -> np.ndarray:
    """What travels of each key, as one number: its bucket and three bytes."""
    return ((key >> np.uint64(40)) % np.uint64(buckets) << np.uint64(24) | key & np.uint64(0xFFFFFF)).astype(np.int64)


def _planes(low: np.ndarray) -> bytes:
    """Three-byte numbers, byte by byte: sorted ones compress well."""
    return b"".join((low >> k & 255).astype(np.uint8).tobytes() for k in (16, 8, 0))


def _low(data: bytes, n: int, at: int) -> np.ndarray:
    p = np.frombuffer(data, dtype=np.uint8, count=3 * n, offset=at).astype(np.int64).reshape(3, n)
    return p[0] << 16 | p[1] << 8 | p[2]


def key_rows(key_sets: KeySets, buckets: int):
    """For mapInArrow over (text, block): rows (bucket int, data binary);
    ``key_sets`` gives the distinct keys of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        owners: list[int] = []
        held = 0

        def flush() -> pa.RecordBatch:
            size = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
            key = place(np.concatenate(sets), buckets)
            block = np.repeat(np.array(owners, dtype=np.int64), size)
            order = np.lexsort((key & 0xFFFFFF, block, key >> 24))
            block, key = block[order], key[order]
            first = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (key[1:] != key[:-1])))
            times = np.minimum(np.diff(np.append(first, len(key))), 255).astype(np.uint8)
            block, bucket, low = block[first], key[first] >> 24, key[first] & 0xFFFFFF
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            out = []
            for a, e in zip(cut.tolist(), [*cut[1:].tolist(), len(low)]):
                begin = np.flatnonzero(np.append(True, np.diff(block[a:e]) != 0))
                out.append(squeeze(packed(block[a:e][begin], begin) + (e - a).to_bytes(8, "little") + _planes(low[a:e]) + times[a:e].tobytes()))
            sets.clear()
            owners.clear()
            return pa.RecordBatch.from_arrays([pa.array(bucket[cut].astype(np.int32)), pa.array(out, pa.binary())], names=["bucket", "data"])

        for b in batches:
            for lo, texts in slices(b.column(0)):
                new = key_sets(texts)
                sets += new
                owners += b.column(1).slice(lo, len(texts)).to_pylist()
                held += sum(map(len, new))
                if held > FLUSH:
                    yield flush()
                    held = 0
        if held:
            yield flush()
    return run


def shared_keys(table: pa.Table) -> pa.Table:
    """For applyInArrow by bucket: rows SCHEMA, the keys that two texts have
    and how many, for each block that has them."""
    bucket, blocks, lows, counts = table.column("bucket")[0].as_py(), [], [], []
    for x in map(expand, table.column("data").to_pylist()):
        (block, begin), at = columns(x, 2)
        n = int.from_bytes(x[at:at + 8], "little")
        blocks.append(np.repeat(block, np.diff(np.append(begin, n))))
        lows.append(_low(x, n, at + 8))
        counts.append(np.frombuffer(x, dtype=np.uint8, count=n, offset=at + 8 + 3 * n))
    block, low, count = map(np.concatenate, (blocks, lows, counts))
    order = np.argsort(low, kind="stable")
    block, low, count = block[order], low[order], count[order]
    first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    size = np.diff(np.append(first, len(low)))
    texts = np.repeat(np.add.reduceat(count.astype(np.int64), first), size)
    keep = texts >= 2
    block, low, texts = block[keep], low[keep], texts[keep]
    order = np.lexsort((low, block))
    block, low, texts = block[order], low[order], texts[order]
    fresh = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (low[1:] != low[:-1]))) if len(low) else np.zeros(0, dtype=np.int64)
    block, low, texts = block[fresh], low[fresh], texts[fresh]
    cut = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(low) else fresh
    data = [squeeze((e - a).to_bytes(8, "little") + _planes(low[a:e]) + texts[a:e].astype(np.int32).tobytes()) for a, e in zip(cut.tolist(), [*cut[1:].tolist(), len(low)])]
    return pa.table({"block": pa.array(block[cut].astype(np.int32)), "bucket": pa.array(np.full(len(cut), bucket, dtype=np.int32)), "data": pa.array(data, pa.binary())})


class SharedKeys:
    """A block's answers: how many texts have a key (1 where none else has)."""

    def __init__(self, buckets_of: list[int], data: list[bytes], buckets: int):
        keys, texts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for bucket, x in zip(buckets_of, map(expand, data)):
            n = int.from_bytes(x[:8], "little")
            keys.append(_low(x, n, 8) | bucket << 24)
            texts.append(np.frombuffer(x, dtype=np.int32, count=n, offset=8 + 3 * n).astype(np.int64))
        known, number = np.concatenate(keys), np.concatenate(texts)
        order = np.argsort(known)
        self.known, self.number, self.buckets = known[order], number[order], buckets

    def texts_with(self, key: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.ones(len(key), dtype=np.int64)
        want = place(key, self.buckets)
        at = np.minimum(np.searchsorted(self.known, want), len(self.known) - 1)
        return np.where(self.known[at] == want, self.number[at], 1)
