"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def handoff(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage is
    cut and a lost executor costs a re-read, not a recomputation."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["handoff_path"] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete hand-off tables that nothing reads any more: all that was made
    from them is written itself."""
    for t in tables:
        path = t.__dict__.pop("handoff_path", None)
        if path:
            jvm, jsc = t.sparkSession._jvm, t.sparkSession._jsc
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(jsc.hadoopConfiguration()).delete(place, True)


#: Bytes of a batch of texts that Spark hands to Python at a time.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Bound the session's batches by bytes: ten thousand rows, Spark's usual
    bound, are tens of megabytes of texts on both sides, several times over."""
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Hand freed memory back to the system: a worker waits for its next task
    with what its last one held, beside an executor that needs the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def tidy(fn):
    """A function for mapInArrow that gives its memory back at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()
    return run


def tidy_group(fn, inputs: int = 1):
    """A function for applyInArrow over ``inputs`` tables that gives its memory
    back after each group."""
    def one(table: pa.Table) -> pa.Table:
        try:
            return fn(table)
        finally:
            give_back()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return fn(left, right)
        finally:
            give_back()
    return two if inputs == 2 else one


def row_slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes sum to at most ``limit`` (a larger
    row stands alone), so a task's working memory doesn't follow the batch."""
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def text_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer over uint64 (in place on a copy)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class RollingBytes:
    """Hashes of any byte ranges of a buffer from one prefix sum: the range
    [s, e) hashes to sum(T[byte i] * B**-(i - s)) modulo 2**64, then mixed."""

    BASE = 0x9E3779B97F4A7C15 | 1
    _powers: dict[str, np.ndarray] = {}

    @classmethod
    def _power(cls, which: str, base: int, n: int) -> np.ndarray:
        have = cls._powers.get(which)
        if have is None or len(have) < n:
            size = max(n, 1 << 16)
            out = np.empty(size, dtype=np.uint64)
            out[0], done = 1, 1
            while done < size:  # doubling: base**(done + i) = base**done * base**i
                step = min(done, size - done)
                out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
            cls._powers[which] = have = out
        return have[:n]

    _table = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.up = self._power("up", self.BASE, n + 1)
        terms = self._table[data]
        terms *= self._power("down", pow(self.BASE, -1, 1 << 64), n + 1)[:n]
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[end] - self.prefix[start]) * self.up[start])

    def every(self, k: int) -> np.ndarray:
        """The hash of every k bytes that follow each other."""
        if len(self.prefix) <= k:
            return np.zeros(0, dtype=np.uint64)
        out = self.prefix[k:] - self.prefix[:-k]
        out *= self.up[:len(out)]
        return mix64(out)


class Roots:
    """Roots of the linked rows of a task's table."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def sum_vectors(spark: SparkSession, parts: DataFrame, n_slices: int, width: int) -> np.ndarray:
    """Sum rows (slice int, values binary of int64) into one vector of
    n_slices * width: bounded by its width, not by the corpus."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(v.as_buffer(), dtype=np.int32)
                sums[k] = sums[k] + x if k in sums else x.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                names=["slice", "values"])

    out = np.zeros(n_slices * width, dtype=np.int64)
    rows = (parts.repartition(n_slices, "slice").mapInArrow(add, "slice int, values binary")).collect()
    for r in rows:
        out[r["slice"] * width:(r["slice"] + 1) * width] += np.frombuffer(r["values"], dtype=np.int64)
    return out


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: ``edges`` (a, b long) to rows
    (node, component), component the smallest node reachable.

    Alternates large-star and small-star steps; the edge set never grows, each
    round is written to the shared folder, and hubs are pre-aggregated by
    ``min`` before the join.  Null ends and loops are ignored; nodes without
    edges don't occur in the result."""
    edges = (edges.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges = handoff(edges, f"{name}-0")
    sign = None
    for i in range(1, max_rounds + 1):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.select("u", F.col("m").alias("v"))).distinct())
        before, edges = edges, handoff(small, f"{name}-{i}")
        discard(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct())
