"""Operator 6 - best-fit packing by a configuration linear program.

Documents become pieces of at most ``capacity`` tokens.  Only the histogram of
piece lengths (at most ``capacity`` numbers, whatever the corpus) reaches the
driver.  There the configuration LP

    min sum_c x_c   with   sum_c a[c, L] x_c >= n_L for every length L

is covered by multiplicative weights: the length weights price a knapsack
dynamic program over the capacity, one pass of which gives the best
configuration by longest length; those within ``NEAR`` of the best get a step of
as many whole copies as their scarcest length allows, and the weights of the
lengths they cover shrink.  A cover goes on until at most a ``REST`` of the tokens
is left, which is packed best fit decreasing, in bulk over equal lengths: the
rounding remainder, and the only part that best fit packs.  Each cover's prices
bound the number of sequences from below; while the gap is above ``GAP``, up to
``COVERS`` covers follow with weights raised for lengths in loose configurations,
and the fewest sequences count.  The plan is a list of
(configuration, copies) whose size doesn't depend on the number of documents;
Spark numbers the pieces of each length in data-derived buckets and looks each
number up in the plan.

Defined cases: null text is empty; an empty document is one piece holding the
end token; repeated rows are packed each on its own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.llm.bpe import SLICE_BYTES, codec, texts_of, vocabulary_path
from quarry.llm.common import handoff, row_slices, text_batches, text_sizes, tidy

CAPACITY = 4096
END_ID = 1
WEIGHT_STEP = 0.1
NEAR = 0.05
REST = 1 / 128
GAP = 1 / 1000
COVERS = 4
#: Above 1, so that equal room isn't given to the shortest lengths first.
WEIGHT_POWER = 1.5
#: Pieces of one length that one task numbers, about.
BUCKET_PIECES = 200_000

Plan = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, times), ...), copies


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32) of the tokenised documents."""
    path = path or vocabulary_path()
    kind = docs.schema[key].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            for lo, hi in row_slices(text_sizes(b.column(1)), SLICE_BYTES):
                row, piece, size, crc = [], [], [], []
                for i, ids in enumerate(bpe.encode_batch(texts_of(b.column(1), lo, hi)), lo):
                    ids += end
                    for k in range(0, len(ids), 4 * capacity):
                        part = ids[k:k + 4 * capacity]
                        row.append(i)
                        piece.append(k // (4 * capacity))
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                at = np.array(piece, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), pa.array(at), pa.array(at.astype(np.int64) * capacity),
                     pa.array(size, pa.int64()), pa.array(crc, pa.int64())], names=[key, "piece", "start", "length", "ids_crc32"])

    return docs.select(key, text).mapInArrow(tidy(run), f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


# -- the plan, on the driver, from the histogram alone -----------------------
def _knapsack(lengths: np.ndarray, most: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, Callable[[int], dict[int, int]]]:
    """For each of the ascending lengths, the value of the most valuable
    multiset that has it as its longest, with at most ``most`` of each, and a
    function that gives the multiset.  Bounded multiples are binary bundles, so
    every bundle is one vector step of the dynamic program over the capacity; a
    length's last bundle is the single piece that its own multisets have."""
    sizes, values = lengths.tolist(), value.tolist()
    bundles, single = [], []
    for i, m in enumerate(np.minimum(most, capacity // lengths).tolist()):
        m, size = m - 1, 1
        while m > 0:
            bundles.append((i, min(size, m)))
            m -= size
            size *= 2
        single.append(len(bundles))
        bundles.append((i, 1))
    best, top = np.zeros(capacity + 1), np.zeros(len(sizes))
    took = np.full((len(bundles) + 1, capacity + 1), -1, dtype=np.int16 if len(bundles) < 1 << 15 else np.int32)
    for row, (i, k) in enumerate(bundles):
        if row == single[i]:
            top[i] = values[i] + best[capacity - sizes[i]]
        w = sizes[i] * k
        took[row + 1] = took[row]  # the last bundle taken so far, by room
        other = best[:capacity + 1 - w] + values[i] * k
        took[row + 1, w:][other > best[w:]] = row
        np.maximum(best[w:], other, out=best[w:])

    def multiset(longest: int) -> dict[int, int]:
        out, at = {sizes[longest]: 1}, capacity - sizes[longest]
        row = took[single[longest], at]
        while row >= 0:
            i, k = bundles[row]
            out[sizes[i]] = out.get(sizes[i], 0) + k
            at -= sizes[i] * k
            row = took[row, at]
        return out

    return top, multiset


def cover(count: dict[int, int], capacity: int, weight: dict[int, float], step: float = WEIGHT_STEP) -> tuple[Plan, dict[int, int], float]:
    """(whole copies of configurations, the pieces left, the dual bound)."""
    left, weight, found, bound = dict(count), dict(weight), [], 0.0
    tokens = sum(L * n for L, n in count.items())
    end = tokens * REST
    while tokens > end:
        open_ = np.array(sorted(left), dtype=np.int64)
        price = np.array([weight[L] for L in open_.tolist()])
        need = np.array([left[L] for L in open_.tolist()])
        top, multiset = _knapsack(open_, need, price, capacity)
        # no configuration is worth more than top.max(), so the prices over it are feasible duals
        bound = bound or float(need @ price / top.max())
        for i in np.flatnonzero(top >= (1 - NEAR) * top.max())[::-1].tolist():
            config = multiset(i)
            copies = min(left.get(L, 0) // k for L, k in config.items())  # until its scarcest length is covered
            if not copies:
                continue
            found.append((tuple(sorted(config.items(), reverse=True)), copies))
            for L, k in config.items():
                left[L] -= k * copies
                tokens -= L * k * copies
                # those that it served weigh less from here, the others more against them
                weight[L] *= np.exp(-step * k * copies / count[L])
                if not left[L]:
                    del left[L]
            if tokens <= end:
                break
    return found, left, bound


def solve(count: dict[int, int], capacity: int) -> tuple[Plan, int, int]:
    """(plan, its sequences that best fit packed, the dual bound on sequences)."""
    start = {L: (L / capacity) ** WEIGHT_POWER for L in count}
    weight, best, size, rest_size = start, [], 0, 0
    bound = sum(L * n for L, n in count.items()) / capacity  # the volume's duals
    for _ in range(COVERS if count else 0):
        found, left, dual = cover(count, capacity, weight)
        rest = best_fit(left, capacity)
        bound = max(bound, dual)
        n, fitted = sum(c for _, c in found + rest), sum(c for _, c in rest)
        if not best or n < size:
            best, size, rest_size = found + rest, n, fitted
        least = math.ceil(bound - 1e-6)
        if size <= least * (1 + GAP):
            break
        # a piece's share in its configurations' unused room raises its weight
        cost = dict.fromkeys(count, 0.0)
        for content, copies in found + rest:
            loose = capacity / sum(L * k for L, k in content)
            for L, k in content:
                cost[L] += k * copies * loose
        weight = {L: math.sqrt(weight[L] * start[L] * cost[L] / count[L]) for L in count}
    return best, rest_size, math.ceil(bound - 1e-6)


def best_fit(count: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing where bins of equal content are one group: each
    length fills the fullest bins that still take it, a group at a time."""
    rooms: list[int] = []  # rooms that some group has, ascending
    groups: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}

    def put(room: int, content: tuple, copies: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((content, copies))

    for L in sorted((x for x, n in count.items() if n > 0), reverse=True):
        n = count[L]
        while n:
            at = bisect_left(rooms, L)
            if at == len(rooms):  # new bins, each as full as this length makes it
                k = capacity // L
                if n >= k:
                    put(capacity - k * L, ((L, k),), n // k)
                if n % k:
                    put(capacity - (n % k) * L, ((L, n % k),), 1)
                break
            room = rooms[at]
            content, copies = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            k = min(room // L, max(1, n // copies))
            use = min(copies, n // k)
            put(room - k * L, (*content, (L, k)), use)
            if copies > use:
                put(room, content, copies - use)
            n -= k * use
    return [g for room in rooms for g in groups[room]]


def make_plan(count: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for a histogram; full pieces are sequences of their own."""
    full = count.get(capacity, 0)
    rest = {L: n for L, n in count.items() if L < capacity and n > 0}
    return ([(((capacity, 1),), full)] if full else []) + solve(rest, capacity)[0]


def plan_table(plan: Plan) -> dict[str, np.ndarray]:
    """For each length, ranges of piece numbers: piece number r of length L in
    [first, next first) is item (r - first) % times of copy (r - first) // times."""
    rows, base, used = [], 0, {}
    for content, copies in plan:
        offset = 0
        for L, k in content:
            first = used.get(L, 0)
            rows.append((L, first, k, base, offset))
            used[L] = first + k * copies
            offset += L * k
        base += copies
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "times", "base", "offset"), cols))


def numbered(piece_rows: DataFrame, n_rows: int, order: list[str]) -> DataFrame:
    """Add ``rank``: 0.. within each length, without one task per length.
    Buckets come from the data (a hash of the keys), so they're the same
    wherever and however often they are computed."""
    buckets = max(1, -(-n_rows // BUCKET_PIECES))
    rows = piece_rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("length", "bucket").orderBy(*order, "ids_crc32")
    return (rows.withColumn("rn", F.row_number().over(inside) - 1).join(starts, ["length", "bucket"])
            .withColumn("rank", F.col("begin") + F.col("rn")).drop("bucket", "begin", "rn"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32, sequence_id, offset)."""
    rows = handoff(pieces(docs, path, capacity, end_id, key, text), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = plan_table(make_plan(histogram, capacity))
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(table)  # its size follows the capacity alone
    out = numbered(rows, sum(histogram.values()), [key, "piece"])
    names = [*rows.columns, "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        span = int(t["first"].max(initial=0)) + 1
        line = t["length"] * span + t["first"]
        for b in batches:
            L = b.column(names.index("length")).to_numpy()
            r = b.column(names.index("rank")).to_numpy()
            at = np.searchsorted(line, L * span + np.minimum(r, span - 1), side="right") - 1
            inner = r - t["first"][at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(t["base"][at] + inner // t["times"][at]),
                 pa.array(t["offset"][at] + inner % t["times"][at] * L)], names=[*names[:-1], "sequence_id", "offset"])

    schema = StructType(rows.schema.fields).add("sequence_id", "long").add("offset", "long")
    return out.select(*names).mapInArrow(place, schema)
