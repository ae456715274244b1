"""Exact k-nearest-neighbour search through a metric index.

History rows belong to the cell of their nearest pivot; a cell knows how near
and how far its rows lie from the pivot, and the box that holds them.  By the
triangle inequality a query at distance d from a pivot is at least
max(d - far, near - d) from every row of the cell, and no row is nearer than the
box, so a cell whose bound is above the query's k-th distance so far needn't
be read.  The balls prune clustered vectors, the boxes those whose columns are
steps and flags:

1. distinct vectors only: of equal history vectors the k smallest ids can be
   neighbours, and equal queries are asked once;
2. pivots are means of a bounded sample; every history row is measured against
   the pivots (a map) and written with its cell, cells make blocks of at most
   ``BLOCK`` rows (small ones together, large ones split);
3. a query's first k-th distance comes from the cells' sizes and bounds, a
   better one from the block of its home cell;
4. a query goes to the blocks that hold a cell within that distance, where
   candidates are re-measured exactly; each returns k rows, merged per query.

A block's queries are dealt into parts of ``BLOCK`` as well, so a task holds two
blocks whatever is frequent.  ``Search.visits`` tells how many rows each query
was measured against.  Rounding can't lose a neighbour: bounds are widened by
more than the error of the distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.knn import knn_topk
from quarry.session import hand_off

#: Pairs that are measured without an index: about a second on eight cores.
SMALL_PAIRS = 1 << 28
#: Rows of a block, history or queries.
BLOCK = 8192
#: Rows that a task measures against the pivots at once: Arrow's batches are
#: longer, and a matrix of 10,000 rows by all pivots takes 160 MB, with each step of it anew.
ASSIGNED = 1024
#: Queries measured against a block's cells at once, those that tell whether it is
#: worth while, and the share of cells in reach from which all rows are measured by one product.
ASKED, TOLD, DENSE = 256, 16, 0.25
#: Queries and rows of a product that is looked at while it is in the cache; rows whose least value is taken together.
ROWS_AT_ONCE, COLUMNS, TOGETHER = 64, 8192, 16
#: Components of a task's rows, and blocks, that are read together where queries go to most blocks.
HELD, MOST_BLOCKS = 1 << 21, 4
#: Rows of a sample (of the approximate search; for pivots), and the most pivots
#: (broadcast with their boxes: 24 bytes a component).
SAMPLE_ROWS = 8192
PIVOT_ROWS = 32_768
MOST_PIVOTS = 2048
ROUNDS = 4
#: Up to so many blocks are broadcast with their number of query parts.
BROADCAST_BLOCKS = 100_000
SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``ASSIGNED``."""
    return (b.slice(lo, ASSIGNED) for b in batches for lo in range(0, b.num_rows, ASSIGNED))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all of ``b``, to about 1e-8 of the lengths."""
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def fit_pivots(sample: np.ndarray, n: int, seed: int = 5) -> np.ndarray:
    """Means of the sample's rows by their nearest mean, from random rows."""
    if not len(sample):
        return sample
    rng = np.random.default_rng(seed)
    pivots = np.unique(sample[rng.permutation(len(sample))[:n]], axis=0)
    for _ in range(ROUNDS):
        home = np.concatenate([distances(sample[lo:lo + 4096], pivots).argmin(1) for lo in range(0, len(sample), 4096)])
        used = np.unique(home)
        pivots = np.stack([sample[home == c].mean(0) for c in used])
    return pivots


class Index:
    """Pivots and, by part and cell: rows, bounds, first block and blocks.
    ``stats``: part, cell, rows, near, far and, if known, the box's ends."""

    def __init__(self, pivots: np.ndarray, stats: list[tuple], k: int, block: int):
        self.pivots, self.k = pivots, k
        # rounding of a distance between rows of such lengths
        self.error = SLACK * (1.0 + float(np.sqrt(np.einsum("ij,ij->i", pivots, pivots).max(initial=0.0))) + max((s[4] for s in stats), default=0.0)) + 1e-7 * max((s[4] for s in stats), default=0.0)
        self.cells: dict[int, dict[str, np.ndarray]] = {}
        self.blocks = 0
        place = {c: i for i, c in enumerate(self._tour())}
        for part in sorted({s[0] for s in stats}):
            mine = sorted((s for s in stats if s[0] == part), key=lambda s: place[s[1]])
            first, parts, held = [], [], block
            for n in (s[2] for s in mine):
                split = -(-n // block)
                if split > 1 or held + n > block:  # a block of its own, or the next one
                    first.append(self.blocks)
                    self.blocks += split
                    held = n if split == 1 else block
                else:
                    first.append(self.blocks - 1)
                    held += n
                parts.append(split)
            column = lambda i, t: np.array([s[i] for s in mine], dtype=t)
            self.cells[part] = {"cell": column(1, np.int64), "n": column(2, np.int64), "near": column(3, float), "far": column(4, float),
                                "first": np.array(first, dtype=np.int64), "split": np.array(parts, dtype=np.int64)}
            if mine and len(mine[0]) > 5:
                self.cells[part] |= {"low": np.array([s[5] for s in mine], dtype=float), "high": np.array([s[6] for s in mine], dtype=float)}

    def _tour(self) -> list[int]:
        """Pivots in an order in which neighbours follow each other."""
        left, out = set(range(len(self.pivots))), []
        at = 0
        while left:
            rest = np.array(sorted(left))
            at = int(rest[distances(self.pivots[at:at + 1], self.pivots[rest])[0].argmin()])
            out.append(at)
            left.remove(at)
        return out

    def bounds(self, part: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and cell: the least distance of a row, and the distance to the pivot."""
        c = self.cells[part]
        d = distances(q, self.pivots[c["cell"]])
        return np.maximum(np.maximum(d - c["far"], c["near"] - d), 0.0) - 2 * self.error, d

    def visits(self, part: int, q: np.ndarray, reach: np.ndarray, spots: np.ndarray | None = None) -> np.ndarray:
        """For each query and cell (``spots`` of them): whether a row may lie within the reach."""
        c = self.cells[part]
        spots = np.arange(len(c["cell"])) if spots is None else spots
        d = distances(q, self.pivots[c["cell"][spots]])
        hit = np.maximum(d - c["far"][spots], c["near"][spots] - d) - 2 * self.error <= reach[:, None]
        if "low" in c:
            low, high = c["low"][spots], c["high"][spots]
            row, at = np.nonzero(hit)
            for p in range(0, len(row), 65_536):
                x, i = row[p:p + 65_536], at[p:p + 65_536]
                gap = np.maximum(np.maximum(low[i] - q[x], q[x] - high[i]), 0.0)
                hit[x, i] = np.sqrt(np.einsum("ij,ij->i", gap, gap)) - 2 * self.error <= reach[x]
        return hit

    def first_reach(self, part: int, d: np.ndarray) -> np.ndarray:
        """Distances within which the cells alone promise k rows (inf: there aren't as many)."""
        c = self.cells[part]
        reach = d + c["far"] + 2 * self.error
        if self.k < reach.shape[1]:  # a cell has a row at least
            order = np.argpartition(reach, self.k - 1, axis=1)[:, :self.k]
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(reach, order, 1), axis=1), 1)
        else:
            order = np.argsort(reach, axis=1)
        enough = np.cumsum(c["n"][order], axis=1) >= self.k
        at = enough.argmax(1)
        out = np.take_along_axis(reach, np.take_along_axis(order, at[:, None], 1), 1)[:, 0]
        return np.where(enough.any(1), out, np.inf)


class Rows:
    """Rows about their mean, in single precision where their size allows it, so
    that one product tells which of them may be near a query."""

    def __init__(self, h: np.ndarray):
        whole = bool(np.isfinite(h).all())
        self.centre = h.mean(0) if whole and len(h) else np.zeros(h.shape[1])
        c = h - self.centre
        norm = np.einsum("ij,ij->i", c, c)
        self.most = float(np.fmax.reduce(norm, initial=0.0))
        self.whole = whole and self.most < 1e300
        self.kind, self.unit = (np.float32, 2.0 ** -24) if self.whole and 1e-20 < self.most < 1e30 else (np.float64, 2.0 ** -53)
        self.table = np.ascontiguousarray(np.concatenate([-2.0 * c, norm[:, None]], axis=1, dtype=self.kind, casting="same_kind").T)

    def near(self, q: np.ndarray, k: int, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all pairs that may be among a query's k nearest rows,
        and within the limit of the squared distance; some more do no harm."""
        c = q - self.centre
        norm = np.einsum("ij,ij->i", c, c)
        asked = np.concatenate([c, np.ones((len(c), 1))], axis=1)
        kind = self.kind if norm.max(initial=0.0) < 1e30 else np.float64
        asked, table = asked.astype(kind), self.table.astype(kind, copy=False)
        # rounding of a value: its operands and a sum of as many products, in any order
        error = (len(self.table) + 4) * self.unit * (2.0 * np.sqrt(norm) * np.sqrt(self.most) + self.most) + SLACK * (norm + self.most) + 1e-12
        limit = np.full(len(q), np.inf) if limit is None else limit - norm + error
        n, found = table.shape[1], []
        for lo in range(0, len(q), ROWS_AT_ONCE):
            most, mine = limit[lo:lo + ROWS_AT_ONCE], asked[lo:lo + ROWS_AT_ONCE]
            for a in range(0, n, COLUMNS):
                value = mine @ table[:, a:a + COLUMNS]
                width = value.shape[1]
                groups = width // TOGETHER
                if width >= k:  # k groups have a row each that is as near as the k-th of their least values
                    least = value[:, :groups * TOGETHER].reshape(len(value), TOGETHER, groups).min(1) if self.whole and groups >= 2 * k else value
                    kth = np.partition(least, k - 1, axis=1)[:, k - 1].astype(float)
                    most = np.minimum(most, kth + 2.0 * error[lo:lo + ROWS_AT_ONCE])
                with np.errstate(over="ignore"):
                    bound = np.nextafter(np.minimum(most, np.finfo(kind).max).astype(kind), kind(np.inf))
                at = np.flatnonzero(value <= np.minimum(bound, np.finfo(kind).max)[:, None])
                found.append((at // width + lo, at % width + a))
        none = np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate([none, *part]) for part in zip(*found)) if found else (none, none)


def ranked(q: np.ndarray, h: np.ndarray, hid: np.ndarray, row: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query's pairs, with their distances; ties go to the smaller id."""
    exact = np.empty(len(row))
    for p in range(0, len(row), 65_536):  # many ties: bounded memory
        diff = h[at[p:p + 65_536]] - q[row[p:p + 65_536]]
        exact[p:p + 65_536] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    order = np.lexsort((hid[at], exact, row))
    row, at, exact = row[order], at[order], exact[order]
    keep = np.arange(len(row)) - np.searchsorted(row, np.arange(len(q)))[row] < k
    return row[keep], at[keep], exact[keep]


def _measure(index: Index, queries: pa.Table, rows: pa.Table, home: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query row, history row, distance) of the k nearest rows of a block
    among the cells in a query's reach, or (at home) among all its rows."""
    k, out = index.k, []
    q, h = _matrix(queries.column("vec")), _matrix(rows.column("vec"))
    reach, part_q = queries.column("reach").to_numpy(), queries.column("part").to_numpy()
    cell, part_h, hid = (rows.column(c).to_numpy() for c in ("cell", "part", "hid"))
    for part in np.unique(part_q).tolist():
        c = index.cells.get(part)
        mine = np.flatnonzero(part_h == part)
        if c is None or not len(mine):
            continue
        mine = mine[np.argsort(cell[mine], kind="stable")]
        first = np.flatnonzero(np.r_[True, np.diff(cell[mine]) != 0])
        ends = [*first[1:].tolist(), len(mine)]
        by_cell = np.argsort(c["cell"], kind="stable")
        spots = by_cell[np.searchsorted(c["cell"][by_cell], cell[mine[first]])]  # of the block's cells in the index
        rows_h, hid_h = h[mine], hid[mine]
        norm_h = np.einsum("ij,ij->i", rows_h, rows_h)
        most, single = norm_h.max(), None
        asked = np.flatnonzero(part_q == part)
        for lo in range(0, len(asked), ASKED):
            x = asked[lo:lo + ASKED]
            norm_q = np.einsum("ij,ij->i", q[x], q[x])
            slack = SLACK * (norm_q + most) + 1e-12
            limit = None if home else np.minimum(reach[x] ** 2 * (1.0 + SLACK) + slack, np.finfo(float).max)  # k rows are known within the reach
            if home or index.visits(part, q[x[:TOLD]], reach[x[:TOLD]], spots).mean() >= DENSE:  # a row too many does no harm
                single = single or Rows(rows_h)
                row, at = single.near(q[x], k, limit)
            else:
                visits, pairs = index.visits(part, q[x], reach[x], spots), [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
                for s, (a, z) in enumerate(zip(first.tolist(), ends)):
                    v = np.flatnonzero(visits[:, s])
                    if len(v):
                        square = norm_q[v][:, None] + norm_h[a:z] - 2.0 * (q[x[v]] @ rows_h[a:z].T)
                        r, y = np.nonzero(square <= limit[v][:, None])
                        pairs.append((v[r], a + y, square[r, y]))
                row, at, square = (np.concatenate(p) for p in zip(*pairs))
                if len(row) > 16 * k * len(x):
                    order = np.lexsort((square, row))
                    row, at, square = row[order], at[order], square[order]
                    begin = np.searchsorted(row, np.arange(len(x) + 1))
                    full = np.diff(begin) >= k
                    kth = np.full(len(x), np.inf)
                    kth[full] = square[begin[:-1][full] + k - 1]
                    kept = square <= (kth + slack)[row]
                    row, at = row[kept], at[kept]
            row, at, exact = ranked(q[x], rows_h, hid_h, row, at, k)
            out.append((x[row], mine[at], exact))
    return out


_FACTS = "part int, cell long, n long, near double, far double, low array<double>, high array<double>"


def _joined(a: list, b: list) -> list:
    return [a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), np.minimum(a[3], b[3]), np.maximum(a[4], b[4])]


def _facts(held: dict[tuple[int, int], list]) -> pa.RecordBatch:
    real = pa.list_(pa.float64())
    columns = zip(*((*key, *found) for key, found in held.items()))
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), real, real))],
                                      names=["part", "cell", "n", "near", "far", "low", "high"])


def _few_equal(rows: DataFrame, k: int) -> DataFrame:
    """The k smallest ids of each (part, vec), written.  Only vectors whose hash occurs
    more than k times are brought together and ranked, the others stay where they are."""
    hashed = hand_off(rows.withColumn("_h", F.xxhash64("part", "vec")), "knn-history")
    many = hand_off(hashed.groupBy("_h").agg(F.count("*").alias("_n")).where(F.col("_n") > k).select("_h"), "knn-equal")
    n = many.count()
    if not n:
        return hashed.drop("_h")
    least = Window.partitionBy("_h", "part", "vec").orderBy("hid")   # a hash first: most vectors are told apart by it
    side = F.broadcast(many) if n <= BROADCAST_BLOCKS else many
    equal = hashed.join(side, "_h", "left_semi").withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= k)
    return hand_off(hashed.join(side, "_h", "left_anti").drop("_h").unionByName(equal.drop("_h", "_n")), "knn-history")


class Search:
    """The k nearest history rows of every query; ties go to the smaller id."""

    def __init__(self, queries: DataFrame, history: DataFrame, k: int, qid: str = "qid", hid: str = "hid", vec: str = "vec",
                 part: str | None = None, block: int = BLOCK, pivots: int | None = None):
        self.k = k
        shape = lambda df, name, to: df.select(F.col(name).cast("long").alias(to), F.col(vec).cast("array<double>").alias("vec"), (F.col(part) if part else F.lit(0)).cast("int").alias("part")).where("vec is not null")
        named = shape(queries, qid, "qid")
        asked = named.groupBy("part", "vec").agg(F.min("qid").alias("q"))
        self.members = named.join(asked, ["part", "vec"]).select("qid", "q")
        held = _few_equal(shape(history, hid, "hid"), k)
        n = held.count()
        sample = held.orderBy(F.xxhash64("part", "hid"), "hid").select("vec").limit(PIVOT_ROWS).toArrow()
        of = pivots or max(1, min(MOST_PIVOTS, int(np.sqrt(n))))
        centres = fit_pivots(_matrix(sample.column("vec")), of)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in short(batches):
                d = distances(_matrix(b.column(1)), centres)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(d[np.arange(len(d)), cell])], names=["hid", "vec", "part", "cell", "d"])

        celled = hand_off(held.mapInArrow(assign, "hid long, vec array<double>, part int, cell long, d double"), "knn-cells")

        def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows, bounds and box of each cell in this task's rows."""
            held: dict[tuple[int, int], list] = {}
            for b in batches:
                x, part, cell, d = _matrix(b.column(1)), *(b.column(i).to_numpy() for i in (2, 3, 4))
                order = np.lexsort((cell, part))
                first = np.flatnonzero(np.r_[True, (np.diff(part[order]) != 0) | (np.diff(cell[order]) != 0)]) if len(order) else []
                for a, z in zip(first, [*first[1:], len(order)]):
                    mine = order[a:z]
                    new = [len(mine), d[mine].min(), d[mine].max(), x[mine].min(0), x[mine].max(0)]
                    key = int(part[mine[0]]), int(cell[mine[0]])
                    held[key] = _joined(held[key], new) if key in held else new
            if held:
                yield _facts(held)

        def joined(t: pa.Table) -> pa.Table:
            rows = [list(r) for r in zip(*(t.column(c).to_pylist() for c in ("n", "near", "far")), _matrix(t.column("low")), _matrix(t.column("high")))]
            return pa.Table.from_batches([_facts({(t.column("part")[0].as_py(), t.column("cell")[0].as_py()): reduce(_joined, rows)})])

        stats = celled.mapInArrow(facts, _FACTS).groupBy("part", "cell").applyInArrow(joined, _FACTS).collect()  # a row for each part and pivot
        index = self.index = Index(centres, [tuple(r) for r in stats], k, block)

        def block_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = {(p, int(x)): (int(f), int(s)) for p, c in index.cells.items() for x, f, s in zip(c["cell"], c["first"], c["split"])}
            for b in batches:
                at = [place[key] for key in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                own = [f + (h * 2654435761 >> 16) % s for (f, s), h in zip(at, b.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int32())], names=[*b.schema.names, "block"])

        self.blocks = celled.select("hid", "vec", "part", "cell").mapInArrow(block_of, "hid long, vec array<double>, part int, cell long, block int")
        self.rows, self.block_rows = n, block
        self.routed = hand_off(self._routed(asked), "knn-routed")

    def _routed(self, asked: DataFrame) -> DataFrame:
        """Distinct queries with their reach, the blocks to visit and the rows to measure."""
        index, k = self.index, self.k

        def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                q, part, home, reach = _matrix(b.column(1)), b.column(2).to_numpy(), np.zeros(b.num_rows, dtype=np.int32), np.full(b.num_rows, np.inf)
                for p in np.unique(part).tolist():
                    if p in index.cells:
                        mine = np.flatnonzero(part == p)
                        c = index.cells[p]
                        for lo in range(0, len(mine), 512):
                            some = mine[lo:lo + 512]
                            _, d = index.bounds(p, q[some])
                            reach[some], spot = index.first_reach(p, d), d.argmin(1)
                            home[some] = c["first"][spot] + (b.column(0).to_numpy()[some] % c["split"][spot])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(reach), pa.array(home)], names=["q", "vec", "part", "reach", "block"])

        begun = hand_off(asked.select("q", "vec", "part").mapInArrow(start, "q long, vec array<double>, part int, reach double, block int"), "knn-begun")

        def better(queries: pa.Table, rows: pa.Table) -> pa.Table:
            reach = queries.column("reach").to_numpy().copy()
            if len(reach) and rows.num_rows:
                for row, _, exact in _measure(index, queries, rows, True):
                    full = np.flatnonzero(np.bincount(row, minlength=len(reach)) >= k)
                    far = np.zeros(len(reach))
                    np.maximum.at(far, row, exact)
                    reach[full] = np.minimum(reach[full], far[full])
            return queries.select(["q", "vec", "part"]).append_column("reach", pa.array(reach))

        reached = self._meet(begun, better, "q long, vec array<double>, part int, reach double")

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = np.zeros(0, dtype=np.int32)
            for b in short(batches):
                q, part, reach = _matrix(b.column(1)), b.column(2).to_numpy(), b.column(3).to_numpy()
                blocks: list[np.ndarray] = [none] * b.num_rows
                measured, cells = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows, dtype=np.int64)
                for p in np.unique(part).tolist():
                    if p in index.cells:
                        c, mine = index.cells[p], np.flatnonzero(part == p)
                        visits = np.concatenate([index.visits(p, q[mine[lo:lo + 512]], reach[mine[lo:lo + 512]]) for lo in range(0, len(mine), 512)])
                        measured[mine], cells[mine] = visits @ c["n"], visits.sum(1)
                        for i, v in zip(mine.tolist(), visits):
                            split = c["split"][v]
                            blocks[i] = np.unique(np.repeat(c["first"][v], split) + np.arange(split.sum()) - np.repeat(split.cumsum() - split, split)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(blocks, pa.list_(pa.int32())), pa.array(cells), pa.array(measured)], names=["q", "vec", "part", "reach", "blocks", "cells", "measured"])

        return reached.mapInArrow(route, "q long, vec array<double>, part int, reach double, blocks array<int>, cells long, measured long")

    def _meet(self, queries: DataFrame, kernel, schema: str, together: int = 1, most: int = 0) -> DataFrame:
        """The kernel over queries (with their block) and the rows of the block
        (``together``: of so many), the queries of a block in parts of bounded size."""
        parts = hand_off(queries.groupBy("block").agg(F.ceil(F.count("*") / (most or self.block_rows)).cast("int").alias("parts")), "knn-parts")
        side = F.broadcast(parts) if self.index.blocks <= BROADCAST_BLOCKS else parts
        left = queries.join(side, "block").withColumn("turn", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int")).drop("parts")
        rows = self.blocks.withColumn("block", F.expr(f"cast(block div {together} as int)")) if together > 1 else self.blocks
        right = rows.join(side, "block").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        return left.groupBy("block", "turn").cogroup(right.groupBy("block", "turn")).applyInArrow(kernel, schema)

    def _shape(self) -> tuple[int, int]:
        """Blocks to read together, and queries of a part: where queries go to
        most blocks, larger ones travel less often, as long as all cores have some."""
        told = self.routed.agg(F.avg(F.size("blocks")).alias("mean"), F.sum(F.size("blocks")).alias("sent"), F.max(F.size("vec")).alias("width")).first()
        cores = self.routed.sparkSession.sparkContext.defaultParallelism
        wanted = int((told["mean"] or 0) / (2 * np.ceil(np.sqrt(cores))))
        together = max(1, min(MOST_BLOCKS, HELD // (self.block_rows * max(1, told["width"] or 1)), wanted))
        return together, max(self.block_rows, min(together * self.block_rows, (told["sent"] or 0) // (together * 4 * cores)))

    def visits(self) -> DataFrame:
        """For each distinct query: cells visited and rows measured."""
        return self.routed.select("q", "cells", "measured")

    def neighbours(self) -> DataFrame:
        """Rows (qid, hid, dist, rank)."""
        index = self.index

        def nearest(queries: pa.Table, rows: pa.Table) -> pa.Table:
            found = _measure(index, queries, rows, False) if queries.num_rows and rows.num_rows else []
            q, h = queries.column("q").to_numpy(), rows.column("hid").to_numpy()
            join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, dtype=kind)])
            return pa.table({"q": join([q[x] for x, _, _ in found], np.int64), "hid": join([h[y] for _, y, _ in found], np.int64), "dist": join([d for _, _, d in found], float)})

        together, most = self._shape()
        goes = F.array_distinct(F.transform("blocks", lambda b: F.floor(b / together).cast("int"))) if together > 1 else F.col("blocks")
        sent = self.routed.select("q", "vec", "part", "reach", F.explode(goes).alias("block"))
        met = self._meet(sent, nearest, "q long, hid long, dist double", together, most)
        best = Window.partitionBy("q").orderBy("dist", "hid")
        ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= self.k)
        return self.members.join(ranked, "q").select("qid", "hid", "dist", "rank")


def nearest(queries: DataFrame, history: DataFrame, k: int, qid: str = "qid", hid: str = "hid", vec: str = "vec", part: str | None = None) -> DataFrame:
    """Exact k nearest history rows of every query row: (qid, hid, dist, rank).
    Up to ``SMALL_PAIRS`` pairs are measured block by block, since the index
    takes several jobs; both ways give the same rows."""
    queries, history = (df.where(F.col(vec).isNotNull()) for df in (queries, history))
    if queries.count() * history.count() <= SMALL_PAIRS:
        return knn_topk(queries, history, k, qid, hid, vec, part=part)
    return Search(queries, history, k, qid, hid, vec, part).neighbours()
