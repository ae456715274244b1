"""The metric index against exhaustive search, on clustered, repeated and odd vectors."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import metric
from quarry.operators.metric import Index, Search, distances, fit_pivots

SCHEMA = "id long, vec array<double>, part int"


def brute(queries, history, k):
    out = set()
    for q, v, p in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), h) for h, w, ph in history if p == ph and w is not None)
        out |= {(q, h, r) for r, (_, h) in enumerate(near[:k], 1)}
    return out


def found(spark, queries, history, k, **more):
    q, h = spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(history, SCHEMA)
    s = Search(q.withColumnRenamed("id", "qid"), h.withColumnRenamed("id", "hid"), k, part="part", **more)
    return s, {(r.qid, r.hid, r["rank"]) for r in s.neighbours().collect()}


def clustered(n, rng, dims=6, clusters=8, part=0, first=0):
    centre = rng.normal(size=(clusters, dims)) * 20
    return [(first + i, [float(x) for x in centre[i % clusters] + rng.normal(size=dims)], part) for i in range(n)]


@pytest.mark.parametrize("block", [4096, 16])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = clustered(400, rng) + [(1000 + i, [1.0] * 6, 0) for i in range(150)] + [(2000 + i, [float(i % 5)] * 6, 0) for i in range(60)]
    rows += clustered(50, rng, part=1, first=5000) + [(9000, [1e6] * 6, 1), (9001, None, 0)]
    queries = [r for r in rows if r[1] is not None]
    s, got = found(spark, queries, rows, 5, block=block, pivots=20)
    assert got == brute(queries, rows, 5)
    seen = s.visits().agg(F.sum("measured"), F.count("*")).first()
    assert seen[0] < 0.3 * seen[1] * s.rows  # far from all against all
    assert seen[1] == len({(tuple(v), p) for _, v, p in queries})


def test_fewer_rows_than_k_and_empty_tables(spark):
    rows = [(1, [0.0, 0.0], 0), (2, [0.0, 3.0], 0), (3, [0.0, 0.0], 0)]
    _, got = found(spark, rows, rows, 9)
    assert got == brute(rows, rows, 9)
    _, got = found(spark, rows, [], 2)
    assert got == set()
    _, got = found(spark, [], rows, 2)
    assert got == set()
    _, got = found(spark, [(1, [0.0, 0.0], 7)], rows, 2)  # a part without history
    assert got == set()


def test_bounds_hold():
    """No row lies nearer than its cell's bound, and the first reach holds k rows."""
    rng = np.random.default_rng(9)
    rows, queries = rng.normal(size=(500, 4)).round(1), rng.normal(size=(80, 4)).round(1)
    pivots = fit_pivots(rows, 30)
    d = distances(rows, pivots)
    cell = d.argmin(1)
    own = d[np.arange(500), cell]
    index = Index(pivots, [(0, int(c), int((cell == c).sum()), float(own[cell == c].min()), float(own[cell == c].max())) for c in np.unique(cell)], 7, 64)
    low, to_pivot = index.bounds(0, queries)
    reach = index.first_reach(0, to_pivot)
    for i, q in enumerate(queries):
        true = np.sqrt(((rows - q) ** 2).sum(1))
        for j, c in enumerate(index.cells[0]["cell"]):
            assert true[cell == c].min() >= low[i, j]
        assert (true <= reach[i]).sum() >= 7


def test_repeated_queries_share_one_search(spark, monkeypatch):
    rows = [(i, [float(i % 3), 0.0], 0) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    for small in (0, 1 << 28):  # through the index, or block by block
        monkeypatch.setattr(metric, "SMALL_PAIRS", small)
        out = metric.nearest(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "hid"), 4)
        assert {(r.qid, r.hid, r["rank"]) for r in out.collect()} == brute(rows, rows, 4)


def test_boxes_prune_steps_and_flags(spark):
    """No row within reach lies in a cell that isn't visited, and boxes leave
    out most cells that balls don't."""
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 8, size=(3000, 5))
    rows = np.concatenate([grades / 2.0, (grades > 3) * 2.0, np.eye(4)[rng.integers(0, 4, 3000)]], axis=1)
    pivots = fit_pivots(rows, 80)
    d = distances(rows, pivots)
    cell = d.argmin(1)
    own = d[np.arange(3000), cell]
    balls = [(0, int(c), int((cell == c).sum()), float(own[cell == c].min()), float(own[cell == c].max())) for c in np.unique(cell)]
    boxed = [(*s, rows[cell == s[1]].min(0).tolist(), rows[cell == s[1]].max(0).tolist()) for s in balls]
    q = rows[:200] + rng.normal(size=(200, rows.shape[1])) * 0.01
    true = distances(q, rows)
    reach = np.sort(true, axis=1)[:, 4]
    plain, index = Index(pivots, balls, 5, 64), Index(pivots, boxed, 5, 64)
    wide, near = plain.visits(0, q, reach), index.visits(0, q, reach)
    for j, c in enumerate(index.cells[0]["cell"]):
        assert ((true[:, cell == c].min(1) <= reach) <= near[:, j]).all()
    assert near.sum() < 0.4 * wide.sum() and not (near & ~wide).any()
    some = np.array([3, 1])
    assert (index.visits(0, q, reach, some) == near[:, some]).all()
    s, got = found(spark, [(i, v.tolist(), 0) for i, v in enumerate(q[:60])], [(i, v.tolist(), 0) for i, v in enumerate(rows)], 5, pivots=80)
    assert got == brute([(i, v.tolist(), 0) for i, v in enumerate(q[:60])], [(i, v.tolist(), 0) for i, v in enumerate(rows)], 5)


def test_batches_are_cut_for_the_pivots():
    """Of Arrow's batches of 10,000 rows by all pivots no task makes one matrix."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000))], names=["q"])
    parts = list(metric.short(iter([batch, batch.slice(0, 0), batch.slice(5, 1)])))
    assert max(b.num_rows for b in parts) <= metric.ASSIGNED and sum(b.num_rows for b in parts) == 10_001
    assert [x for b in parts for x in b.column(0).to_pylist()] == [*range(10_000), 5]


def test_dense_blocks_and_ties_against_brute_force(spark):
    """Vectors that no bound prunes, each several times or mirrored: every rank and tie as by brute force, through several blocks."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 24))
    x = np.concatenate([x, -x, x[:90], x[:40], rng.integers(0, 2, size=(200, 24))]).astype(float)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    search = Search(table.withColumnRenamed("id", "qid"), table.withColumnRenamed("id", "hid"), 6, block=64, pivots=9)
    got = {(r["qid"], r["rank"]): (r["hid"], r["dist"]) for r in search.neighbours().collect()}
    assert len(got) == 6 * len(x)
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        for rank, j in enumerate(np.lexsort((np.arange(len(x)), np.round(d, 12)))[:6], 1):
            hid, dist = got[i, rank]
            assert abs(dist - d[j]) < 1e-9 and (hid == j or abs(d[hid] - d[j]) < 1e-9)


@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1.0, 1e6), (1e-14, 0.0), (1e100, 0.0), (30.0, -5.0)])
def test_one_product_tells_near_rows(scale, offset):
    """Single precision leaves out no neighbour and keeps few rows besides."""
    from quarry.operators import metric as ME
    rng = np.random.default_rng(4)
    h = rng.normal(size=(ME.COLUMNS + 3000, 12)) * scale + offset
    h[40:60] = h[3]                                   # ties
    q = np.concatenate([h[:30], rng.normal(size=(60, 12)) * scale + offset])
    row, at = ME.Rows(h).near(q, 5)
    assert scale < 1e-10 or len(row) < len(q) * 200   # not a share of the rows
    r, a, d = ME.ranked(q, h, np.arange(len(h)), row, at, 5)
    with np.errstate(over="ignore"):
        whole = np.sqrt((((h[None] - q[:, None]) / scale) ** 2).sum(2))
    for i in range(len(q)):
        want = np.lexsort((np.arange(len(h)), whole[i]))[:5]
        assert np.allclose(whole[i][a[r == i]], whole[i][want], rtol=1e-9, atol=1e-9)
    assert a[r == 3].tolist() == [3, 40, 41, 42, 43]


def test_rows_that_are_no_numbers_are_left_out():
    from quarry.operators.metric import Rows
    h = np.arange(900.0).reshape(300, 3)
    h[7] = np.nan
    row, at = Rows(h).near(h[:10] + 0.25, 4)
    assert 7 not in at and all((row == i).sum() >= 4 for i in range(10) if i != 7)


def test_blocks_read_together_change_nothing(spark, monkeypatch):
    """Where queries go to most blocks, several are read together."""
    from quarry.operators import metric as ME
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate((rng.normal(size=(1500, 24)) * 2).round() / 2)]   # sums without rounding
    v = spark.createDataFrame(rows, "id long, vec array<double>")
    search = ME.Search(v.withColumnRenamed("id", "qid"), v.withColumnRenamed("id", "hid"), 4, block=16)
    together, most = search._shape()
    assert together == ME.MOST_BLOCKS and 16 <= most <= 16 * together
    got = sorted((r["qid"], r["rank"], r["hid"], round(r["dist"], 9)) for r in search.neighbours().collect())
    monkeypatch.setattr(ME, "MOST_BLOCKS", 1)
    alone = sorted((r["qid"], r["rank"], r["hid"], round(r["dist"], 9)) for r in search.neighbours().collect())
    x = np.array([r[1] for r in rows])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = [(i, k + 1, int(j), round(float(d[i, j]), 9)) for i in range(len(x)) for k, j in enumerate(np.lexsort((np.arange(len(x)), d[i]))[:4])]
    assert got == alone == want


def test_only_repeated_vectors_are_ranked(spark, monkeypatch):
    from quarry.operators import metric as ME
    written, keep = [], ME.hand_off
    monkeypatch.setattr(ME, "hand_off", lambda df, name: (written.append(df._jdf.queryExecution().optimizedPlan().toString()), keep(df, name))[1])
    _few_equal = ME._few_equal
    schema = "hid long, vec array<double>, part int"
    apart = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(50)] + [(100 + i, [7.0, 7.0], i) for i in range(3)], schema)
    assert _few_equal(apart, 2).count() == 53 and not any("Window" in p for p in written)
    equal = apart.unionByName(spark.createDataFrame([(900 - i, [3.5, 0.0], 1) for i in range(9)], schema))
    got = sorted(r["hid"] for r in _few_equal(equal, 2).collect())
    assert sum("Window" in p for p in written) == 1
    assert got == [*range(50), 100, 101, 102, 892, 893]
