import numpy as np
import pytest

from quarry.llm import hashing, quantised
from quarry.llm.queries import QUERIES
from tests.llm.helpers import groups

NAN = float("nan")


def table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)


def cosine(v):
    n = np.sqrt((v * v).sum(1))
    return (v @ v.T) / np.outer(n, n)


def links_brute(ids, v, threshold):
    c = cosine(v) >= threshold
    np.fill_diagonal(c, False)
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), dtype=int)
    place[order] = np.arange(len(ids))
    of = groups(len(ids), [(place[a], place[b]) for a, b in zip(*np.nonzero(c))])
    comp = [int(ids[order[of[place[i]]]]) for i in range(len(ids))]
    return sorted((int(i), int(n), m, int(i) == m) for i, n, m in zip(ids, c.sum(1), comp))


def odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], None), (2, [2.0, 0.0], 2), (3, None, 3), (4, [0.0, 0.0], 1), (5, [NAN, 1.0], 1), (6, [1.0, None], 1),
            (7, [float("inf"), 1.0], 1), (8, [], 1), (9, [1.0, 0.0, 0.0], 1), (10, [0.99, 0.1], 1), (11, [-1.0, 0.0], 1), (12, [-0.0, 1.0], 1), (13, [0.0, 1.0], 1), (14, [1e-200, 0.0], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")


@pytest.mark.parametrize("tile_rows", [60, 8192])
def test_quantised_equals_brute_force(spark, tile_rows):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    v = np.concatenate([base[rng.integers(0, 40, 200)] + rng.normal(size=(200, 16)) * rng.choice([0, 0.2, 0.35, 0.6], size=(200, 1)), np.repeat(base[:1], 30, axis=0)])
    ids = rng.permutation(1000)[:len(v)]
    rows = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, quantised.near_duplicates(rows, 0.9, tile_rows=tile_rows).collect())) == links_brute(ids, v, 0.9)


def test_error_bounds_hold():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 24)) * np.exp(rng.normal(size=(300, 24)))
    q, scale, coded, error = quantised.quantise(v)
    assert q.dtype == np.int8
    product = (q.astype(int) @ q.T.astype(int)) * np.outer(scale, scale)
    assert (np.abs(cosine(v) - product) <= np.outer(coded, error) + error[:, None] + 1e-12).all()


def test_quantised_odd_vectors(spark):
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in quantised.near_duplicates(odd_vectors(spark)).collect()}
    alone = {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)}
    assert got == alone | {(1, 4, 1, True), (2, 4, 1, False), (10, 4, 1, False), (14, 4, 1, False), (12, 1, 12, True), (13, 1, 12, False)}
    assert quantised.near_duplicates(odd_vectors(spark).limit(0)).count() == 0


def test_quantised_query(spark, sf):
    ids, v = table(spark, sf)
    assert sorted(map(tuple, QUERIES["op3_quantised"](spark, sf).select("vec_id", "n_links", "component_id", "kept").collect())) == links_brute(ids, v, 0.9)


def test_multi_index_retrieves_the_whole_ball():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, size=(3000, 16)).astype("<u2")
    codes[::3] = codes[0]
    codes[1::3, :15] = codes[0, :15]
    index = hashing.MultiIndex(codes)
    for radius in (0, 1, 5, 15, 16, 17, 40, 100, 130, 256):
        for i in (0, 1, 2, 5):
            want = np.flatnonzero(hashing.distances(codes, codes[i]) <= radius)
            assert (index.within(codes[i], radius) == want).all()


def test_hashing_query_recall(spark, sf):
    ids, v = table(spark, sf)
    rows = QUERIES["op8_hashing"](spark, sf).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    c, hit, total = cosine(v), 0, 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = c[i].copy()
        score[i] = -9
        best = np.lexsort((ids, -score))[:5]
        mine = got[ids[i]]
        assert len(mine) == min(5, len(ids) - 1)
        assert [s for _, s in mine] == sorted((s for _, s in mine), reverse=True)
        assert all(abs(s - score[list(ids).index(x)]) < 1e-12 for x, s in mine)
        hit, total = hit + len({int(x) for x in ids[best]} & {x for x, _ in mine}), total + 5
    assert hit >= 0.9 * total


def test_hashing_is_exact_where_the_radius_covers_all(spark, monkeypatch):
    monkeypatch.setattr(hashing, "RADIUS_QUANTILE", 1.0)
    monkeypatch.setattr(hashing, "SHARD_ROWS", 9)
    monkeypatch.setattr(hashing, "QUERY_BLOCK", 2)
    rows = spark.createDataFrame([(i, [1.0, float(i // 3), 2.0]) for i in range(30)], "vec_id long, embedding array<double>")
    got = hashing.search(rows, rows.where("vec_id % 10 = 0"), 5).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in got[:2]] == [1, 2] and len(got) == 5
    assert got[0]["score"] == pytest.approx(1)


def test_hashing_odd_vectors(spark):
    rows = odd_vectors(spark)
    got = hashing.search(rows, rows, 5).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {3, 4, 5, 6, 7, 8, 9}.isdisjoint(by)  # no part, or no candidate of their size
    assert sorted(by[1])[:3] == [(1, 2), (2, 2), (3, 14)]
    assert all(len(x) == 5 for x in by.values())
    assert hashing.search(rows.limit(0), rows, 5).count() == 0
    assert hashing.search(rows, rows.limit(0), 5).count() == 0


def test_hashing_single_vectors(spark):
    """A size with one row, and a table of one vector, give no neighbours and no crash."""
    one = spark.createDataFrame([(50, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert hashing.search(one, one, 5).collect() == []
    two = one.union(spark.createDataFrame([(100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 2.0])], one.schema))
    assert [tuple(r)[:3] for r in hashing.search(two, two.where("vec_id % 50 = 0"), 5).collect()] == [(100, 1, 101)]


@pytest.mark.parametrize("factor", [1e200, 1e-200, 1e308, 1e-308])
def test_extreme_lengths(spark, factor):
    """Cosines neither overflow nor vanish."""
    plain = [(0, [0.9, 0.0]), (1, [0.9, 0.05]), (2, [0.0, 0.9]), (3, [0.9, 0.04])]
    rows = spark.createDataFrame([(i, [x * factor for x in v] if i % 2 else v) for i, v in plain], "vec_id long, embedding array<double>")
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in quantised.near_duplicates(rows).collect()}
    assert got == {(0, 2, 0), (1, 2, 0), (3, 2, 0), (2, 0, 2)}
    near = [(r["vec_id"], r["score"]) for r in hashing.search(rows, rows.where("vec_id = 0"), 3).orderBy("rank").collect()]
    assert [i for i, _ in near] == [3, 1, 2] and np.allclose([s for _, s in near], [0.9 / np.hypot(0.9, 0.04), 0.9 / np.hypot(0.9, 0.05), 0], atol=1e-12)
