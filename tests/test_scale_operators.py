"""Selection, sketches, prefix lookup, level-wise rules, basket matrix, numbered scans, the exact split rule and the approximate search."""

import itertools
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators import evaluate as EV
from quarry.operators import rules as R
from quarry.operators.dedupe import keep_first
from quarry.operators.lookup import prefix_lookup
from quarry.operators.lsh import approx_nearest, recall
from quarry.operators.metric import nearest
from quarry.operators.selection import exact_medians, values_at
from quarry.operators.sketches import distinct_sketches, estimates, merge_sketches
from quarry.sources.csv_text import MissingInputError, read_numbered_csv, read_text_csv, write_text_csv


# -- selection ----------------------------------------------------------------------
def test_median_of_a_million_distinct_values(spark):
    df = spark.range(1_000_001).select((F.pow(F.col("id"), 3) * 1e-3 - 7).alias("x"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("even"))
    got = values_at(df, {"x": [0.0, 0.5, 1.0], "even": [0.25]})
    assert got["x"] == [-7.0, 500_000.0**3 * 1e-3 - 7, 1e6**3 * 1e-3 - 7] and got["even"] == [250_000.0]


def test_medians_equal_sorted_values(spark):
    rnd = random.Random(2)
    big = float("inf")
    columns = {"few": [rnd.choice([1.0, 2.0, None]) for _ in range(300)], "wide": [rnd.choice([1e308, -1e308, 5e-324, 0.0, rnd.random()]) for _ in range(300)],
               "ends": [rnd.choice([big, -big, 3.0]) for _ in range(300)], "one": [None] * 299 + [4.5], "none": [None] * 300,
               "odd": [float(i * i) for i in range(299)] + [None], "even": [float(2**(i % 60)) for i in range(300)]}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(6)
    got = exact_medians(df, list(columns)).first().asDict()
    for c, values in columns.items():
        held = [v for v in values if v is not None]
        assert got[c] == (statistics.median(held) if held else None), c
    assert exact_medians(df.limit(0), ["few"]).first()[0] is None


# -- sketches -----------------------------------------------------------------------
def test_sketches_merge(spark):
    a = spark.range(60_000).select((F.col("id") % 5).alias("g"), (F.col("id") * 7).alias("n"), F.concat(F.lit("s"), F.col("id") % 900).alias("t"))
    b = spark.range(30_000, 90_000).select((F.col("id") % 5).alias("g"), (F.col("id") * 7).cast("long").alias("n"), F.lit(None).cast("string").alias("t"))
    kept = [distinct_sketches(x, ["n", "t"], ["g"]) for x in (a, b)]
    per = {r["g"]: r for r in estimates(merge_sketches(kept, ["n", "t"], ["g"]), ["n", "t"]).collect()}
    assert len(per) == 5 and all(abs(r["n"] - 18_000) <= 0.03 * 18_000 and abs(r["t"] - 180) <= 6 for r in per.values())
    whole = estimates(merge_sketches(kept, ["n", "t"]), ["n", "t"]).first()
    assert abs(whole["n"] - 90_000) <= 0.03 * 90_000 and abs(whole["t"] - 900) <= 27
    assert estimates(distinct_sketches(b, ["t"]), ["t"]).first()["t"] == 0


# -- prefix lookup --------------------------------------------------------------------
def brute_lookup(key, entries, head=6):
    return None if key is None else next((c for _, v, c in sorted(entries) if key.startswith(v) or v.startswith(key[:head])), None)


def test_prefix_lookup_small(spark):
    entries = [(0, "ai", "A"), (1, "aim", "B"), (2, "web dev", "C"), (3, "webdesign", "D"), (4, "x", "E")]
    keys = ["aimless", "ai", "a", "", None, "web de", "web", "webde", "webdes", "xyz", "y", "ai", "websters"]
    got = prefix_lookup(spark.createDataFrame(list(enumerate(keys)), "i int, key string"), spark.createDataFrame(entries, "priority int, variant string, canonical string"))
    assert {(r["i"], r["canonical"]) for r in got.collect()} == {(i, brute_lookup(k, entries)) for i, k in enumerate(keys)}


def test_prefix_lookup_in_a_large_dictionary(spark):
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    entries = [(i, word(rnd.randint(4, 12)), f"v{i}") for i in range(100_000)]
    rnd.shuffle(entries)
    keys = [word(rnd.randint(0, 14)) for _ in range(150)] + [rnd.choice(entries)[1][:rnd.randint(3, 12)] + "zz" for _ in range(50)]
    got = prefix_lookup(spark.createDataFrame(list(enumerate(keys)), "i int, key string"), spark.createDataFrame(entries, "priority int, variant string, canonical string"))
    ordered = sorted(entries)
    want = {i: next((c for _, v, c in ordered if k.startswith(v) or v.startswith(k[:6])), None) for i, k in enumerate(keys)}
    assert {r["i"]: r["canonical"] for r in got.collect()} == want


# -- rules ------------------------------------------------------------------------------
def brute_rules(itemsets, n, confidence):
    freq = {tuple(s): f for s, f in itemsets}
    out = set()
    for s, f in itemsets:
        for k in range(1, len(s)):
            for c in itertools.combinations(s, k):
                a = tuple(x for x in s if x not in c)
                if f / n / (freq[a] / n) >= confidence:
                    out.add((a, c, round(f / n, 9), round(f / freq[a], 9)))
    return out


def test_rules_of_long_baskets(spark):
    """Baskets of 40 items, itemsets of up to nine, all splits checked."""
    rnd = random.Random(6)
    core = [f"c{i}" for i in range(9)]
    baskets = [(i, sorted({*(core if rnd.random() < 0.7 else rnd.sample(core, 6)), *(f"n{rnd.randrange(3000)}" for _ in range(60))})[:40]) for i in range(300)]
    df = spark.createDataFrame(baskets, "student_id int, items array<string>")
    its = R.frequent_itemsets(df, 0.5)
    listed = [(tuple(r["items"]), r["freq"]) for r in its.collect()]
    assert max(len(s) for s, _ in listed) == 9
    got = {(tuple(r["antecedents"]), tuple(r["consequents"]), round(r["support"], 9), round(r["confidence"], 9)) for r in R.association_rules(its, 300, 0.9).collect()}
    assert got == brute_rules(listed, 300, 0.9)


def test_one_long_itemset_with_few_rules(spark):
    """An itemset of 40 items whose splits could never be listed: only rules whose sides are known and confident are grown."""
    items = [f"i{k:02d}" for k in range(40)]
    rows = [(items, 10, 0.1, 40)] + [([x], 10 if x == "i00" else 90, 0.1, 1) for x in items] + [([y for y in items if y != x], 10 if x == "i07" else 100, 0.1, 39) for x in items]
    its = spark.createDataFrame(rows, "items array<string>, freq long, support double, length int").where("length = 40 or length = 39 and freq = 10 or length = 1")
    got = R.association_rules(its, 100, 0.95).collect()
    assert [(len(r["antecedents"]), r["consequents"]) for r in got if len(r["antecedents"]) == 39] == [(39, ["i07"])]


def test_itemsets_counted_by_levels(spark):
    """Against a plain count: null items, null and empty baskets (of n), several counting tasks, no item, no basket."""
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([f"{c}{v}" for v in range(3)]) for c in "abcde"] + ([None] if i % 3 else [])) for i in range(700)] + [(700, []), *((i, None) for i in range(701, 900))]
    df = spark.createDataFrame(rows, "student_id int, items array<string>").repartition(5)
    want: dict[tuple, int] = {}
    for _, items in rows:
        named = sorted(items or [], key=lambda x: (x is None, x or ""))
        for size in range(1, len(named) + 1):
            for s in itertools.combinations(named, size):
                want[s] = want.get(s, 0) + 1
    got = R.frequent_itemsets(df, 0.02).collect()
    assert {tuple(r["items"]): r["freq"] for r in got} == {s: n for s, n in want.items() if n / 900 >= 0.02}
    assert len(got) == len({tuple(r["items"]) for r in got}) and all(r["length"] == len(r["items"]) and r["support"] == r["freq"] / 900 for r in got)
    assert R.frequent_itemsets(df, 0.9).count() == 0 and R.frequent_itemsets(df.limit(0), 0.1).count() == 0
    with pytest.raises(Exception, match="unique"):
        R.frequent_itemsets(spark.createDataFrame([(1, ["a", "a"])], "student_id int, items array<string>"), 0.5).count()


def test_basket_matrix_and_vectors(spark):
    baskets = [(1, ["a", "b"]), (2, ["c"]), (3, []), (4, None), (5, ["b", "zz"]), (6, ["b", "b"])]
    df = spark.createDataFrame(baskets, "student_id int, items array<string>")
    items = R.vocabulary(R.basket_long(df).where("item <> 'zz'"))
    assert items == ["a", "b", "c"]
    wide = R.basket_matrix(df, items)
    assert [tuple(r) for r in wide.orderBy("student_id").collect()] == [(1, True, True, False), (2, False, False, True), (3, False, False, False), (4, False, False, False), (5, False, True, False), (6, False, True, False)]
    want = {(i, x) for i, s in baskets for x in s or [] if x in items}
    assert {tuple(r) for r in R.matrix_baskets(wide, items).collect()} == want
    vectors = R.basket_vectors(df, items)
    assert {tuple(r) for r in R.vector_baskets(vectors, items).collect()} == want and vectors.count() == 6
    with pytest.raises(ValueError):
        R.basket_matrix(df, [str(i) for i in range(R.WIDE_ITEMS + 1)])


def test_matrix_round_trip_of_the_students(spark, sf):
    from quarry.functions.bands import basket_items
    from quarry.plans.derived import bk
    baskets = bk(spark, sf)
    back = R.matrix_baskets(R.basket_matrix(baskets, basket_items()), basket_items())
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, R.basket_long(baskets).collect()))


# -- numbered scans ---------------------------------------------------------------------
def test_rows_are_numbered_as_they_stand(spark, tmp_path):
    """Several files cut into small blocks, read with any dealing of blocks to tasks."""
    rows = [(f"id{i % 400}", f"text {i} " + "x" * (i % 90)) for i in range(3000)]
    folder = tmp_path / "csv"
    folder.mkdir()
    for k in (2, 0, 1):  # written out of order
        part = rows[k * 1000:(k + 1) * 1000]
        (folder / f"part-{k}.csv").write_text("id,value\n" + "".join(f"{a},{b}\n" for a, b in part))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for bytes_ in ("4k", "64k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
            got = read_numbered_csv(spark, str(folder))
            assert [(r["id"], r["value"]) for r in got.orderBy("row_order").collect()] == rows
            assert [r[0] for r in got.select("row_order").orderBy("row_order").collect()] == list(range(3000))
            kept = keep_first(got, "id")  # keep-first by the place in the files
            assert {(r["id"], r["value"]) for r in kept.collect()} == set(rows[:400])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_cleaning_does_not_depend_on_the_order_of_files(spark, sf, tmp_path):
    """The raw students written as files in another order of writing are cleaned to the same table."""
    from quarry.plans.clean import clean_students
    from quarry.plans.derived import sr
    raw = sr(spark, sf)
    cells = [c for c in raw.columns if c != "row_order"]
    out = []
    for k, parts in enumerate((1, 5)):
        path = str(tmp_path / f"sr{k}")
        write_text_csv(raw.repartitionByRange(parts, "row_order").sortWithinPartitions("row_order").select(*cells), path)
        numbered = read_numbered_csv(spark, path)
        out.append(sorted(map(str, clean_students(numbered.repartition(3 + k)).drop("row_order").collect())))
    assert out[0] == out[1] and len(out[0]) > 100


def test_a_missing_file_and_other_errors(spark, tmp_path):
    for read in (read_text_csv, read_numbered_csv):
        with pytest.raises(MissingInputError):
            read(spark, str(tmp_path / "nothing"))
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError):
        read_numbered_csv(spark, str(tmp_path / "a.csv"), ["z"])


# -- the exact split rule -----------------------------------------------------------------
def test_no_node_of_fewer_than_eight_rows_is_split(spark, sf):
    from quarry.plans.q_ml import split_students
    rows = split_students(spark, sf).filter(~F.col("is_test"))
    free = EV.tree_pipeline("decision_tree").fit(rows).stages[-1]
    cut = EV.fit_rows(rows, "decision_tree").stages[-1]
    nodes = {n["id"]: n for n in EV.tree_nodes(cut)}
    assert sorted(nodes) == list(range(len(nodes)))
    inner = [n for n in nodes.values() if n["leftChild"] >= 0]
    assert inner and all(n["rawCount"] >= C.DT_MIN_SAMPLES_SPLIT for n in inner)
    assert any(nodes[c]["rawCount"] < C.DT_MIN_SAMPLES_SPLIT // 2 for n in inner for c in (n["leftChild"], n["rightChild"]))  # the old bound forbade these
    whole = {n["id"]: n for n in EV.tree_nodes(free)}

    def same(a, b):
        """Node by node: the free tree, stopped at nodes of fewer rows."""
        x, y = whole[a], nodes[b]
        assert (x["rawCount"], x["prediction"], x["impurityStats"]) == (y["rawCount"], y["prediction"], y["impurityStats"])
        if x["leftChild"] < 0 or x["rawCount"] < C.DT_MIN_SAMPLES_SPLIT:
            assert y["leftChild"] == y["rightChild"] == -1
        else:
            assert x["split"] == y["split"]
            same(x["leftChild"], y["leftChild"])
            same(x["rightChild"], y["rightChild"])
    same(0, 0)


# -- approximate search ---------------------------------------------------------------------
def test_approximate_search_recall_and_fallback(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("qid"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = emb.withColumnRenamed("qid", "hid")
    exact = nearest(emb, rows, 5)
    found = approx_nearest(emb, rows, 5)
    assert recall(found, exact).first()["recall"] >= 0.9
    assert found.groupBy("qid").count().where("count = 5").count() == emb.count()
    tight = approx_nearest(emb, rows, 5, length=1e-6)  # nothing shares a key: all by the fallback
    assert recall(tight, exact).first()["recall"] == 1.0
    assert approx_nearest(emb, rows.limit(0), 5).count() == 0 and approx_nearest(emb.limit(0), rows, 5).count() == 0
    blocks = approx_nearest(emb, rows, 5, block=16)
    assert np.isclose(recall(blocks, exact).first()["recall"], recall(found, exact).first()["recall"])


def test_rules_are_matched_without_pairs(spark):
    """Each profile meets the rules as one list: nothing is exploded by item or shuffled."""
    from quarry.operators.rules import match_rules
    rng = np.random.default_rng(8)
    items = [f"i{x}" for x in range(12)]
    rules = [(r + 1, sorted(rng.choice(items, size=rng.integers(1, 4), replace=False).tolist()), ["Track_A" if r % 4 else "Other"], 0.5) for r in range(60)]
    rules.append((61, [], ["Track_B"], 0.5))   # no rule without antecedents
    profiles = [(f"s{i}", rng.choice(items, size=6).tolist()) for i in range(80)] + [("none", []), ("null", None), ("some", [None, "i1", "i2", "i3"])]
    p = spark.createDataFrame(profiles, "student_id string, items array<string>")
    r = spark.createDataFrame(rules, "rule_rank int, antecedents array<string>, consequents array<string>, confidence double")
    want = {i: [k for k, a, c, _ in rules if a and c[0] != "Other" and set(a) <= set(x or [])] for i, x in profiles}
    got = match_rules(p, r)
    assert sorted((x["student_id"], x["rule_rank"]) for x in got.collect()) == sorted((i, k) for i, ks in want.items() for k in ks)
    few = match_rules(p, r, per_profile=2)
    assert sorted((x["student_id"], x["rule_rank"]) for x in few.collect()) == sorted((i, k) for i, ks in want.items() for k in ks[:2])
    assert set(got.columns) == {"student_id", *r.columns}
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 1   # the list of rules alone
