"""Positions, split and folds on many partitions and wide rows."""

import pytest
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators.dedupe import row_position
from quarry.operators.features import split_key, stratified_folds, stratified_split
from quarry.sources.fixtures import raw_students

ROWS = 400_000


@pytest.fixture(params=["small partitions", "no adaptive plans"])
def conf(request, spark):
    wanted = ({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
              if request.param == "small partitions" else {"spark.sql.adaptive.enabled": "false"})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def wide(spark):
    """Distinct order keys in scattered order; one class holds a third."""
    row = F.col("id") * 7 % ROWS
    return spark.range(0, ROWS, 1, 16).select(
        row.alias("row_order"), F.when(row % 3 == 0, "a").when(row % 7 == 0, "b").otherwise("c").alias("label"),
        *[F.sha2((F.col("id") + i).cast("string"), 256).alias(f"payload{i}") for i in range(4)])


def test_row_position(spark, conf):
    rows = row_position(wide(spark), "row_order")
    assert rows.agg(F.count("*"), F.count_if(F.col("position") == F.col("row_order")), F.max("payload3")).first()[:2] == (ROWS, ROWS)


def test_row_position_in_groups(spark, conf):
    rows = row_position(wide(spark), "row_order", group_col="label").select("row_order", "label", "position", "payload0")
    right = {"a": F.col("row_order") / 3, "b": F.floor(F.col("row_order") / 7) - F.floor(F.col("row_order") / 21) - 1}
    found = rows.groupBy("label").agg(
        F.count("*").alias("n"), F.count_distinct("position").alias("d"), F.max("position").alias("top"),
        F.count_if(F.col("position") == F.when(F.col("label") == "a", right["a"]).when(F.col("label") == "b", right["b"])).alias("right")).collect()
    assert sum(r["n"] for r in found) == ROWS
    assert all(r["d"] == r["n"] == r["top"] + 1 for r in found)
    assert all(r["right"] == r["n"] for r in found if r["label"] != "c")


def test_split_keeps_every_row_and_the_shares(spark, conf):
    out = stratified_split(wide(spark), "label")
    found = {r["label"]: r for r in out.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("test"), F.max(F.when(F.col("is_test"), split_key())).alias("top"),
        F.min(F.when(~F.col("is_test"), split_key())).alias("low"), F.max("payload2").alias("p")).collect()}
    assert sum(r["n"] for r in found.values()) == ROWS
    assert all(r["test"] == (r["n"] * 2 + 5) // 10 and r["top"] <= r["low"] for r in found.values())


def test_folds_keep_every_row_and_follow_first_appearance(spark, conf):
    out = stratified_folds(wide(spark), "label").groupBy("label", "fold").agg(F.count("*").alias("n"), F.min("row_order").alias("lo"), F.max("row_order").alias("hi")).collect()
    assert sum(r["n"] for r in out) == ROWS
    size = {}
    for r in out:
        size[r["label"]] = size.get(r["label"], 0) + r["n"]
    start, want = 0, {}
    for label in ("a", "c", "b"):   # order of first appearance: rows 0, 1, 7
        for p in range(start, start + size[label]):
            want[label, p % 5] = want.get((label, p % 5), 0) + 1
        start += size[label]
    assert {(r["label"], r["fold"]): r["n"] for r in out} == want
    for label in size:
        spans = sorted((r["fold"], r["lo"], r["hi"]) for r in out if r["label"] == label)
        assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_long_customer_keys_stay_apart(spark, tmp_path):
    keys = [12, 9_999_999, 10_000_001, 10_000_002, 100_000_001, 100_000_033, 123_456_789]
    spark.createDataFrame([(k, 10.5 + k % 7, "BUILDING") for k in keys], "c_custkey long, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    rows = raw_students(spark, str(tmp_path))
    digits = F.regexp_extract("student_id", "([0-9]+)", 1).cast("long")
    assert sorted(r[0] for r in rows.select(digits).distinct().collect()) == keys
    assert rows.groupBy("row_order").agg(F.count_distinct("gpa").alias("n")).where("n > 1").count() == 0


def test_a_cluster_without_shared_folder_is_an_error():
    from quarry.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
