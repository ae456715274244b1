"""Approximate nearest neighbours by bucketed random projections, with an exact
fallback.

MLlib's ``BucketedRandomProjectionLSH`` gives each vector a bucket number per
projection; ``GROUP`` projections together make a key, and rows that share one of
``TABLES`` keys are candidates.  The bucket length follows the distance at which
sample rows have their k-th neighbour.  Candidates are measured exactly, key by
key, never listed as pairs: a key's rows and queries are dealt into parts of
bounded size.  Queries with fewer than k candidates are searched exactly by the metric
index.  Recall is a matter of the data: measure it with ``recall``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.metric import BLOCK, HELD, MOST_BLOCKS, SAMPLE_ROWS, Rows, Search, _matrix, distances, ranked
from quarry.session import hand_off

TABLES, GROUP = 8, 3
#: Bucket length in k-th distances of the sample.
REACH = 4.0
#: Rows of a key from which they are measured by one product.
WORTH = 256
#: Up to so many keys with several parts are broadcast.
BROADCAST_KEYS = 100_000


def bucket_length(sample: np.ndarray, k: int) -> float:
    """REACH times the k-th distance that most sample rows have inside the sample."""
    if len(sample) < 2:
        return 1.0
    d = distances(sample[:512], sample)
    kth = np.partition(d, min(k, len(sample) - 1), axis=1)[:, min(k, len(sample) - 1)]
    return float(max(np.quantile(kth, 0.9) * REACH, 1e-9))


def _nearest(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
        if queries.num_rows and rows.num_rows:
            q, h = _matrix(queries.column("vec")), _matrix(rows.column("vec"))
            qid, hid, key_q, key_h = (t.column(c).to_numpy() for t, c in ((queries, "qid"), (rows, "hid"), (queries, "key"), (rows, "key")))
            order_q, order_h = np.argsort(key_q, kind="stable"), np.argsort(key_h, kind="stable")
            for key in np.intersect1d(key_q, key_h):
                mine, asked = (order[np.searchsorted(keys[order], key):np.searchsorted(keys[order], key, "right")] for order, keys in ((order_h, key_h), (order_q, key_q)))
                if len(mine) >= WORTH:
                    row, at = Rows(h[mine]).near(q[asked], k)
                    row, at, exact = ranked(q[asked], h[mine], hid[mine], row, at, k)
                    out.append((qid[asked[row]], hid[mine[at]], exact))
                    continue
                for lo in range(0, len(asked), 512):
                    x = asked[lo:lo + 512]
                    rough, kk = distances(q[x], h[mine]), min(k, len(mine))
                    near = np.argpartition(rough, kk - 1, axis=1)[:, :kk]
                    exact = np.sqrt(((h[mine[near]] - q[x][:, None, :]) ** 2).sum(2))
                    out.append((np.repeat(qid[x], kk), hid[mine[near]].ravel(), exact.ravel()))
        return pa.table(dict(zip(("qid", "hid", "dist"), (np.concatenate(c) for c in zip(*out)))))
    return run


def approx_nearest(queries: DataFrame, history: DataFrame, k: int, qid: str = "qid", hid: str = "hid", vec: str = "vec",
                   tables: int = TABLES, group: int = GROUP, length: float | None = None, block: int = BLOCK, seed: int = 11) -> DataFrame:
    """About the k nearest history rows of every query row: (qid, hid, dist,
    rank); distances are exact, ties go to the smaller id."""
    shape = lambda df, name, to: df.select(F.col(name).cast("long").alias(to), F.col(vec).cast("array<double>").alias("vec")).where("vec is not null")
    asked = shape(queries, qid, "qid")
    least = Window.partitionBy("vec").orderBy("hid")  # of equal vectors the k smallest ids can be neighbours
    held = hand_off(shape(history, hid, "hid").withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= k).drop("_n"), "lsh-history")
    sample = _matrix(held.orderBy(F.xxhash64("hid"), "hid").select("vec").limit(SAMPLE_ROWS).toArrow().column("vec"))
    if not len(sample):
        return Search(asked, held, k).neighbours()
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=length or bucket_length(sample, k), numHashTables=tables * group, seed=seed)
    model = lsh.fit(held.limit(1).select(array_to_vector("vec").alias("features")))  # it only looks at the size

    def keyed(df: DataFrame) -> DataFrame:
        hashes = model.transform(df.withColumn("features", array_to_vector("vec"))).drop("features")
        numbers = F.array(*[F.element_at(vector_to_array(F.col("hashes")[i]), 1).cast("long") for i in range(tables * group)])
        hashes = hashes.withColumn("numbers", numbers).drop("hashes")
        keys = F.array(*[F.xxhash64(F.lit(t), *[F.col("numbers")[t * group + j] for j in range(group)]) for t in range(tables)])
        return hashes.select("*", F.explode(F.array_distinct(keys)).alias("key")).drop("numbers")

    left, right = hand_off(keyed(asked), "lsh-queries"), hand_off(keyed(held), "lsh-rows")
    counts = hand_off(right.groupBy("key").agg(F.count("*").alias("rows")).join(left.groupBy("key").agg(F.count("*").alias("queries")), "key"), "lsh-parts")
    # a large key's parts travel once for each part they meet: longer ones where all cores have some
    met = counts.agg(F.sum(F.ceil(F.col("rows") / block) * F.ceil(F.col("queries") / block))).first()[0] or 0
    longer = int(np.sqrt(met / (4 * held.sparkSession.sparkContext.defaultParallelism)))
    most = block * max(1, min(MOST_BLOCKS, HELD // (block * sample.shape[1] or 1), longer))
    parts = counts.select("key", F.ceil(F.col("rows") / most).cast("int").alias("row_parts"), F.ceil(F.col("queries") / most).cast("int").alias("query_parts"))
    several = parts.where("row_parts > 1 or query_parts > 1")
    side = F.broadcast(several) if several.count() <= BROADCAST_KEYS else several
    n = right.count()
    shards = max(1, -(-n // block))
    one = F.lit(1)
    shard = F.when(F.col("row_parts").isNull(), F.pmod(F.col("key"), F.lit(shards))).otherwise(F.col("key")).alias("shard")

    def dealt(df: DataFrame, own: str, other: str, name: str) -> DataFrame:
        mine, theirs = F.coalesce(own, one), F.coalesce(other, one)
        out = df.join(side, "key", "left").select("*", shard, F.pmod(F.xxhash64(name), mine).cast("int").alias(own[0] + "_part"), F.explode(F.sequence(F.lit(0), theirs - 1)).alias(other[0] + "_part"))
        return out.drop("row_parts", "query_parts")

    cells = ["shard", "r_part", "q_part"]
    met = (dealt(left, "query_parts", "row_parts", "qid").groupBy(*cells).cogroup(dealt(right, "row_parts", "query_parts", "hid").groupBy(*cells))
           .applyInArrow(_nearest(k), "qid long, hid long, dist double"))
    best = Window.partitionBy("qid").orderBy("dist", "hid")
    found = hand_off(met.groupBy("qid", "hid").agg(F.min("dist").alias("dist")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "lsh-found")
    rows = min(k, n)
    full = found.groupBy("qid").agg(F.count("*").alias("n")).where(F.col("n") >= rows).select("qid")
    short = hand_off(asked.join(full, "qid", "left_anti"), "lsh-short")
    return found.join(full, "qid", "left_semi").unionByName(Search(short, held, k).neighbours()) if not short.isEmpty() else found


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours asked for, found among them, and the share."""
    hits = exact.select("qid", "hid").join(found.select("qid", "hid", F.lit(1).alias("hit")), ["qid", "hid"], "left")
    return hits.agg(F.count("*").alias("neighbours"), F.coalesce(F.sum("hit"), F.lit(0)).alias("found")).withColumn("recall", F.col("found") / F.col("neighbours"))
