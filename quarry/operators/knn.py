"""Exact k-nearest-neighbour search between two DataFrames.

Exact kNN needs every query/history distance, so the work is |Q| x |H|; the
plan keeps it bounded per task and never materialises the pairs as rows:

* Both sides are cut into blocks of at most ``block_rows`` rows (hash of the
  id).  Each query block is paired with each history block by tagging rows
  with the partner block numbers and co-grouping on the (query block,
  history block) cell -- an equi-cogroup, not a cross join.  When the query
  side is small it is one block, copied to every history block (the
  broadcast case); the history side is then split into at least
  ``parallelism`` blocks so all cores work.
* Inside a cell (Arrow batches -> numpy) squared distances come from the
  BLAS expansion |q|^2 + |h|^2 - 2 q.h; candidates within a rigorous rounding
  margin of the k-th value are re-measured exactly with differences, so the
  result is the exact top-k by (distance, history id).  Each cell emits only
  k rows per query (pre-aggregation before the shuffle).
* The per-cell winners are merged with ``row_number() <= k`` per query
  (WindowGroupLimit: map-side top-k).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OUT_SCHEMA = "qid long, hid long, dist double"


def _kernel(k: int, chunk: int = 512):
    def run(q: pd.DataFrame, h: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(h) == 0:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"),
                                 "hid": pd.Series([], dtype="int64"),
                                 "dist": pd.Series([], dtype="float64")})
        Q = np.asarray(np.stack(q["vec"].to_numpy()), dtype=np.float64)
        H = np.asarray(np.stack(h["vec"].to_numpy()), dtype=np.float64)
        qids = q["qid"].to_numpy(dtype=np.int64)
        hids = h["hid"].to_numpy(dtype=np.int64)
        kk = min(k, len(H))
        hn = np.einsum("ij,ij->i", H, H)
        out_q, out_h, out_d = [], [], []
        for s in range(0, len(Q), chunk):
            Qc = Q[s:s + chunk]
            qn = np.einsum("ij,ij->i", Qc, Qc)
            d2 = qn[:, None] + hn[None, :] - 2.0 * (Qc @ H.T)
            kth = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
            tol = 1e-9 * (qn + hn.max()) + 1e-12
            # re-measure all candidates of the chunk at once, then rank them per query
            row, cand = np.nonzero(d2 <= (kth + tol)[:, None])
            exact = np.empty(len(row))
            for p in range(0, len(row), 65_536):   # many ties: bounded memory
                diff = H[cand[p:p + 65_536]] - Qc[row[p:p + 65_536]]
                exact[p:p + 65_536] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            order = np.lexsort((hids[cand], exact, row))
            row, cand, exact = row[order], cand[order], exact[order]
            first = np.searchsorted(row, np.arange(len(Qc)))
            keep = np.arange(len(row)) - first[row] < kk
            out_q.append(qids[s + row[keep]])
            out_h.append(hids[cand[keep]])
            out_d.append(exact[keep])
        return pd.DataFrame({"qid": np.concatenate(out_q), "hid": np.concatenate(out_h),
                             "dist": np.concatenate(out_d)})
    return run


def knn_topk(queries: DataFrame, history: DataFrame, k: int, qid: str = "qid", hid: str = "hid",
             vec: str = "vec", block_rows: int = 4096, parallelism: int | None = None,
             part: str | None = None) -> DataFrame:
    """Exact k nearest history rows for every query row: (qid, hid, dist, rank).
    Ties in distance are broken by the smaller history id.  Ids are longs,
    ``vec`` is array<double> of equal length on both sides.  With ``part`` (an
    int column of both sides) only rows of one part meet, all parts in one job;
    a query id then occurs in one part."""
    spark = queries.sparkSession
    nq, nh = queries.count(), history.count()
    par = parallelism or spark.sparkContext.defaultParallelism
    bq = max(1, math.ceil(nq / block_rows))
    bh = max(1, math.ceil(nh / block_rows), math.ceil(par / bq))
    bh = min(bh, max(1, nh))
    own = (F.col(part) if part else F.lit(0)).cast("int").alias("part")
    q = (queries.select(F.col(qid).cast("long").alias("qid"), F.col(vec).cast("array<double>").alias("vec"), own)
         .withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(bq)).cast("int"))
         .withColumn("hb", F.explode(F.sequence(F.lit(0), F.lit(bh - 1)))))
    h = (history.select(F.col(hid).cast("long").alias("hid"), F.col(vec).cast("array<double>").alias("vec"), own)
         .withColumn("hb", F.pmod(F.xxhash64("hid"), F.lit(bh)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(bq - 1)))))
    cells = q.groupBy("part", "qb", "hb").cogroup(h.groupBy("part", "qb", "hb")).applyInPandas(_kernel(k), OUT_SCHEMA)
    w = Window.partitionBy("qid").orderBy("dist", "hid")
    return cells.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def vote(neighbours: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Distance-weighted vote (weights 1/d; if any neighbour of a query is at
    distance 0, only those vote with weight 1).  Returns per (qid, label) the
    weight share ``prob``; labels absent among the neighbours are absent."""
    nb = neighbours.join(labels.select(F.col("hid"), F.col(label_col).alias("label")), "hid")
    w = Window.partitionBy("qid")
    has_zero = F.max((F.col("dist") == 0).cast("int")).over(w) == 1
    weight = F.when(has_zero, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    per = nb.withColumn("w", weight).groupBy("qid", "label").agg(F.sum("w").alias("score"))
    total = F.sum("score").over(Window.partitionBy("qid"))
    return per.withColumn("prob", F.col("score") / total)


def predict_from_votes(votes: DataFrame) -> DataFrame:
    """Argmax label per query; ties go to the smallest label."""
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("label").asc())
    return (votes.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
            .select("qid", F.col("label").alias("predicted"), F.col("prob").alias("confidence")))
