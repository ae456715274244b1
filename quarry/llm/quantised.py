"""Operator 3 - embedding near-dedup by int8 tile products.

Unit vectors are quantised to int8 with one scale each: u = s q + e.  For two
of them, u.v = (s q).(t r) + (s q).f + e.v, so the product of the codes is off
by at most |s q| |f| + |e|: a bound from per-vector lengths that were measured,
not assumed.  A tile multiplies the codes of two blocks (whole numbers, exact
in the float units that the BLAS uses) and only pairs whose product plus bound
reaches the threshold are computed again in double precision from the original
vectors.

Equal vectors are one row from the start, with their number as its weight.
Each tile returns at most a row per vector: the sum of its linked weights and a
link to its root among the tile's links, never the pairs.  Blocks are hashes of
the smallest vec_id and hold about ``TILE_ROWS`` vectors, so labels or hot
vectors don't set a tile's size.  The work is inherently all blocks against all
blocks.

Defined cases: null, empty, zero and non-finite vectors link with nothing;
vectors of different sizes never link; repeated rows are equal vectors; a null
vec_id counts as a vector but names no component of its own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Roots, connected_components, handoff
from quarry.llm.vectors import matrix, norms, packed_vectors, scaled

THRESHOLD = 0.9
TILE_ROWS = 8192
STRIPE = 256
PAIRS_AT_ONCE = 65_536
#: Above the rounding of the products and of the bounds.
SLACK = 1e-5


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes int8, scale, length of the coded vector, length of the error) of
    the unit vectors along the rows."""
    u = v / norms(v)[:, None]
    scale = np.abs(u).max(1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    coded = q * scale[:, None]
    return q, scale, np.sqrt((coded * coded).sum(1)), np.sqrt(((u - coded) ** 2).sum(1))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        size = np.array([len(x) for x in b.column(2).to_pylist()], dtype=np.int64)
        for d in np.unique(size).tolist():
            at = pa.array(np.flatnonzero(size == d))
            part = b.take(at)
            q, scale, coded, error = quantise(scaled(matrix(part.column(2))))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array([x.tobytes() for x in q], pa.binary()), pa.array(scale), pa.array(coded), pa.array(error)],
                names=["rep", "weight", "v", "q", "scale", "coded", "error"])


def _tile(threshold: float):
    def side(rows: pa.Table) -> dict[str, np.ndarray]:
        v = scaled(matrix(rows.column("v")))
        dtype = np.float32 if v.shape[1] * 127 * 127 < 2**24 else np.float64  # whole numbers that it holds exactly
        q = np.frombuffer(b"".join(rows.column("q").to_pylist()), dtype=np.int8).reshape(v.shape).astype(dtype)
        return {"v": v, "q": q, "norm": norms(v)} | {c: rows.column(c).to_numpy() for c in ("weight", "scale", "coded", "error")}

    def run(table: pa.Table) -> pa.Table:
        home = table.column("block").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        one = i == j
        left_rows = table.filter(pa.array(home == i))
        right_rows = left_rows if one else table.filter(pa.array(home == j))
        rep = np.concatenate([left_rows.column("rep").to_numpy(), [] if one else right_rows.column("rep").to_numpy()]).astype(np.int64)
        n, m = left_rows.num_rows, right_rows.num_rows
        links, roots, shift = np.zeros(len(rep), dtype=np.int64), Roots(len(rep)), 0 if one else n
        if n and m:
            a = side(left_rows)
            b = a if one else side(right_rows)
            worst = b["error"].max()
            bound = (threshold - SLACK - a["error"] - a["coded"] * worst) / a["scale"]
            for lo in range(0, n, STRIPE):
                hi = min(lo + STRIPE, n)
                at = lo if one else 0  # of a tile with itself the upper half
                product = a["q"][lo:hi] @ b["q"][at:].T
                product *= b["scale"][at:].astype(product.dtype)
                p, q = np.nonzero(product >= bound[lo:hi, None].astype(product.dtype))
                p, q = p + lo, q + at
                if one:
                    p, q = p[p < q], q[p < q]
                for k in range(0, len(p), PAIRS_AT_ONCE):
                    x, y = p[k:k + PAIRS_AT_ONCE], q[k:k + PAIRS_AT_ONCE]
                    cosine = np.einsum("ij,ij->i", a["v"][x], b["v"][y]) / (a["norm"][x] * b["norm"][y])
                    x, y = x[cosine >= threshold], y[cosine >= threshold]
                    links[:n] += np.bincount(x, b["weight"][y], minlength=n).astype(np.int64)
                    links[shift:shift + m] += np.bincount(y, a["weight"][x], minlength=m).astype(np.int64)
                    roots.link(x, y + shift)
        some = links > 0
        return pa.table({"rep": rep[some], "root": rep[roots.root[some]], "links": links[some]})
    return run


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding", tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per row."""
    vectors = handoff(packed_vectors(rows, key, vector), "quantised-vectors")
    distinct = vectors.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    reps = handoff(distinct.where("rep is not null").select("rep", "weight", "v"), "quantised-distinct")
    blocks = max(1, -(-reps.count() // tile_rows))
    coded = reps.mapInArrow(_codes, "rep long, weight long, v binary, q binary, scale double, coded double, error double")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    tiles = (coded.withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")).withColumn("other", other)
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).withColumn("size", F.octet_length("v")).drop("other"))
    found = handoff(tiles.groupBy("i", "j", "size").applyInArrow(_tile(threshold), "rep long, root long, links long"), "quantised-links")
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "quantised-components").withColumnRenamed("node", "rep")
    about = (reps.join(sums, "rep", "left").join(parts, "rep", "left")
             .select("v", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    linked = vectors.where("v is not null").join(about, "v", "left")
    alone = vectors.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).union(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
