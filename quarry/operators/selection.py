"""Exact order statistics without a last merge in one task.

``percentile`` merges every distinct value's count in one task.  Here the value
of a rank is found by narrowing: the interval that holds it is cut into equal
buckets, Spark counts them (partial aggregation, a row for each bucket and
task), and the bucket that holds the rank becomes the next interval, until
few enough distinct values are left, or only one.  All columns and ranks are narrowed in the same jobs;
the driver sees at most ``BUCKETS`` rows for each of them.

Nulls don't count; NaN ranks behind infinity, as in Spark's order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import hand_off

BUCKETS = 1024
#: Values of an interval that are looked at one by one.
HELD = 1024
MOST_ROUNDS = 300


def values_at(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """For each column the values at the given fractions of the way from the
    first to the last value in order, interpolated between neighbours."""
    cols = list(wanted)
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(cols)])).alias("s")).select("s.*").where("x is not null")
    cells = hand_off(cells, "selection-cells")
    inf = F.lit(float("inf"))
    finite = ~F.isnan("x") & (F.col("x") != inf) & (F.col("x") != -inf)
    facts = {r["c"]: r for r in cells.groupBy("c").agg(
        F.count("*").alias("n"), F.count_if(F.col("x") == -inf).alias("low"), F.count_if(finite).alias("finite"), F.count_if(F.col("x") == inf).alias("high"),
        F.min(F.when(finite, F.col("x"))).alias("lo"), F.max(F.when(finite, F.col("x"))).alias("hi")).collect()}
    known: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple[float, float, int, int]] = {}  # (column, rank): interval, rank in it, values in it
    plan: dict[str, list[tuple[int, int, float] | None]] = {}
    for i, c in enumerate(cols):
        f, plan[c] = facts.get(i), []
        for fraction in wanted[c]:
            if f is None:
                plan[c].append(None)
                continue
            place = fraction * (f["n"] - 1)
            below, share = int(place), place - int(place)
            plan[c].append((below, min(below + 1, f["n"] - 1) if share else below, share))
            for rank in plan[c][-1][:2]:
                if rank < f["low"]:
                    known[i, rank] = float("-inf")
                elif rank < f["low"] + f["finite"]:
                    open_[i, rank] = (f["lo"], f["hi"], rank - f["low"], f["finite"])
                else:
                    known[i, rank] = float("inf") if rank < f["low"] + f["finite"] + f["high"] else float("nan")
    only = cells.where(finite)
    for _ in range(MOST_ROUNDS):
        for key, (lo, hi, _, _) in list(open_.items()):
            if lo == hi:
                known[key] = lo
                del open_[key]
        if not open_:
            break
        spans = sorted({(i, lo, hi, n <= HELD) for (i, _), (lo, hi, _, n) in open_.items()})
        frame = df.sparkSession.createDataFrame([(k, *s) for k, s in enumerate(spans)], "span int, c int, lo double, hi double, single boolean")
        inside = only.join(F.broadcast(frame), "c").where("x between lo and hi")  # a row for each open rank
        # halves first: the width of the widest interval is no double
        bucket = F.least(F.floor((F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BUCKETS), F.lit(BUCKETS - 1))
        counted: dict[int, list] = {}
        narrow = F.col("hi") / 2 - F.col("lo") / 2 > 0  # neighbours of the smallest doubles halve to the same
        for r in inside.groupBy("span", F.when(F.col("single") | ~narrow, F.col("x")).otherwise(bucket.cast("double")).alias("b")).agg(
                F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
            counted.setdefault(r["span"], []).append((r["lo"], r["hi"], r["n"]))
        at = {s[:3]: k for k, s in enumerate(spans)}
        for (i, rank), (lo, hi, k, n) in list(open_.items()):
            for a, b, m in sorted(counted[at[i, lo, hi]]):
                if k < m:
                    open_[i, rank] = (a, b, k, m)
                    break
                k -= m
    else:
        raise RuntimeError(f"ranks aren't found after {MOST_ROUNDS} rounds")
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        out[c] = []
        for p in plan[c]:
            if p is None:
                out[c].append(None)
            else:
                a, b = known[i, p[0]], known[i, p[1]]
                out[c].append(a if a == b or not p[2] else a * (1 - p[2]) + b * p[2])
    return out


def exact_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the median of each column."""
    found = values_at(df, {c: [0.5] for c in cols})
    return df.sparkSession.createDataFrame([[found[c][0] for c in cols]], ", ".join(f"`{c}` double" for c in cols))
