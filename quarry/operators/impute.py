"""Column statistics and missing-value filling.

Statistics are computed as scalar subqueries (``DataFrame.scalar()``): Catalyst
merges all subqueries over the same input into ONE aggregate, runs it once,
and inlines the results as literals -- no cross join and no driver round trip.
The exact median (``percentile``) keeps a value->count map per partition;
grades and 2-dp gpa have few distinct values, so the partial buffers stay
small.  ``approx=True`` switches to ``percentile_approx`` for unbounded
value domains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import clip, round_half_even


def median_of(df: DataFrame, c: str, approx: bool = False, accuracy: int = 100_000) -> Column:
    """Scalar-subquery Column holding the (interpolated) median of ``c``."""
    agg = F.percentile_approx(c, 0.5, accuracy) if approx else F.median(c)
    return df.select(agg.cast("double")).scalar()


def column_medians(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """One-row frame of medians of several columns (one aggregate pass)."""
    aggs = [(F.percentile_approx(c, 0.5, 100_000) if approx else F.median(c)).cast("double").alias(c)
            for c in cols]
    return df.agg(*aggs)


def fill_with(c: Column | str, value: Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, value)


def fill_median(df: DataFrame, cols: list[str], digits: int | None = None,
                approx: bool = False) -> DataFrame:
    """Fill nulls of each column with its median, the median first rounded
    half-even to ``digits`` (no rounding when ``digits`` is None)."""
    out = []
    for c in df.columns:
        if c in cols:
            m = median_of(df, c, approx)
            if digits is not None:
                m = round_half_even(m, digits)
            out.append(fill_with(c, m).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def clean_numeric(df: DataFrame, c: str, lo: float, hi: float, digits: int,
                  as_int: bool = False, approx: bool = False) -> Column:
    """Composite numeric clean of an already-parsed column ``c``:
    impossible -> null, median fill (median rounded to ``digits``), clip,
    round half-even, optional int cast.  ``df`` must be the frame holding the
    nulled values (the median is taken over it)."""
    med = round_half_even(median_of(df, c, approx), digits)
    v = round_half_even(clip(F.coalesce(F.col(c), med), lo, hi), digits)
    return v.cast("int") if as_int else v
