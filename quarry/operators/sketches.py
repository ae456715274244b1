"""Distinct counts that merge: a sketch for each group and table, written once,
added up over any set of groups or tables later without reading the rows again.

HyperLogLog sketches (Spark's ``hll_sketch_agg``) with 2**lg_k registers have a
relative standard error of about 1.04 / sqrt(2**lg_k), 0.8 % for the default of
14, and up to 16 KB each whatever they count.  Nulls don't count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def _countable(c: Column, kind: str) -> Column:
    """A column of a type that sketches take; whole numbers count alike in all widths."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("long")
    return c if kind in ("string", "binary") else c.cast("string")


def distinct_sketches(df: DataFrame, columns: list[str], by: list[str] | None = None, lg_k: int = LG_K) -> DataFrame:
    """A row for each group of ``by`` (one in all without) with a sketch of
    every column under its name."""
    kinds = dict(df.dtypes)
    return df.groupBy(*(by or [])).agg(*[F.hll_sketch_agg(_countable(F.col(f"`{c}`"), kinds[c]), lg_k).alias(c) for c in columns])


def merge_sketches(tables: list[DataFrame], columns: list[str], by: list[str] | None = None) -> DataFrame:
    """The sketches of tables added up, for each group of ``by`` or in all."""
    every = reduce(DataFrame.unionByName, [t.select(*(by or []), *columns) for t in tables])
    return every.groupBy(*(by or [])).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def estimates(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """The sketches replaced by their distinct counts (long)."""
    return sketches.withColumns({c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("long")) for c in columns})
