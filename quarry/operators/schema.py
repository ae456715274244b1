"""Projection and schema operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import literal_nan_to_null


def drop_unexpected_columns(df: DataFrame, expected: list[str],
                            keep: tuple[str, ...] = ("row_order",)) -> tuple[DataFrame, list[str]]:
    """Keep whitelisted columns, matched by exact (case-sensitive) name before
    any renaming; return the frame and the dropped names (schema metadata)."""
    allowed = set(expected) | set(keep)
    dropped = [c for c in df.columns if c not in allowed]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in allowed]), dropped


def normalized_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore every column name."""
    return df.toDF(*[normalized_name(c) for c in df.columns])


def canonical_order(df: DataFrame, order: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Project to a canonical column order, skipping absent columns."""
    present = set(df.columns)
    return df.select(*[c for c in order if c in present], *[c for c in extra if c in present])


def enforce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns (absent ones skipped); other columns unchanged.
    A cell that isn't of the type becomes null, also under ANSI rules."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def align_features(df: DataFrame, features: list[str], fill=0) -> DataFrame:
    """Project to a saved feature list; an absent column becomes ``fill``."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in features])


def nan_literals_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Whole-cell ``nan``/``NaN``/``NAN`` -> null in every (text) column."""
    cols = set(cols or df.columns)
    return df.select(*[literal_nan_to_null(c).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def null_mask_any(cols: list[str]) -> Column:
    """Row has at least one null among ``cols``."""
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def unpivot_columns(df: DataFrame, ids: list[str], cols: list[str],
                    name_col: str = "name", value_col: str = "value") -> DataFrame:
    """Wide -> long (one row per id and column)."""
    return df.unpivot(ids, cols, name_col, value_col)
