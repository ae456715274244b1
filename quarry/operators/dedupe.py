"""Deduplication and row-position operators.

Skew: a single key (e.g. every unparseable id collapsing to ``UNKNOWN``) may
hold a large share of all rows.  Both operators reduce each key map-side
before the shuffle: ``dedupe_exact`` is a partial hash aggregate, and the
``row_number() == 1`` filter of ``keep_first`` is planned with a partial
WindowGroupLimit, so a hot key ships at most one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import hand_off


def dedupe_exact(df: DataFrame, cols: list[str] | None = None,
                 order_col: str | None = "row_order") -> DataFrame:
    """Whole-row dedupe over ``cols`` (nulls equal), keeping the first
    ``order_col`` of each duplicate group when an order column exists."""
    cols = cols or [c for c in df.columns if c != order_col]
    if order_col and order_col in df.columns:
        return df.groupBy(*cols).agg(F.min(order_col).alias(order_col))
    return df.select(*cols).dropDuplicates()


def keep_first(df: DataFrame, key: str | list[str], order_col: str = "row_order") -> DataFrame:
    """Dedupe by key, keeping the first row in ``order_col`` order
    (``drop_duplicates(subset, keep='first')``).  Rows of one order number
    are told apart by a hash of all their columns, so a rerun keeps the same."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc(), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def row_position(df: DataFrame, order_col: str | list, name: str = "position",
                 group_col: str | None = None) -> DataFrame:
    """Dense 0-based position in ``order_col`` order (within ``group_col``
    when given) without a single-task window: rows are range-partitioned on
    (group, order), so even a group holding a third of all rows spreads over
    many tasks.  The partitioned rows are written once with their partition's
    number; counts and rows both come from that table, so a partition means
    the same rows on either side whatever columns survive pruning and however
    partitions are coalesced.  Counts (a row per partition and group) become
    offsets; ranks are local to a partition."""
    orders = [order_col] if isinstance(order_col, str) else list(order_col)
    grp = [group_col] if group_col else []
    keys = grp + orders
    ranged = hand_off(df.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()), "positions")
    counts = ranged.groupBy("_pid", *grp).agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*grp).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w_off), F.lit(0))).select(
        F.col("_pid").alias("_p"), *[F.col(g).alias("_g") for g in grp], "_off")
    w_in = Window.partitionBy("_pid", *grp).orderBy(*orders)
    local = ranged.withColumn("_local", F.row_number().over(w_in) - 1)
    same = F.col("_pid") == F.col("_p")
    for g in grp:
        same = same & F.col(g).eqNullSafe(F.col("_g"))
    return (local.join(offsets, same)
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_p", "_g", "_off", "_local"))
