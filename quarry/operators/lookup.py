"""Lookup by prefix in a dictionary of any size, as equi-joins.

An entry matches a key if the key begins with it, or if it begins with the
key's first ``head`` characters; of several the one of least priority counts.
Each distinct key is joined once by its prefixes (one for each length that
entries have) and once by its head with the entries' prefixes, where only the
entry of least priority is kept for each prefix; so a key takes at most one row for each length, however
many entries begin alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefix_lookup(keys: DataFrame, entries: DataFrame, key: str = "key", head: int = 6, out: str = "canonical") -> DataFrame:
    """``keys`` with the value of the first matching entry (null if none);
    entries: priority int, variant string, canonical string.  A null key
    matches nothing; an empty one, whose head begins everything, the first entry."""
    first = Window.partitionBy("prefix").orderBy("priority")

    def least(rows: DataFrame) -> DataFrame:
        """The entry of least priority for each prefix."""
        return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")

    entries = entries.select(F.col("priority").cast("int").alias("priority"), "variant", F.col("canonical").alias("value")).where("variant is not null")
    whole = least(entries.select("priority", "value", F.col("variant").alias("prefix")))
    size = F.char_length("variant")
    # entries that begin with a head of at most ``head`` characters
    begins = F.explode(F.sequence(F.lit(0), F.least(size, F.lit(head))))
    heads = least(entries.select("priority", "value", "variant", begins.alias("n")).select("priority", "value", F.expr("left(variant, n)").alias("prefix")))
    asked = keys.select(F.col(key).alias("key")).where("key is not null").distinct()
    used = [r["n"] for r in entries.select(size.alias("n")).distinct().orderBy("n").collect()]  # lengths, not entries
    lengths = F.array(*[F.lit(n) for n in used]) if used else F.array().cast("array<int>")
    parts = (asked.select("key", F.explode(F.filter(lengths, lambda n: n <= F.char_length("key"))).alias("n"))
             .select("key", F.expr("left(key, n)").alias("prefix")))
    found = (parts.join(whole, "prefix").select("key", "priority", "value")
             .union(asked.select("key", F.expr(f"left(key, {head})").alias("prefix")).join(heads, "prefix").select("key", "priority", "value")))
    best = found.groupBy("key").agg(F.min_by("value", "priority").alias(out))
    return keys.join(best.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left").drop("_key")
