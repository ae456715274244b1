"""Frequent itemsets, association rules and rule matching.

* Itemsets are counted level by level (Apriori, like the original): baskets are
  written once as numbers of their frequent items, tasks turn batches of them
  into bit columns and count every candidate by AND and popcount, and the
  counts add up.  Work is a few word operations per 64 baskets and candidate.
  The support threshold keeps the original semantics ``count / n >=
  min_support`` exactly.  The driver lists the frequent items, at most a mean
  basket's length / min_support, and a level's itemsets as small numbers:
  both follow the threshold, not the number of baskets.
* Rules: the original emits every antecedent/consequent split.  Consequents are
  grown level by level from those that reach the confidence; the supports of
  both sides are joined back from the itemset table.
* Matching rules to profiles is an equi-join on single items (profile items
  exploded x rule antecedent items, broadcast of the <= top-k rules), then a
  count per (profile, rule) compared with the antecedent size -- no theta or
  cross join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import round_half_even
from quarry.session import hand_off


def item_key(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat_ws("|", c)


def basket_long(baskets: DataFrame, id_col: str = "student_id", items_col: str = "items") -> DataFrame:
    """Long form of baskets: one row per (basket, item)."""
    return baskets.select(id_col, F.explode(items_col).alias("item"))


#: Items up to which a basket table is made wide.
WIDE_ITEMS = 2000


def vocabulary(long: DataFrame, item_col: str = "item") -> list[str]:
    """The distinct items of a long basket table, sorted: frozen once, so that
    tables encoded apart have the same columns."""
    return [r[0] for r in long.select(item_col).where(F.col(item_col).isNotNull()).distinct().orderBy(item_col).collect()]


def basket_matrix(baskets: DataFrame, items: list[str], id_col: str = "student_id", items_col: str = "items") -> DataFrame:
    """A boolean column for each item of the vocabulary, a map without a
    shuffle; items outside it are ignored, a null basket holds nothing."""
    if len(items) > WIDE_ITEMS:
        raise ValueError(f"{len(items)} items are too many for columns; use basket_vectors")
    return baskets.select(id_col, *[F.coalesce(F.array_contains(items_col, v), F.lit(False)).alias(v) for v in items])


def matrix_baskets(matrix: DataFrame, items: list[str], id_col: str = "student_id") -> DataFrame:
    """The long form of a basket matrix: its inverse."""
    held = F.array_compact(F.array(*[F.when(F.col(f"`{v}`"), F.lit(v)) for v in items]))
    return matrix.select(id_col, F.explode(held).alias("item"))


def basket_vectors(baskets: DataFrame, items: list[str], id_col: str = "student_id", items_col: str = "items") -> DataFrame:
    """The matrix for vocabularies of any size: a sparse vector of zeros and
    ones for each basket."""
    model = CountVectorizerModel.from_vocabulary(items, inputCol="_items", outputCol="vector", minTF=1.0).setBinary(True)
    return model.transform(baskets.select(id_col, F.coalesce(items_col, F.array().cast("array<string>")).alias("_items"))).select(id_col, "vector")


def vector_baskets(vectors: DataFrame, items: list[str], id_col: str = "student_id") -> DataFrame:
    """The long form of basket vectors: their inverse.  The vocabulary travels as a table."""
    places = vectors.sparkSession.createDataFrame(list(enumerate(items)), "_place int, item string")
    held = vectors.select(id_col, F.explode(F.unwrap_udt("vector")["indices"]).alias("_place"))
    return held.join(places, "_place").select(id_col, "item")


def min_count_for(n: int, min_support: float) -> int:
    """Smallest count c with ``c / n >= min_support`` (float semantics)."""
    c = max(1, math.floor(min_support * n) - 1)
    while c / n < min_support:
        c += 1
    return c


#: Bytes of a task's bit columns, and of the candidates' that it ANDs at once.
BIT_BYTES = 8 << 20
#: Candidates to a row of counts.
COUNTED = 1 << 16


def bit_columns(owner: np.ndarray, item: np.ndarray, rows: int, n_items: int) -> np.ndarray:
    """For each item the baskets that hold it, a bit each, in 64-bit words."""
    held = np.zeros((n_items, -(-rows // 64) * 64), dtype=bool)
    held[item, owner] = True
    return np.packbits(held, axis=1).view(np.uint64)


def count_sets(bits: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """The baskets that hold all items of each row of ``sets``."""
    out, step = np.zeros(len(sets), dtype=np.int64), max(1, BIT_BYTES // max(1, 8 * bits.shape[1]))
    for lo in range(0, len(sets), step):
        some = sets[lo:lo + step]
        both = bits[some[:, 0]]
        for c in range(1, some.shape[1]):
            both &= bits[some[:, c]]
        out[lo:lo + step] = np.bitwise_count(both).sum(1)
    return out


def next_candidates(level: np.ndarray) -> np.ndarray:
    """Sets one item longer, all of whose parts are in the level: pairs of its
    (sorted) rows that differ in the last item only."""
    if not len(level):
        return np.zeros((0, level.shape[1] + 1), dtype=level.dtype)
    cut = np.flatnonzero(np.append(True, (level[1:, :-1] != level[:-1, :-1]).any(1)))
    left, right = [], []
    for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(level)]):
        x, y = np.triu_indices(z - a, 1)
        left.append(x + a)
        right.append(y + a)
    x, y = np.concatenate(left), np.concatenate(right)
    grown = np.column_stack([level[x], level[y, -1]])
    named = lambda rows: np.ascontiguousarray(rows).view([("", rows.dtype)] * rows.shape[1])[:, 0]
    known = named(level)
    for c in range(level.shape[1] - 1):  # without either of the last two, the parts are the pair itself
        grown = grown[np.isin(named(np.delete(grown, c, axis=1)), known)]
    return grown


def _counted(coded: DataFrame, sets: np.ndarray, n_items: int) -> np.ndarray:
    """How many baskets (codes array<int>) hold each set, counted in tasks."""
    step = max(64, BIT_BYTES // max(1, n_items) // 64 * 64)  # baskets at once: a byte for each item before they are packed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sets), dtype=np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, step):
                some = b.column(0).slice(lo, step)
                size = np.diff(some.offsets.to_numpy())
                total += count_sets(bit_columns(np.repeat(np.arange(len(some)), size), some.flatten().to_numpy(), len(some), n_items), sets)
        parts = range(0, len(total), COUNTED)
        yield pa.RecordBatch.from_arrays([pa.array([p // COUNTED for p in parts], pa.int32()), pa.array([total[p:p + COUNTED] for p in parts], pa.list_(pa.int64()))], names=["part", "counts"])

    cells = coded.select("codes").mapInArrow(run, "part int, counts array<long>").select("part", F.posexplode("counts").alias("place", "n"))
    found = cells.where("n > 0").groupBy((F.col("part") * COUNTED + F.col("place")).alias("at")).agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(sets), dtype=np.int64)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out


def frequent_itemsets(baskets: DataFrame, min_support: float, items_col: str = "items",
                      num_partitions: int | None = None) -> DataFrame:
    """All frequent itemsets: ``items`` (sorted array), ``freq`` (count),
    ``support`` (freq / n), ``length``.  A basket may hold an item once; a null
    basket holds nothing.  ``num_partitions`` deals the baskets anew."""
    spark, schema = baskets.sparkSession, "items array<string>, freq long, support double, length int"
    n = baskets.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    k = min_count_for(n, min_support)
    held = baskets.select(F.col(items_col).cast("array<string>").alias("items")).where("items is not null")
    held = held.repartition(num_partitions) if num_partitions else held
    once = F.when(F.size("items") == F.size(F.array_distinct("items")), F.col("items")).otherwise(F.raise_error(F.lit("items in a basket must be unique")))
    known = held.select(F.explode(once).alias("item")).groupBy("item").agg(F.count("*").alias("freq")).where(F.col("freq") >= k).collect()
    known = sorted(known, key=lambda r: (r["item"] is None, r["item"] or ""))  # as array_sort does
    if not known:
        return spark.createDataFrame([], schema)
    names = [r["item"] for r in known]
    code = F.create_map(*[F.lit(x) for i, v in enumerate(names) if v is not None for x in (v, i)]) if any(v is not None for v in names) else F.create_map().cast("map<string,int>")
    of = lambda x: F.when(x.isNull(), F.lit(len(names) - 1 if names[-1] is None else None).cast("int")).otherwise(F.try_element_at(code, x))
    coded = hand_off(held.select(F.array_compact(F.transform("items", of)).alias("codes")).where(F.size("codes") > 1), "baskets")
    level = np.arange(len(names), dtype=np.int32)[:, None]
    levels = [(level, np.array([r["freq"] for r in known], dtype=np.int64))]
    while len(sets := next_candidates(level)):
        freq = _counted(coded, sets, len(names))
        level, freq = sets[freq >= k], freq[freq >= k]
        levels.append((level, freq))
    rows = pa.table({"codes": pa.array([r for sets, _ in levels for r in sets], pa.list_(pa.int32())), "freq": np.concatenate([f for _, f in levels])})
    names_ = F.array(*[F.lit(v).cast("string") for v in names])
    return spark.createDataFrame(rows).select(
        F.transform("codes", lambda c: F.get(names_, c)).alias("items"), "freq", (F.col("freq") / F.lit(float(n))).alias("support"), F.size("codes").alias("length"))


def association_rules(itemsets: DataFrame, n_baskets: Column | int, min_confidence: float,
                      itemset_filter: Column | None = None) -> DataFrame:
    """Every rule A -> C with A, C non-empty, A u C a frequent itemset and
    confidence >= ``min_confidence``.  support = s(AC), confidence =
    s(AC)/s(A), lift = confidence / s(C), with s(X) = count(X) / n.

    Consequents grow by one item a round: a larger consequent leaves a smaller,
    more frequent antecedent and so has no larger confidence, hence only
    consequents all of whose parts one item shorter pass are tried.  Work
    follows the rules found, not the 2**L splits of an itemset."""
    n = F.lit(float(n_baskets)) if isinstance(n_baskets, int) else n_baskets.cast("double")
    base = itemsets.filter(F.col("length") >= 2)
    if itemset_filter is not None:
        base = base.filter(itemset_filter)
    support = itemsets.select(item_key("items").alias("_key"), F.col("freq").alias("_freq"))
    s_ac, s_a = F.col("freq") / n, F.col("freq_a") / n

    def passing(candidates: DataFrame) -> DataFrame:
        """Candidates (items, freq, consequents) that reach the confidence."""
        split = candidates.withColumn("antecedents", F.array_except("items", "consequents")).withColumn("_key", item_key("antecedents"))
        known = split.join(support, "_key").withColumnRenamed("_freq", "freq_a").drop("_key")
        return hand_off(known.filter(s_ac / s_a >= min_confidence), "rules-level")

    rounds = [passing(base.select("items", "freq", F.explode("items").alias("c")).select("items", "freq", F.array("c").alias("consequents")))]
    size = 1
    while not rounds[-1].isEmpty():
        size += 1
        last = rounds[-1].select("items", "freq", "consequents", F.slice("consequents", 1, size - 2).alias("_head"), F.element_at("consequents", -1).alias("_tail"))
        # two consequents of one itemset that differ in their last item make the next
        left = last.filter(F.size("items") > size).select("items", "freq", "consequents", "_head", F.array_position("items", F.col("_tail")).alias("_at"))
        right = last.select("items", "_head", F.col("_tail"), F.array_position("items", F.col("_tail")).alias("_next"))
        grown = left.join(right, ["items", "_head"]).filter(F.col("_at") < F.col("_next")).select("items", "freq", F.concat("consequents", F.array("_tail")).alias("consequents"))
        rounds.append(passing(grown))
    found = reduce(DataFrame.unionByName, rounds)
    joined = found.withColumn("_key", item_key("consequents")).join(support.withColumnRenamed("_freq", "freq_c"), "_key")
    conf = s_ac / s_a
    return joined.select("antecedents", "consequents", s_ac.alias("support"), conf.alias("confidence"),
                         (conf / (F.col("freq_c") / n)).alias("lift"))


def has_prefix(c: str, prefix: str) -> Column:
    return F.exists(c, lambda x: x.startswith(prefix))


def rank_rules(rules: DataFrame, top: int | None = None) -> DataFrame:
    """Order by lift, confidence (desc) with a deterministic tie-break on the
    item lists; keep the first ``top``; number them ``rule_rank`` 1..top.
    ``orderBy + limit`` plans as TakeOrderedAndProject (per-partition top-k,
    then a merge of at most top x partitions rows)."""
    order = [F.col("lift").desc(), F.col("confidence").desc(),
             item_key("antecedents").asc(), item_key("consequents").asc()]
    ranked = rules.orderBy(*order)
    if top is not None:
        ranked = ranked.limit(top)
    w = Window.orderBy(*order)  # over at most ``top`` rows
    return ranked.withColumn("rule_rank", F.row_number().over(w))


def target_rules(rules: DataFrame, prefix: str = "Track_", top: int = 80) -> DataFrame:
    """Rules with a target item in the consequent, ranked, top-k, item lists
    sorted: antecedents, consequents, support, confidence, lift, rule_rank."""
    kept = rules.filter(has_prefix("consequents", prefix))
    ranked = rank_rules(kept, top)
    return ranked.select(F.array_sort("antecedents").alias("antecedents"),
                         F.array_sort("consequents").alias("consequents"),
                         "support", "confidence", "lift", "rule_rank")


def display_rule_columns(df: DataFrame) -> list[Column]:
    """Percentages with 1 dp and lift with 2 dp (display rounding)."""
    return [round_half_even(F.col("support") * 100.0, 1).alias("support_pct"),
            round_half_even(F.col("confidence") * 100.0, 1).alias("confidence_pct"),
            round_half_even(F.col("lift"), 2).alias("lift_2dp")]


def match_rules(profiles: DataFrame, rules: DataFrame, id_col: str = "student_id",
                items_col: str = "items", target_prefix: str = "Track_",
                per_profile: int | None = None) -> DataFrame:
    """Rules whose antecedents are a subset of the profile's items (and that
    have a target consequent), optionally only the first ``per_profile`` by
    ``rule_rank``.  The rules, bounded by the top-k cut, travel to the profiles
    as one ordered list, so no pair of a profile and an item becomes a row."""
    r = rules.filter(has_prefix("consequents", target_prefix) & (F.size("antecedents") > 0))
    listed = r.agg(F.array_sort(F.collect_list(F.struct("rule_rank", *[c for c in r.columns if c != "rule_rank"]))).alias("_rules"))
    met = F.filter("_rules", lambda x: F.forall(x["antecedents"], lambda i: F.array_contains(F.col("_items"), i)))
    if per_profile is not None:
        met = F.slice(met, 1, per_profile)
    held = profiles.select(id_col, F.col(items_col).alias("_items")).crossJoin(F.broadcast(listed))   # one row
    return held.select(id_col, F.inline(met))
