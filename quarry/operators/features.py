"""Feature encoding: label index, standardisation (population std), one-hot,
stratified split and fold assignment -- as DataFrame expressions.

MLlib's StandardScaler uses the sample std and does not centre by default,
and its OneHotEncoder drops a slot, so the exact encodings are written with
aggregates.  Statistics are a single aggregate packed into one scalar
subquery (run once, inlined as literals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators.dedupe import row_position

#: Buckets of the split key's histogram.
KEY_BUCKETS = 1000


def label_index(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    """Alphabetical label encoding 0..n-1 (``LabelEncoder``) for any number of
    labels: the distinct ones are numbered from range partitions and joined
    back, by broadcast where Spark sees that they are few.  Rows without a label
    are left out."""
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    return df.join(row_position(labels, col, out).withColumn(out, F.col(out).cast("int")), col)


def scaler_stats(fit: DataFrame, cols: list[str]) -> Column:
    """Mean (``m__``) and population std (``s__``) per column from ONE aggregate, a
    scalar struct.  Put it into a column before taking fields: each mention of
    the subquery is a copy of its plan on the driver."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m__{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s__{c}")]
    return fit.agg(*aggs).select(F.struct(*[f"{p}__{c}" for c in cols for p in ("m", "s")]).alias("st")).scalar()


def standardize(df: DataFrame, cols: list[str], fit: DataFrame | None = None,
                prefix: str = "z_") -> DataFrame:
    """(x - mean) / std with population std; zero std -> divide by 1."""
    rows = df.withColumn("_st", scaler_stats(fit if fit is not None else df, cols))
    zs = []
    for c in cols:
        m, s = F.col("_st")[f"m__{c}"], F.col("_st")[f"s__{c}"]
        scale = F.when(s.isNull() | (s < 1e-12), F.lit(1.0)).otherwise(s)
        zs.append(((F.col(c).cast("double") - m) / scale).alias(prefix + c))
    return rows.select("*", *zs).drop("_st")


def one_hot(df: DataFrame, col: str, categories: list[str], prefix: str | None = None) -> DataFrame:
    """One column per known category (sorted); an unknown value is all zeros."""
    prefix = prefix or f"{col}_"
    return df.select("*", *[(F.col(col) == F.lit(v)).cast("double").alias(prefix + v) for v in categories])


def interest_categories() -> list[str]:
    """The valid interests, sorted: a fixed list, so nothing is collected."""
    return sorted(C.VALID_INTERESTS)


def split_key(order_col: str = "row_order", seed: int = C.SEED) -> Column:
    """Deterministic pseudo-random order key (integer arithmetic, identical
    in any SQL engine): (order * 7919 + seed) mod 1000003."""
    return (F.col(order_col) * F.lit(7919) + F.lit(seed)) % F.lit(1000003)


def stratified_split(df: DataFrame, label_col: str, test_fraction: float = C.TEST_FRACTION,
                     order_col: str = "row_order", seed: int = C.SEED) -> DataFrame:
    """Adds ``is_test``: per class, the first round(fraction * n_class) rows
    in pseudo-random key order form the test set.

    No row is numbered but those at the cut: a histogram of the key in
    ``KEY_BUCKETS`` buckets per class tells in which bucket the test share
    ends; rows of smaller buckets are test rows, of larger ones train rows,
    and only the cut bucket's rows (about n_class / KEY_BUCKETS) are ranked."""
    tenths = int(round(test_fraction * 10))
    key = split_key(order_col, seed)
    keyed = df.withColumn("_bucket", F.floor(key * KEY_BUCKETS / F.lit(1000003)).cast("int"))
    hist = keyed.groupBy(label_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(label_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(label_col)
    hist = (hist.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .withColumn("_n_test", F.floor((F.sum("_n").over(whole) * tenths + 5) / 10)))
    cuts = (hist.filter(F.col("_before") <= F.col("_n_test")).groupBy(F.col(label_col).alias("_label"))
            .agg(F.max("_bucket").alias("_cut"), F.max_by(F.col("_n_test") - F.col("_before"), "_bucket").alias("_rest")))
    tagged = keyed.join(cuts, F.col(label_col).eqNullSafe(F.col("_label")))   # one row per class on the right
    far = tagged.filter(F.col("_bucket") != F.col("_cut")).withColumn("is_test", F.col("_bucket") < F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy("_label").orderBy(key, order_col))
    near = tagged.filter(F.col("_bucket") == F.col("_cut")).withColumn("is_test", rank <= F.col("_rest"))
    return far.unionByName(near).drop("_bucket", "_label", "_cut", "_rest")


def stratified_folds(df: DataFrame, label_col: str, k: int = C.CV_FOLDS,
                     order_col: str = "row_order") -> DataFrame:
    """Unshuffled stratified k-fold: classes are numbered by first appearance
    in the data, position p of the class-sorted label list goes to fold p % k;
    within a class the rows (data order) fill fold 0 first, then fold 1, ...
    with those per-fold counts."""
    cls = df.groupBy(F.col(label_col).alias("_label")).agg(F.count(F.lit(1)).alias("n_c"), F.min(order_col).alias("_first"))
    start = F.coalesce(F.sum("n_c").over(Window.orderBy("_first")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cls = cls.withColumn("start", start)   # one row per class: tiny
    bounds, acc = [], None
    for f in range(k):
        cnt = F.floor((F.col("start") + F.col("n_c") - 1 - f) / k) - F.floor((F.col("start") - 1 - f) / k)
        acc = cnt if acc is None else acc + cnt
        bounds.append(acc)
    cls = cls.select("_label", *[b.cast("long").alias(f"b{f}") for f, b in enumerate(bounds)])
    ranked = row_position(df, order_col, "_j", group_col=label_col).join(cls, F.col(label_col).eqNullSafe(F.col("_label")))
    fold = F.lit(k - 1)
    for f in reversed(range(k - 1)):
        fold = F.when(F.col("_j") < F.col(f"b{f}"), F.lit(f)).otherwise(fold)
    return ranked.withColumn("fold", fold.cast("int")).drop("_j", "_label", *[f"b{f}" for f in range(k)])
