"""Query keys for profiling, validation, the step log and dashboard aggregates."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions import numeric as N
from quarry.functions import text as T
from quarry.operators.schema import nan_literals_to_null, null_mask_any
from quarry.operators.selection import exact_medians
from quarry.operators.sketches import distinct_sketches, estimates, merge_sketches
from quarry.plans import clean as CL
from quarry.plans import report as RP
from quarry.plans.catalog import register
from quarry.plans.derived import sc, sl, sr, without_order
from quarry.session import ensure_checkpoint_dir, hand_off
from quarry.sources.csv_text import read_numbered_csv, write_text_csv
from quarry.sources.tables import read_table


def _raw_loaded(spark, sf) -> DataFrame:
    raw = sr(spark, sf)
    return nan_literals_to_null(raw, [c for c in raw.columns if c != "row_order"])


def _data_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "row_order"]


@register("row_reduction")
def q_row_reduction(spark, sf):
    n_in = sr(spark, sf).select(F.count(F.lit(1))).scalar()
    out = sc(spark, sf).agg(F.count(F.lit(1)).alias("rows_out"))
    pct = F.when(n_in == 0, F.lit(0.0)).otherwise(
        N.round_half_even((n_in - F.col("rows_out")) / n_in * 100.0, 1))
    return out.select(n_in.cast("long").alias("rows_in"), F.col("rows_out").cast("long").alias("rows_out"),
                      (n_in - F.col("rows_out")).cast("long").alias("rows_removed"), pct.alias("pct_removed"))


@register("missing_profile")
def q_missing_profile(spark, sf):
    df = _raw_loaded(spark, sf)
    cols = _data_cols(df)
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return agg.unpivot([], cols, "column_name", "missing_cells")


@register("rows_with_missing")
def q_rows_with_missing(spark, sf):
    df = _raw_loaded(spark, sf)
    return df.filter(null_mask_any(_data_cols(df))).select("row_order")


@register("raw_issue_summary")
def q_raw_issue_summary(spark, sf):
    df = _raw_loaded(spark, sf)
    cols = _data_cols(df)
    distinct_rows = df.select(*cols).distinct().select(F.count(F.lit(1))).scalar()
    per_col = [F.sum(F.col(c).isNull().cast("long")) for c in cols]
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 reduce(add, [F.when(x > 0, 1).otherwise(0) for x in per_col]).cast("long").alias("columns_with_missing"),
                 reduce(add, per_col).alias("missing_cells"),
                 F.sum(null_mask_any(cols).cast("long")).alias("rows_with_missing"))
    return agg.select(F.col("total_rows").cast("long"),
                      (F.col("total_rows") - distinct_rows).cast("long").alias("duplicate_rows"),
                      "columns_with_missing", F.col("missing_cells").cast("long"),
                      F.col("rows_with_missing").cast("long"))


@register("distinct_ids")
def q_distinct_ids(spark, sf):
    df = _raw_loaded(spark, sf)
    return df.agg(F.count_distinct("student_id").alias("raw_distinct"),
                  F.count_distinct(T.normalize_id("student_id")).alias("clean_distinct"))


def _parsed_nulled(spark, sf) -> DataFrame:
    raw = _raw_loaded(spark, sf)
    p = raw.select("row_order", T.parse_gpa("gpa").alias("gpa"),
                   *[T.parse_grade(g).alias(g) for g in C.GRADE_COLS])
    return p.select("row_order", N.nullify_outside("gpa", 0.0, 4.0).alias("gpa"),
                    *[N.nullify_outside(g, 0, 100).alias(g) for g in C.GRADE_COLS])


@register("column_medians")
def q_column_medians(spark, sf):
    """Exact medians by distributed selection, no task merging all values."""
    m = exact_medians(_parsed_nulled(spark, sf), ["gpa"] + C.GRADE_COLS)
    balance = exact_medians(read_table(spark, sf, "customer", ["c_acctbal"]), ["c_acctbal"])
    return m.select(*[F.round(F.col(c), 6).alias(c) for c in m.columns],
                    F.round(balance.scalar(), 6).alias("c_acctbal"))


@register("distinct_sketches")
def q_distinct_sketches(spark, sf):
    """Distinct customers of each order priority, of all orders and of orders
    and customers together, from sketches that are kept per group and merged;
    beside them the exact numbers and whether the sketches are within 3 %."""
    orders = read_table(spark, sf, "orders", ["o_orderpriority", "o_custkey"]).select(F.col("o_orderpriority").alias("grp"), F.col("o_custkey").alias("id"))
    customers = read_table(spark, sf, "customer", ["c_custkey"]).select(F.lit("customers").alias("grp"), F.col("c_custkey").alias("id"))
    kept = hand_off(distinct_sketches(orders.union(customers), ["id"], ["grp"]), "sketches")
    priorities = kept.where("grp <> 'customers'")
    merged = [kept, *(merge_sketches([t], ["id"]).withColumn("grp", F.lit(name)) for t, name in ((priorities, "all orders"), (kept, "all")))]
    about = estimates(reduce(DataFrame.unionByName, merged), ["id"]).withColumnRenamed("id", "about")
    every = orders.union(customers)
    exact = every.union(orders.select(F.lit("all orders"), "id")).union(every.select(F.lit("all"), "id")).groupBy("grp").agg(F.count_distinct("id").alias("n_distinct"))
    return exact.join(about, "grp").select("grp", "n_distinct", (F.abs(F.col("about") - F.col("n_distinct")) <= 0.03 * F.col("n_distinct")).alias("within"))


@register("numbered_scan")
def q_numbered_scan(spark, sf):
    """The raw students written as text files and read back with the order of
    their rows, without a column that brings it."""
    raw = sr(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/numbered/{uuid.uuid4().hex}"
    write_text_csv(raw.repartitionByRange(7, "row_order").sortWithinPartitions("row_order"), path)
    return read_numbered_csv(spark, path, ["row_order", "student_id"], name="position").select(F.col("row_order").cast("long").alias("row_order"), "student_id", "position")


@register("fill_median")
def q_fill_median(spark, sf):
    p = _parsed_nulled(spark, sf)
    med = p.select(F.median("gpa")).scalar()
    return p.select("row_order", F.coalesce(F.col("gpa"), N.round_half_even(med, 2)).alias("gpa"))


@register("noncanonical_count")
def q_noncanonical(spark, sf):
    df = _raw_loaded(spark, sf)
    i = F.col("interest")
    return df.agg(F.sum((i.isNotNull() & ~i.isin(*C.VALID_INTERESTS)).cast("long")).alias("noncanonical"))


@register("nonnumeric_count")
def q_nonnumeric(spark, sf):
    df = _raw_loaded(spark, sf)
    agg = df.agg(*[F.sum(T.is_nonnumeric_text(g).cast("long")).alias(g) for g in C.GRADE_COLS])
    return agg.unpivot([], C.GRADE_COLS, "course", "text_cells")


@register("null_token_count")
def q_null_token_count(spark, sf):
    df = _raw_loaded(spark, sf)
    return df.agg(F.sum(T.is_null_token("failed_courses").cast("long")).alias("null_tokens"))


@register("flags_corrected")
def q_flags_corrected(spark, sf):
    return CL.audit_counters(sr(spark, sf)).select("flags_fixed")


@register("step_log")
def q_step_log(spark, sf):
    return RP.step_log(CL.audit_counters(sr(spark, sf)))


@register("validate_clean")
def q_validate(spark, sf):
    return CL.validate_clean(sc(spark, sf))


@register("value_counts")
def q_value_counts(spark, sf):
    labelled = sl(spark, sf)
    orders = read_table(spark, sf, "orders", ["o_orderpriority"])
    parts = [labelled.groupBy(F.lit("recommended_track").alias("field"), F.col("recommended_track").alias("value")).count(),
             labelled.groupBy(F.lit("interest").alias("field"), F.col("interest").alias("value")).count(),
             orders.groupBy(F.lit("o_orderpriority").alias("field"), F.col("o_orderpriority").alias("value")).count()]
    return reduce(DataFrame.unionByName, parts)


@register("value_counts_pct")
def q_value_counts_pct(spark, sf):
    labelled = sl(spark, sf)
    a = RP.value_counts_pct(labelled, "recommended_track").withColumn("field", F.lit("recommended_track"))
    b = RP.value_counts_pct(labelled, "interest").withColumn("field", F.lit("interest"))
    return a.unionByName(b)


@register("group_mean")
def q_group_mean(spark, sf):
    labelled = sl(spark, sf)
    cust = read_table(spark, sf, "customer", ["c_mktsegment", "c_acctbal"])
    a = labelled.groupBy(F.col("recommended_track").alias("grp")).agg(
        N.round_half_even(F.avg("gpa"), 2).alias("mean")).withColumn("measure", F.lit("gpa"))
    b = cust.groupBy(F.col("c_mktsegment").alias("grp")).agg(
        N.round_half_even(F.avg("c_acctbal"), 2).alias("mean")).withColumn("measure", F.lit("c_acctbal"))
    return a.unionByName(b)


@register("column_means")
def q_column_means(spark, sf):
    labelled = sl(spark, sf)
    agg = labelled.agg(*[N.round_half_even(F.avg(g), 1).alias(g) for g in C.GRADE_COLS])
    long = agg.unpivot([], C.GRADE_COLS, "course", "mean")
    return long.select(T.relabel("course", C.COURSE_LABELS).alias("course_label"), "mean")


@register("predicate_rate")
def q_predicate_rate(spark, sf):
    labelled = sl(spark, sf)
    return labelled.agg(N.round_half_even(F.avg((F.col("failed_count") > 0).cast("double")) * 100.0, 1)
                        .alias("failed_rate"))


@register("column_range_profile")
def q_range_profile(spark, sf):
    labelled = sl(spark, sf)
    cols = ["gpa", "math_grade", "ai_grade", "programming_grade"]
    agg = labelled.agg(*[x for c in cols for x in (
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"),
        F.round(F.avg(c), 6).alias(f"{c}__mean"))])
    return agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                  F.col(f"{c}__min").alias("min_value"),
                                                  F.col(f"{c}__max").alias("max_value"),
                                                  F.col(f"{c}__mean").alias("mean_value")) for c in cols])))


@register("dataset_profile")
def q_dataset_profile(spark, sf):
    return RP.dataset_profile(sl(spark, sf))


@register("report_lines")
def q_report_lines(spark, sf):
    raw = sr(spark, sf)
    counters = CL.audit_counters(raw)
    return RP.report_lines(RP.step_log(counters), CL.validate_clean(sc(spark, sf)), sl(spark, sf), len(raw.columns) - 1)


# -- dashboard ---------------------------------------------------------------

def dashboard_summary(labelled: DataFrame, rules_shown: DataFrame | None = None) -> DataFrame:
    """All dashboard cards as (card, key, value) rows."""
    value = F.col
    totals = labelled.agg(F.count(F.lit(1)).cast("double").alias("n"),
                          N.round_half_even(F.avg((value("failed_count") > 0).cast("double")) * 100.0, 1).alias("failed"),
                          *[N.round_half_even(F.avg(g), 1).alias(g) for g in C.GRADE_COLS])
    one = lambda card, key, v: F.struct(F.lit(card).alias("card"), key.alias("key"), v.cast("double").alias("value"))
    cards = totals.select(F.inline(F.array(
        one("total_students", F.lit("all"), value("n")), one("failed_rate", F.lit("all"), value("failed")),
        *[one("avg_grade", F.lit(C.COURSE_LABELS[g]), value(g)) for g in C.GRADE_COLS])))
    # both distributions from one pass: each row counts once per field
    long = labelled.select("gpa", F.inline(F.array(
        F.struct(F.lit("track").alias("field"), value("recommended_track").alias("key")),
        F.struct(F.lit("interest").alias("field"), value("interest").alias("key")))))
    dist = long.groupBy("field", "key").agg(F.count(F.lit(1)).cast("double").alias("n"), N.round_half_even(F.avg("gpa"), 2).alias("gpa"))
    track = F.array(one("track_count", value("key"), value("n")), one("avg_gpa", value("key"), value("gpa")))
    dist = dist.select(F.inline(F.when(value("field") == "track", track).otherwise(F.array(one("interest_count", value("key"), value("n"))))))
    parts = [cards, dist]
    if rules_shown is not None:
        parts.append(rules_shown.agg(F.count(F.lit(1)).cast("double").alias("value"))
                     .select(F.lit("rules_shown").alias("card"), F.lit("all").alias("key"), "value"))
    return reduce(DataFrame.unionByName, [p.select("card", "key", "value") for p in parts])


@register("dashboard_summary")
def q_dashboard_summary(spark, sf):
    from quarry.plans.q_rules import saved_target_rules
    shown = saved_target_rules(spark, sf).filter(F.col("rule_rank") <= C.DASHBOARD_RULES)
    return dashboard_summary(sl(spark, sf), shown)


@register("dashboard_percentages")
def q_dashboard_pct(spark, sf):
    labelled = sl(spark, sf)
    total = labelled.select(F.count(F.lit(1))).scalar()
    t = labelled.groupBy(F.col("recommended_track").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    t = t.select(F.lit("track_bar").alias("bar"), "key",
                 N.round_half_even(F.col("n") / total * 100.0, 1).alias("width"))
    i = labelled.groupBy(F.col("interest").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    i = i.select(F.lit("interest_bar").alias("bar"), "key",
                 N.round_half_even(F.col("n") / total * 100.0, 1).alias("width"))
    g = labelled.groupBy(F.col("recommended_track").alias("key")).agg(
        N.round_half_even(F.avg("gpa"), 2).alias("gpa"))
    g = g.select(F.lit("gpa_bar").alias("bar"), "key", N.round_half_even(F.col("gpa") / 4.0 * 100.0, 1).alias("width"))
    return t.unionByName(i).unionByName(g)
