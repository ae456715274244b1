"""Query keys for sources, schema operators, parsers and the cleaning job."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions import bands as B
from quarry.functions import numeric as N
from quarry.functions import text as T
from quarry.functions.scoring import recommend_track, track_score
from quarry.operators import schema as S
from quarry.operators.dedupe import dedupe_exact, keep_first, row_position
from quarry.plans import clean as CL
from quarry.plans.catalog import register
from quarry.plans.derived import sc, sc_plan, sl, sr, sr_plan, without_order
from quarry.session import ensure_checkpoint_dir
from quarry.sources.csv_text import read_text_csv, write_text_csv
from quarry.sources.tables import read_table


def grades_long(df: DataFrame, id_col: str = "row_order") -> DataFrame:
    """One row per (id, course) with the raw grade text."""
    return df.select(id_col, *C.GRADE_COLS).unpivot(id_col, C.GRADE_COLS, "course", "raw")


# -- sources -----------------------------------------------------------------

@register("scan_text_csv")
def q_scan_text_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SR written as header CSV into the shared checkpoint folder and read
    back all-text: blank cells come back as '' (not null)."""
    raw = sr_plan(spark, sf)
    path = os.path.join(ensure_checkpoint_dir(spark), f"sr-csv-{uuid.uuid4().hex}")
    write_text_csv(raw, path)
    back = read_text_csv(spark, path, raw.columns)
    return back.withColumn("row_order", F.col("row_order").cast("long"))


@register("scan_clean")
def q_scan_clean(spark: SparkSession, sf: str) -> DataFrame:
    """SC written as parquet and read back with the explicit clean schema."""
    clean = without_order(sc(spark, sf))
    path = os.path.join(ensure_checkpoint_dir(spark), f"sc-parquet-{uuid.uuid4().hex}")
    clean.write.mode("overwrite").parquet(path)
    return spark.read.schema(clean.schema).parquet(path)


@register("historical_projection")
def q_historical(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["student_id", "gpa", "interest", "recommended_track", *C.GRADE_COLS, "failed_courses"]
    return sl(spark, sf).select(*cols)


# -- schema ------------------------------------------------------------------

@register("drop_unexpected_columns")
def q_drop_unexpected(spark, sf):
    df, _ = S.drop_unexpected_columns(sr(spark, sf), C.CLEAN_ORDER)
    return df


@register("normalize_column_names")
def q_normalize_names(spark, sf):
    nation = read_table(spark, sf, "nation")
    padded = nation.select(F.col("n_nationkey").alias(" N NationKey "),
                           F.col("n_name").alias("N Name"),
                           F.col("n_regionkey").alias("  n regionKey"))
    return S.normalize_column_names(padded)


@register("canonical_order")
def q_canonical_order(spark, sf):
    return S.canonical_order(sc(spark, sf), C.CLEAN_ORDER)


@register("enforce_types")
def q_enforce_types(spark, sf):
    as_text = without_order(sc(spark, sf))
    as_text = as_text.select(*[F.col(c).cast("string").alias(c) for c in as_text.columns])
    return S.enforce_types(as_text, CL.CLEAN_TYPES)


@register("union_all")
def q_union_all(spark, sf):
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_acctbal"])
    return cust.unionByName(cust.filter(F.col("c_custkey") % 20 == 0))


@register("literal_nan_to_null")
def q_literal_nan(spark, sf):
    return S.nan_literals_to_null(sr(spark, sf), [c for c in sr(spark, sf).columns if c != "row_order"])


# -- parsers -----------------------------------------------------------------

@register("normalize_id")
def q_normalize_id(spark, sf):
    return sr(spark, sf).select("row_order", F.col("student_id").alias("raw"),
                                T.normalize_id("student_id").alias("student_id"))


@register("parse_gpa")
def q_parse_gpa(spark, sf):
    return sr(spark, sf).select("row_order", F.col("gpa").alias("raw"),
                                T.parse_gpa(T.literal_nan_to_null("gpa")).alias("gpa"))


@register("parse_grade")
def q_parse_grade(spark, sf):
    g = grades_long(sr(spark, sf))
    return g.select("row_order", "course", "raw",
                    T.parse_grade(T.literal_nan_to_null("raw")).alias("grade"))


@register("strip_unit_suffix")
def q_strip_suffix(spark, sf):
    g = grades_long(sr(spark, sf))
    return g.select("row_order", "course", T.strip_unit_suffix(F.lower(T.py_strip("raw"))).alias("stripped"))


@register("word_to_number")
def q_word_to_number(spark, sf):
    g = grades_long(sr(spark, sf))
    return g.select("row_order", "course",
                    T.word_to_number(F.lower(T.py_strip("raw"))).alias("number"))


@register("null_tokens")
def q_null_tokens(spark, sf):
    df = sr(spark, sf).select("row_order", T.literal_nan_to_null("failed_courses").alias("raw"))
    return df.select("row_order", "raw", T.is_null_token("raw").alias("is_token"),
                     T.null_tokens_to("raw", "None").alias("encoded"))


@register("standardize_category")
def q_standardize(spark, sf):
    return sr(spark, sf).select("row_order", F.col("interest").alias("raw"),
                                T.standardize_category(T.literal_nan_to_null("interest")).alias("interest"))


@register("coerce_numeric")
def q_coerce(spark, sf):
    g = grades_long(sr(spark, sf))
    return g.select("row_order", "course", N.coerce_numeric("raw").alias("value"))


@register("nullify_outliers")
def q_nullify(spark, sf):
    g = grades_long(sr(spark, sf))
    p = g.select("row_order", "course", T.parse_grade(T.literal_nan_to_null("raw")).alias("parsed"))
    return p.select("row_order", "course", "parsed",
                    N.nullify_outside("parsed", 0, 100).alias("grade"))


@register("out_of_range")
def q_out_of_range(spark, sf):
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    return cust.filter(N.out_of_range("c_acctbal", 0.0, 9000.0))


@register("clip_values")
def q_clip(spark, sf):
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    return cust.select("c_custkey", N.clip("c_acctbal", 0.0, 5000.0).alias("clipped"))


@register("round_half_even")
def q_round(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"])
    return li.select("l_orderkey", "l_linenumber",
                     N.round_half_even("l_extendedprice", 0).alias("price_0dp"),
                     N.round_half_even(F.col("l_extendedprice") * F.col("l_discount"), 1).alias("disc_1dp"))


@register("clamp_int_input")
def q_clamp_int(spark, sf):
    g = grades_long(sr(spark, sf))
    return g.select("row_order", "course", "raw", N.clamp_int_input("raw").alias("grade"))


@register("clamp_float_input")
def q_clamp_float(spark, sf):
    return sr(spark, sf).select("row_order", F.col("gpa").alias("raw"),
                                N.clamp_float_input("gpa").alias("gpa"))


@register("safe_text")
def q_safe_text(spark, sf):
    return sr(spark, sf).select("row_order", T.safe_text(T.literal_nan_to_null("failed_courses")).alias("text"),
                                T.safe_text("interest", "Undecided").alias("interest"))


@register("fallback_choice")
def q_fallback(spark, sf):
    return sr(spark, sf).select("row_order",
                                T.fallback_choice("interest", C.INTEREST_OPTIONS, "Undecided").alias("interest"))


# -- cleaning job and its pieces ---------------------------------------------

@register("clean_students")
def q_clean_students(spark, sf):
    """The whole cleaning job over the raw table (the flagship query)."""
    return without_order(sc_plan(spark, sf))


@register("dedupe_exact")
def q_dedupe_exact(spark, sf):
    loaded, _ = CL.load_stage(sr(spark, sf))
    return dedupe_exact(loaded)


@register("dedupe_key_keep_first")
def q_keep_first(spark, sf):
    loaded, _ = CL.load_stage(sr(spark, sf))
    exact = dedupe_exact(loaded)
    ided = exact.select("row_order", T.normalize_id("student_id").alias("student_id"))
    return keep_first(ided, "student_id")


@register("row_position")
def q_row_position(spark, sf):
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return row_position(orders, "o_orderkey")


@register("clean_numeric_columns")
def q_clean_numeric(spark, sf):
    return sc(spark, sf).select("student_id", "gpa", *C.GRADE_COLS)


@register("pass_fail_flags")
def q_flags(spark, sf):
    return sc(spark, sf).select("student_id", *C.PASSED_COLS, *C.FAILED_COLS)


@register("row_counts")
def q_row_counts(spark, sf):
    df = sc(spark, sf)
    return df.select("student_id",
                     N.row_sum(C.PASSED_COLS).alias("passed_count"),
                     N.row_sum(C.FAILED_COLS).alias("failed_count"),
                     N.row_count_where(C.GRADE_COLS, lambda c: c >= C.EXCELLENT_MARK).alias("excellent_count"),
                     N.row_count_where(C.GRADE_COLS, lambda c: c < C.GOOD_MARK).alias("weak_count"))


@register("failed_courses_fix")
def q_failed_fix(spark, sf):
    return sc(spark, sf).select("student_id", "failed_courses", "failed_count")


@register("auto_gpa")
def q_auto_gpa(spark, sf):
    return sc(spark, sf).select("student_id", N.auto_gpa().alias("auto_gpa"))


def _grades_long_clean(df: DataFrame) -> DataFrame:
    return df.select("student_id", *C.GRADE_COLS).unpivot("student_id", C.GRADE_COLS, "course", "grade")


@register("grade_level")
def q_grade_level(spark, sf):
    g = _grades_long_clean(sc(spark, sf))
    return g.select("student_id", "course", "grade", B.grade_level("grade").alias("level"))


@register("grade_band")
def q_grade_band(spark, sf):
    g = _grades_long_clean(sc(spark, sf))
    label = T.relabel("course", C.ITEM_LABELS, title_unknown=False)
    return g.select("student_id", "course", F.concat(B.grade_band("grade"), F.lit("_"), label).alias("item"))


@register("join_course_list")
def q_join_list(spark, sf):
    df = sc(spark, sf)
    return df.select("student_id",
                     B.join_course_list(B.courses_where(lambda g: g >= C.PASS_MARK), empty=None).alias("passed_list"),
                     B.join_course_list(B.courses_where(lambda g: g < C.PASS_MARK)).alias("failed_list"))


@register("threshold_course_lists")
def q_threshold_lists(spark, sf):
    df = sc(spark, sf)
    return df.select(
        "student_id",
        F.concat_ws("|", B.courses_where(lambda g: g < C.PASS_MARK)).alias("failed"),
        F.concat_ws("|", B.courses_where(lambda g: g < C.GOOD_MARK, first_n=3)).alias("weak_first3"),
        F.concat_ws("|", B.courses_where(lambda g: (g >= C.PASS_MARK) & (g < C.GOOD_MARK))).alias("weak_not_failed"),
        F.concat_ws("|", B.courses_where(lambda g: g >= C.STRONG_CORE_MARK, first_n=4)).alias("strong_first4"))


@register("track_scores")
def q_track_scores(spark, sf):
    df = sc(spark, sf)
    arr = F.array(*[F.struct(F.lit(t["track"]).alias("track"),
                             F.round(track_score(t), 6).alias("score")) for t in C.TRACKS])
    return df.select("student_id", F.inline(arr))


@register("recommend_track")
def q_recommend(spark, sf):
    return sc(spark, sf).select("student_id", recommend_track().alias("recommended_track"))


@register("sanitize_token")
def q_sanitize(spark, sf):
    df = sl(spark, sf)
    return df.select("student_id", T.sanitize_token("interest").alias("interest_token"),
                     T.sanitize_token("recommended_track").alias("track_token"))


@register("profile_items")
def q_profile_items(spark, sf):
    df = sl(spark, sf)
    return df.select("student_id", F.concat_ws("|", F.array_sort(B.profile_items())).alias("items"))


@register("transactions")
def q_transactions(spark, sf):
    df = sl(spark, sf)
    return df.select("student_id", F.concat_ws("|", B.transaction_items()).alias("items"))


@register("feature_target_split")
def q_feature_target(spark, sf):
    return sl(spark, sf).select("student_id", *C.FEATURES, C.TARGET)


@register("relabel_values")
def q_relabel(spark, sf):
    df = sl(spark, sf)
    short = {t["track"]: t["short"] for t in C.TRACKS}
    g = df.select("student_id", "recommended_track", *C.GRADE_COLS) \
          .unpivot(["student_id", "recommended_track"], C.GRADE_COLS, "course", "grade")
    return g.select("student_id", T.relabel("course", C.COURSE_LABELS).alias("course_label"),
                    T.relabel("recommended_track", short, title_unknown=False).alias("track_short"), "grade")
