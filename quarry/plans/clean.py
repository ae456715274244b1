"""The cleaning job: raw text student records -> typed clean table.

Logical steps (as in the original pipeline): literal-nan to null; drop
unexpected columns; normalise names; drop whole-row duplicates; normalise ids
and keep the first row per id; parse/null/median-fill/clip/round gpa and the
eight grades; standardise interest; recompute flags and counts; repair the
``failed_courses`` no-value encoding; order and type columns; validate.

Physical plan, Spark-first:

* Rows are dealt into parts of bounded bytes, then the two dedupes collapse into
  ONE shuffle.  The row kept for a cleaned id
  is the earliest raw row carrying that id: that row is always the first of
  its own whole-row duplicate group, so it survives the whole-row dedupe and
  then wins the id dedupe.  ``row_number()==1`` per id is planned with a
  partial WindowGroupLimit (map-side top-1), so even a hot id such as
  ``UNKNOWN`` holding a third of the rows ships one row per map task.
* The deduplicated, parsed rows are written once to the shared folder.  The
  nine medians are one aggregate over that table, read as one scalar
  subquery; the clean projection reads the same table.
* Audit counters for the step log are one more aggregate over that table; the
  raw row, blank and distinct counts come from one aggregate over the input.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.numeric import clip, out_of_range, round_half_even
from quarry.functions.text import (grade_stages, is_nonnumeric_text, is_null_token,
                                   with_normalized_id, parse_gpa, parse_grade_from, py_strip,
                                   strip_unit_suffix, with_standardized_category)
from quarry.operators.dedupe import keep_first
from quarry.operators.impute import column_medians
from quarry.session import hand_off
from quarry.operators.schema import (drop_unexpected_columns, nan_literals_to_null,
                                     normalize_column_names)

ORDER_COL = "row_order"
RAW_PREFIX = "_raw_"

CLEAN_TYPES = {"gpa": "double", **{g: "int" for g in C.GRADE_COLS},
               **{c: "int" for c in C.COUNT_COLS},
               **{c: "int" for c in C.PASSED_COLS + C.FAILED_COLS}}


def load_stage(raw: DataFrame) -> tuple[DataFrame, list[str]]:
    """Steps 1-3: literal nan -> null, whitelist columns, normalise names."""
    data_cols = [c for c in raw.columns if c != ORDER_COL]
    df = nan_literals_to_null(raw, data_cols)
    df, dropped = drop_unexpected_columns(df, C.CLEAN_ORDER, keep=(ORDER_COL,))
    return normalize_column_names(df), dropped


def dedupe_stage(df: DataFrame) -> DataFrame:
    """Steps 4-5: keep the earliest row of each cleaned id.  The raw id text
    is kept beside the cleaned one.  Each task sorts its rows by id before the
    shuffle, so the rows are first dealt into parts of bounded bytes: a scan's
    task reads up to 128 MB of a table that is packed many times smaller."""
    df = df.hint("rebalance", ORDER_COL).withColumn(RAW_PREFIX + "student_id", F.col("student_id"))
    df = with_normalized_id(df, "student_id", "student_id")
    return keep_first(df, "student_id", ORDER_COL)


def parse_stage(df: DataFrame, keep_sign: bool = False) -> DataFrame:
    """Parse gpa and grades; keep raw text (``_raw_*``), parsed value
    (``_p_*``) and the value with impossible entries nulled (``_n_*``).
    Shared sub-expressions (stripped text, text without unit) are staged as
    their own columns so each regex runs once per cell."""
    lo_g, hi_g = C.GPA_RANGE
    lo, hi = C.GRADE_RANGE
    s1 = df.select("*", F.col("gpa").alias(RAW_PREFIX + "gpa"),
                   *[F.col(g).alias(RAW_PREFIX + g) for g in C.GRADE_COLS],
                   *[grade_stages(g)[0].alias("_t_" + g) for g in C.GRADE_COLS])
    s2 = s1.select("*", *[strip_unit_suffix("_t_" + g).alias("_s_" + g) for g in C.GRADE_COLS])
    s3 = s2.select("*", parse_gpa("gpa", keep_sign=keep_sign).alias("_p_gpa"),
                   *[parse_grade_from(F.col(g), F.col("_t_" + g), F.col("_s_" + g)).alias("_p_" + g)
                     for g in C.GRADE_COLS])
    s3 = s3.drop(*[f"_t_{g}" for g in C.GRADE_COLS], *[f"_s_{g}" for g in C.GRADE_COLS])
    nulled = [F.when(out_of_range("_p_gpa", lo_g, hi_g), F.lit(None).cast("double"))
              .otherwise(F.col("_p_gpa")).alias("_n_gpa")]
    nulled += [F.when(out_of_range("_p_" + g, lo, hi), F.lit(None).cast("double"))
               .otherwise(F.col("_p_" + g)).alias("_n_" + g) for g in C.GRADE_COLS]
    return s3.select("*", *nulled)


def _filled(med: Column, name: str, lo: float, hi: float, digits: int) -> Column:
    med = round_half_even(med, digits)
    return round_half_even(clip(F.coalesce(F.col("_n_" + name), med), lo, hi), digits)


def median_scalars(parsed: DataFrame, names: list[str], approx: bool = False) -> tuple[DataFrame, dict[str, Column]]:
    """All medians from ONE aggregate, as fields of the column ``_med``: the
    plan holds one scalar subquery however often a median is used."""
    cols = ["_n_" + n for n in names]
    packed = column_medians(parsed, cols, approx).select(F.struct(*cols).alias("m")).scalar()
    return parsed.withColumn("_med", packed), {n: F.col("_med")["_n_" + n] for n in names}


def finish_stage(parsed: DataFrame, approx_median: bool = False,
                 keep_audit: bool = False) -> DataFrame:
    """Steps 6-12: fill and round numerics, standardise interest, recompute
    flags/counts, repair failed_courses, order and type the columns."""
    lo_g, hi_g = C.GPA_RANGE
    lo, hi = C.GRADE_RANGE
    parsed, med = median_scalars(parsed, ["gpa"] + C.GRADE_COLS, approx_median)
    cols: dict[str, Column] = {"gpa": _filled(med["gpa"], "gpa", lo_g, hi_g, 2)}
    for g in C.GRADE_COLS:
        cols[g] = _filled(med[g], g, lo, hi, 0).cast("int")
    stage = parsed.select("*", *[v.alias("_c_" + k) for k, v in cols.items()])
    stage = with_standardized_category(stage, "interest", "_c_interest")
    grade = {g: F.col("_c_" + g) for g in C.GRADE_COLS}

    out: dict[str, Column] = {"student_id": F.col("student_id"), "gpa": F.col("_c_gpa")}
    for g in C.GRADE_COLS:
        out[g] = grade[g]
    out["interest"] = F.col("_c_interest")
    out["passed_courses"] = F.col("passed_courses")
    passed = {k: (grade[f"{k}_grade"] >= C.PASS_MARK).cast("int") for k in C.COURSE_KEYS}
    failed = {k: (grade[f"{k}_grade"] < C.PASS_MARK).cast("int") for k in C.COURSE_KEYS}
    failed_count = reduce(add, failed.values())
    fc = F.col("failed_courses")
    fixed_fc = F.when(is_null_token(fc), F.lit("None")).otherwise(fc)
    out["failed_courses"] = F.when(failed_count == 0, F.lit("None")).otherwise(fixed_fc)
    out["passed_count"] = reduce(add, passed.values())
    out["failed_count"] = failed_count
    out["excellent_count"] = reduce(add, [(grade[g] >= C.EXCELLENT_MARK).cast("int") for g in C.GRADE_COLS])
    out["weak_count"] = reduce(add, [(grade[g] < C.GOOD_MARK).cast("int") for g in C.GRADE_COLS])
    for k in C.COURSE_KEYS:
        out[f"{k}_passed"] = passed[k]
    for k in C.COURSE_KEYS:
        out[f"{k}_failed"] = failed[k]
    if "recommended_track" in parsed.columns:
        out["recommended_track"] = F.col("recommended_track")

    typed = [v.cast(CLEAN_TYPES[k]).alias(k) if k in CLEAN_TYPES else v.alias(k)
             for k, v in out.items()]
    extra = [F.col(ORDER_COL)]
    if keep_audit:
        extra += [F.col(c) for c in stage.columns
                  if c.startswith((RAW_PREFIX, "_p_", "_n_"))]
        extra += [F.col(c).alias(RAW_PREFIX + c) for c in
                  ["interest", "failed_courses"] + C.PASSED_COLS]
    return stage.select(*typed, *extra)


def clean_students(raw: DataFrame, approx_median: bool = False, keep_sign: bool = False,
                   keep_order: bool = True, keep_audit: bool = False) -> DataFrame:
    """The full cleaning job (V1).  The deduplicated and parsed rows are
    written once: the medians and the finishing pass both read them, so there
    is one scan, one dedupe shuffle and one parse."""
    df, _ = load_stage(raw)
    parsed = hand_off(parse_stage(dedupe_stage(df), keep_sign=keep_sign), "parsed")
    clean = finish_stage(parsed, approx_median=approx_median, keep_audit=keep_audit)
    return clean if keep_order else clean.drop(ORDER_COL)


def clean_columns(df: DataFrame) -> list[str]:
    return [c for c in C.CLEAN_ORDER if c in df.columns]


# ---------------------------------------------------------------------------
# Audit counters, validation, step log
# ---------------------------------------------------------------------------

def validation_counts(clean: DataFrame) -> list[Column]:
    """Five validation counters over a clean table (V2) as aggregate Columns."""
    cols = clean_columns(clean)
    nulls = reduce(add, [F.sum(F.col(c).isNull().cast("long")) for c in cols])
    bad_grades = reduce(add, [F.sum(((F.col(g) < 0) | (F.col(g) > 100)).cast("long"))
                              for g in C.GRADE_COLS])
    bad_gpa = F.sum(((F.col("gpa") < 0) | (F.col("gpa") > 4)).cast("long"))
    bad_interest = F.sum((~F.coalesce(F.col("interest").isin(*C.VALID_INTERESTS),
                                      F.lit(False))).cast("long"))
    flag_issues = reduce(add, [F.sum(((F.col(f"{k}_passed") + F.col(f"{k}_failed")) != 1).cast("long"))
                               for k in C.COURSE_KEYS])
    return [F.coalesce(x, F.lit(0)).cast("long").alias(n) for x, n in
            [(nulls, "null_cells"), (bad_grades, "invalid_grades"), (bad_gpa, "invalid_gpa"),
             (bad_interest, "invalid_interest"), (flag_issues, "flag_violations")]]


def validate_clean(clean: DataFrame) -> DataFrame:
    """V2: one aggregate with the five checks and the overall status."""
    v = clean.agg(F.count(F.lit(1)).cast("long").alias("rows"), *validation_counts(clean))
    ok = ((F.col("null_cells") == 0) & (F.col("invalid_grades") == 0) & (F.col("invalid_gpa") == 0)
          & (F.col("invalid_interest") == 0) & (F.col("flag_violations") == 0))
    return v.withColumn("passed", ok).withColumn(
        "status", F.when(ok, F.lit("PASSED OK")).otherwise(F.lit("WARNINGS (see report)")))


def audit_counters(raw: DataFrame, approx_median: bool = False) -> DataFrame:
    """One-row frame with every counter the step log needs.

    Load-level counters (rows, missing cells, rows after whole-row dedupe) are
    scalar subqueries over the raw input; everything else is one aggregate
    over the deduplicated, audited clean rows."""
    loaded, dropped = load_stage(raw)
    data_cols = [c for c in loaded.columns if c != ORDER_COL]
    raw_cols = len(raw.columns) - (1 if ORDER_COL in raw.columns else 0)
    nan_raw = nan_literals_to_null(raw, [c for c in raw.columns if c != ORDER_COL])
    others = [c for c in raw.columns if c != ORDER_COL and c not in data_cols]
    nulls = lambda cols: reduce(add, [F.col(c).isNull().cast("long") for c in cols], F.lit(0).cast("long"))
    # rows, blank cells and distinct rows from the one aggregate of the exact dedupe
    exact = (nan_raw.select(*data_cols, nulls(others).alias("_other")).groupBy(*data_cols)
             .agg(F.count(F.lit(1)).alias("_n"), F.sum("_other").alias("_other")))
    load = exact.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_loaded"),
                     F.sum(F.col("_n") * nulls(data_cols) + F.col("_other")).alias("missing_at_load"),
                     F.count(F.lit(1)).alias("rows_after_exact")).select(F.struct("*").alias("s")).scalar()

    audited = clean_students(raw, approx_median=approx_median, keep_audit=True)
    lo_g, hi_g = C.GPA_RANGE
    lo, hi = C.GRADE_RANGE
    gpa_out = F.sum(out_of_range("_p_gpa", lo_g, hi_g).cast("long"))
    gpa_missing = F.sum(F.col("_n_gpa").isNull().cast("long"))
    grade_out = reduce(add, [F.sum(out_of_range("_p_" + g, lo, hi).cast("long")) for g in C.GRADE_COLS])
    grade_missing = reduce(add, [F.sum(F.col("_n_" + g).isNull().cast("long")) for g in C.GRADE_COLS])
    grade_text = reduce(add, [F.sum(is_nonnumeric_text(RAW_PREFIX + g).cast("long")) for g in C.GRADE_COLS])
    ri = F.col(RAW_PREFIX + "interest")
    noncanon = F.sum((ri.isNotNull() & ~ri.isin(*C.VALID_INTERESTS)).cast("long"))
    flags_fixed = reduce(add, [
        F.sum((F.coalesce(py_strip(RAW_PREFIX + p), F.lit("nan")) != F.col(p).cast("string")).cast("long"))
        for p in C.PASSED_COLS])
    none_fixed = F.sum(is_null_token(RAW_PREFIX + "failed_courses").cast("long"))
    aggs = [F.count(F.lit(1)).cast("long").alias("rows_clean"),
            gpa_out.alias("gpa_outliers"), gpa_missing.alias("gpa_missing"),
            grade_out.alias("grade_outliers"), grade_missing.alias("grade_missing"),
            grade_text.alias("grade_text"), noncanon.alias("interest_noncanonical"),
            flags_fixed.alias("flags_fixed"), none_fixed.alias("none_fixed"),
            *validation_counts(audited.select(*clean_columns(audited)))]
    counters = audited.agg(*aggs)
    longs = [c for c in counters.columns]
    counters = counters.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in longs])
    return counters.withColumn("_load", load).select(
        F.col("_load.rows_loaded").cast("long").alias("rows_loaded"),
        F.lit(raw_cols).cast("long").alias("cols_loaded"),
        F.col("_load.missing_at_load").cast("long").alias("missing_at_load"),
        F.lit(len(data_cols)).cast("long").alias("cols_kept"),
        F.lit(repr(dropped) if dropped else "none").alias("dropped_columns"),
        F.col("_load.rows_after_exact").cast("long").alias("rows_after_exact"),
        *longs)
