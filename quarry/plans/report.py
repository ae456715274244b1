"""Step log, dataset profile and report text of the cleaning job.

Every number comes from one-row aggregates (``audit_counters``); the 13 step
rows are produced with ``inline`` over that single row, so the log costs no
extra pass over the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.numeric import round_half_even

# ---------------------------------------------------------------------------
# FIXED VALUES: step titles, actions and note texts of the cleaning report
# (must read exactly like the original report).
# ---------------------------------------------------------------------------
STEP_TEXT = [
    (1, "Load dirty dataset", None),
    (2, "Drop junk columns", None),
    (3, "Standardise column names", "Strip, lowercase, underscore"),
    (4, "Remove duplicates", "drop_duplicates() on all columns"),
    (5, "Clean student_id", "Normalise format to STU#### then drop ID duplicates"),
    (6, "Parse & clean GPA", "parse_gpa() -> numeric -> clamp [0,4] -> fill missing with median"),
    (7, "Parse & clean grade columns",
     "parse_grade() -> numeric -> clamp [0,100] -> fill missing with column median"),
    (8, "Standardise interest", "Normalise case, strip whitespace/symbols, map typos to canonical value"),
    (9, "Recompute binary flags",
     "Derive {course}_passed / {course}_failed from cleaned grades (threshold 60)"),
    (10, "Recompute summary counts",
     "passed_count, failed_count, excellent_count, weak_count from cleaned grades"),
    (11, "Standardise None encoding",
     "Map '', 'n/a', 'na', '-', 'null', 'none', 'nan' -> 'None' in failed_courses"),
    (12, "Enforce types & column order",
     "Cast GPA->float, grades->int, binary->int; apply canonical column order"),
    (13, "Final validation", "Check nulls, grade range, GPA range, interest validity, binary flags"),
]
NOTE_3 = "All column names normalised"
NOTE_5 = "Patterns handled: stu-####, STU ####, bare number, trailing # etc."
NOTE_6 = ("String formats handled: '3.45a', '  2.7  ', 'N/A'.  {} outliers (e.g. -1.5, 9.99) "
          "-> NaN then filled.")
NOTE_7 = ("String formats: '85%', '90 pts', 'seventy', 'N/A'.  {} impossible values "
          "(e.g. -999, 150) -> NaN then median-filled.")
NOTE_8 = ("Handled: ai/ml, Ai/Ml, AI ML, Neetworks, Softwre Engineering, Dat Science, "
          "trailing @/# symbols, excess whitespace.")
NOTE_9 = "Eliminates both-1 / both-0 / mismatch corruptions from injection."
NOTE_10 = "All four count columns recomputed deterministically."
NOTE_11 = "Also cross-validated against failed_count to enforce consistency."
NOTE_13 = "Nulls={}, InvalidGrades={}, InvalidGPA={}, InvalidInterest={}, FlagViolations={}"


def _fmt(template: str, *cols: Column) -> Column:
    """Fill ``{}`` slots of a fixed text with column values."""
    parts = template.split("{}")
    out = [F.lit(parts[0])]
    for c, p in zip(cols, parts[1:]):
        out += [c.cast("string"), F.lit(p)]
    return F.concat(*out)


def step_log(counters: DataFrame, source_name: str = "SR") -> DataFrame:
    """13 step rows (step, title, action, rows_before, rows_after,
    rows_affected, notes) from the one-row audit counters."""
    c = F.col
    n0, n4, n = c("rows_loaded"), c("rows_after_exact"), c("rows_clean")

    def row(step, before, after, cells, action, notes):
        title = STEP_TEXT[step - 1][1]
        affected = F.when(before != after, before - after).otherwise(cells)
        return F.struct(F.lit(step).alias("step"), F.lit(title).alias("title"),
                        action.alias("action"), before.cast("long").alias("rows_before"),
                        after.cast("long").alias("rows_after"), affected.cast("long").alias("rows_affected"),
                        notes.alias("notes"))

    zero = F.lit(0).cast("long")
    act = {s: F.lit(a) for s, _, a in STEP_TEXT if a is not None}
    rows = [
        row(1, n0, n0, zero, F.lit(f"Read '{source_name}'"),
            _fmt("{} columns, {} missing cells total", c("cols_loaded"), c("missing_at_load"))),
        row(2, n0, n0, zero, F.concat(F.lit("Removed: "), c("dropped_columns")),
            _fmt("Kept {} expected columns", c("cols_kept"))),
        row(3, n0, n0, zero, act[3], F.lit(NOTE_3)),
        row(4, n0, n4, zero, act[4], _fmt("{} exact duplicate rows dropped", n0 - n4)),
        row(5, n4, n, zero, act[5], F.lit(NOTE_5)),
        row(6, n, n, c("gpa_missing") + c("gpa_outliers"), act[6], _fmt(NOTE_6, c("gpa_outliers"))),
        row(7, n, n, c("grade_missing") + c("grade_outliers") + c("grade_text"), act[7],
            _fmt(NOTE_7, c("grade_outliers"))),
        row(8, n, n, c("interest_noncanonical"), act[8], F.lit(NOTE_8)),
        row(9, n, n, c("flags_fixed"), act[9], F.lit(NOTE_9)),
        row(10, n, n, zero, act[10], F.lit(NOTE_10)),
        row(11, n, n, c("none_fixed"), act[11], F.lit(NOTE_11)),
        row(12, n, n, zero, act[12], F.lit("")),
        row(13, n, n, zero, act[13], _fmt(NOTE_13, c("null_cells"), c("invalid_grades"), c("invalid_gpa"),
                                          c("invalid_interest"), c("flag_violations"))),
    ]
    return counters.select(F.inline(F.array(*rows)))


def dataset_profile(labelled: DataFrame) -> DataFrame:
    """(section, name, value) rows: totals, gpa range/mean, grade profiles,
    track and interest distributions with percentages."""
    n = F.count(F.lit(1))
    base = labelled.agg(
        n.cast("double").alias("total"),
        F.min("gpa").alias("gpa_min"), F.max("gpa").alias("gpa_max"), F.avg("gpa").alias("gpa_mean"),
        *[x for g in ["math_grade", "ai_grade", "programming_grade"] for x in (
            F.avg(g).alias(f"{g}_mean"), F.min(g).cast("double").alias(f"{g}_min"),
            F.max(g).cast("double").alias(f"{g}_max"))],
        sum(F.sum(F.col(c).isNull().cast("long")) for c in C.CLEAN_ORDER if c in labelled.columns)
        .cast("double").alias("missing_cells"))
    names = ["total", "gpa_min", "gpa_max", "gpa_mean"] + [f"{g}_{s}" for g in
                                                           ["math_grade", "ai_grade", "programming_grade"]
                                                           for s in ("mean", "min", "max")] + ["missing_cells"]
    totals = base.select(F.inline(F.array(*[
        F.struct(F.lit("summary").alias("section"), F.lit(k).alias("name"),
                 F.round(F.col(k), 6).alias("value")) for k in names])))
    dists = []
    for field, section in [("recommended_track", "track"), ("interest", "interest")]:
        if field in labelled.columns:
            vc = value_counts_pct(labelled, field)
            figures = F.array(F.struct(F.lit(section).alias("section"), F.col("value").alias("name"), F.col("count").cast("double").alias("value")),
                              F.struct(F.lit(f"{section}_pct").alias("section"), F.col("value").alias("name"), F.col("pct").alias("value")))
            dists.append(vc.select(F.inline(figures)))
    out = totals
    for d in dists:
        out = out.unionByName(d)
    return out


def value_counts_pct(df: DataFrame, field: str) -> DataFrame:
    """(value, count, pct) with pct = count / total * 100 (1 dp, half-even)."""
    total = df.select(F.count(F.lit(1))).scalar()
    vc = df.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return vc.select("value", "count", round_half_even(F.col("count") / total * 100.0, 1).alias("pct"))


def step_details(log: DataFrame) -> DataFrame:
    """(step, k, line): the detail lines of every step; notes wrap at 72."""
    n = lambda c: F.format_number(F.col(c), 0)
    wrapped = F.split(F.regexp_replace(F.col("notes"), r"(.{1,72})(?:\s+|$)", "$1\n"), "\n")
    notes = F.transform(F.filter(wrapped, lambda x: x != ""), lambda x: F.concat(F.lit("   Note    : "), x))
    title = F.concat(F.lit("-- Step "), F.col("step"), F.lit(": "), F.col("title"), F.lit(" "),
                     F.repeat(F.lit("-"), F.greatest(F.lit(0), 60 - F.length("title"))))
    lines = F.concat(
        F.array(F.lit(""), title, F.concat(F.lit("   Action  : "), F.col("action")),
                F.concat(F.lit("   Before  : "), n("rows_before"), F.lit(" rows")),
                F.concat(F.lit("   After   : "), n("rows_after"), F.lit(" rows"))),
        F.when(F.col("rows_affected") != 0, F.array(F.concat(F.lit("   Changed : "), n("rows_affected")))).otherwise(F.array().cast("array<string>")),
        notes)
    return log.select("step", F.posexplode(lines).alias("k", "line"))


def distribution_lines(df: DataFrame, field: str) -> DataFrame:
    """(k, line): values by falling count with their share."""
    counts = value_counts_pct(df, field)
    return counts.select((-F.col("count")).alias("k"), F.format_string(
        "    %-30s %5d  (%5.1f%%)", F.col("value"), F.col("count"), F.col("pct")).alias("line"))


def report_lines(log: DataFrame, validation: DataFrame, labelled: DataFrame, source_columns: int,
                 generated: str = "1970-01-01 00:00:00") -> DataFrame:
    """The text report as ordered ``(line_no, line)`` rows: overview, step
    summary, step details and the profile of the final table.  All inputs but
    ``labelled`` are tiny, and that one is only aggregated."""
    banner, spark = "=" * 72, log.sparkSession
    columns = [c for c in C.CLEAN_ORDER if c in labelled.columns]
    parts: list[DataFrame] = []

    def add(rows: DataFrame) -> None:
        """rows (a, b, line), ordered by a and b within their part."""
        parts.append(rows.select(F.lit(len(parts)).alias("part"), F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), "line"))

    def text(*lines: str) -> None:
        add(spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "a int, b int, line string"))

    n = lambda c: F.format_number(F.col(c), 0)
    text(banner, "  STUDENT RECORDS - DATA PREPROCESSING REPORT", f"  Generated : {generated}", banner, "", "OVERVIEW", "--------")
    ends = log.agg(F.max_by("rows_before", -F.col("step")).alias("rows_in"), F.max_by("rows_after", "step").alias("rows_out")).withColumn("passed", validation.select("passed").scalar())
    share = F.when(F.col("rows_in") > 0, (F.col("rows_in") - F.col("rows_out")) / F.col("rows_in") * 100).otherwise(0.0)
    add(ends.select(F.posexplode(F.array(
        F.concat(F.lit("  Input            : "), n("rows_in"), F.lit(f" rows x {source_columns} columns")),
        F.concat(F.lit("  Output           : "), n("rows_out"), F.lit(f" rows x {len(columns)} columns")),
        F.concat(F.lit("  Rows removed     : "), F.format_number(F.col("rows_in") - F.col("rows_out"), 0), F.format_string(" (%.1f%%)", share)),
        F.concat(F.lit("  Overall status   : "), F.when(F.col("passed"), F.lit("CLEAN OK")).otherwise(F.lit("SEE WARNINGS"))))).alias("a", "line"), F.lit(0).alias("b")))
    text("", "STEP SUMMARY", "------------", f"{'Step':<5} {'Title':<38} {'Rows Before':>11} {'Rows After':>10} {'Changed':>9}", "-" * 78)
    add(log.select(F.col("step").alias("a"), F.lit(0).alias("b"), F.format_string(
        "%-5d %-38s %11s %10s %9s", F.col("step"), F.col("title"), n("rows_before"), n("rows_after"), n("rows_affected")).alias("line")))
    text("", "STEP DETAILS", "------------")
    add(step_details(log).select(F.col("step").alias("a"), F.col("k").alias("b"), "line"))
    text("", "FINAL DATASET PROFILE", "---------------------")
    grades = ["math_grade", "ai_grade", "programming_grade"]
    facts = labelled.agg(
        F.count(F.lit(1)).alias("total"), F.min("gpa").alias("lo"), F.max("gpa").alias("hi"), F.avg("gpa").alias("mean"),
        sum(F.sum(F.col(c).isNull().cast("long")) for c in columns).alias("missing"),
        *[f(g).alias(f"{k}_{g}") for g in grades for k, f in (("avg", F.avg), ("min", F.min), ("max", F.max))])
    add(facts.select(F.posexplode(F.array(
        F.concat(F.lit("  Total students     : "), n("total")), F.lit(f"  Columns            : {len(columns)}"),
        F.concat(F.lit("  Missing cells      : "), F.col("missing").cast("string")),
        F.format_string("  GPA range          : %.2f - %.2f", "lo", "hi"), F.format_string("  GPA mean           : %.2f", "mean"),
        *[F.format_string(f"  {g:<26} mean=%.1f  min=%d  max=%d", f"avg_{g}", f"min_{g}", f"max_{g}") for g in grades])).alias("a", "line"), F.lit(0).alias("b")))
    for title, field in (("  Track distribution:", "recommended_track"), ("  Interest distribution:", "interest")):
        if field in labelled.columns:
            text("", title)
            add(distribution_lines(labelled, field).select(F.col("k").alias("a"), F.lit(0).alias("b"), "line"))
    text("", banner)
    lines = reduce(DataFrame.unionByName, parts)
    return lines.select(F.row_number().over(Window.orderBy("part", "a", "b", "line")).alias("line_no"), "line")   # about a hundred lines


def write_report(lines: DataFrame, path: str) -> None:
    """The report as one text file below ``path``."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)
