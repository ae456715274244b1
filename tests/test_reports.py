"""The text report line by line against a plain rendering, its file, and the dashboard of an empty table."""

import glob
import textwrap

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quarry import config as C
from quarry.operators.features import label_index
from quarry.plans import clean as CL
from quarry.plans import report as RP
from quarry.plans.derived import sc, sl, sr
from quarry.plans.q_quality import dashboard_summary
from quarry.sources.csv_text import read_or_empty


def rendered(log, passed, students, source_columns, columns):
    """The report in plain Python, from the rows of the tables it is made of."""
    number = lambda n: f"{n:,}"
    before, after = log[0]["rows_before"], log[-1]["rows_after"]
    out = ["=" * 72, "  STUDENT RECORDS - DATA PREPROCESSING REPORT", "  Generated : 2001-02-03 04:05:06", "=" * 72, "", "OVERVIEW", "--------",
           f"  Input            : {number(before)} rows x {source_columns} columns", f"  Output           : {number(after)} rows x {columns} columns",
           f"  Rows removed     : {number(before - after)} ({(before - after) / before * 100:.1f}%)", "  Overall status   : " + ("CLEAN OK" if passed else "SEE WARNINGS"),
           "", "STEP SUMMARY", "------------", f"{'Step':<5} {'Title':<38} {'Rows Before':>11} {'Rows After':>10} {'Changed':>9}", "-" * 78]
    out += [f"{r['step']:<5} {r['title']:<38} {number(r['rows_before']):>11} {number(r['rows_after']):>10} {number(r['rows_affected']):>9}" for r in log]
    out += ["", "STEP DETAILS", "------------"]
    for r in log:
        out += ["", f"-- Step {r['step']}: {r['title']} {'-' * max(0, 60 - len(r['title']))}", f"   Action  : {r['action']}",
                f"   Before  : {number(r['rows_before'])} rows", f"   After   : {number(r['rows_after'])} rows"]
        out += [f"   Changed : {number(r['rows_affected'])}"] if r["rows_affected"] else []
        out += [f"   Note    : {x}" for x in textwrap.wrap(r["notes"], 72)]
    gpa = [s["gpa"] for s in students]
    out += ["", "FINAL DATASET PROFILE", "---------------------", f"  Total students     : {number(len(students))}", f"  Columns            : {columns}",
            f"  Missing cells      : {sum(s[c] is None for s in students for c in C.CLEAN_ORDER)}",
            f"  GPA range          : {min(gpa):.2f} - {max(gpa):.2f}", f"  GPA mean           : {sum(gpa) / len(gpa):.2f}"]
    for g in ("math_grade", "ai_grade", "programming_grade"):
        v = [s[g] for s in students]
        out.append(f"  {g:<26} mean={sum(v) / len(v):.1f}  min={min(v)}  max={max(v)}")
    for title, field in (("  Track distribution:", "recommended_track"), ("  Interest distribution:", "interest")):
        counts = {}
        for s in students:
            counts[s[field]] = counts.get(s[field], 0) + 1
        lines = [(-n, f"    {k:<30} {n:>5}  ({n / len(students) * 100:>5.1f}%)") for k, n in counts.items()]
        out += ["", title, *(x for _, x in sorted(lines))]
    return [*out, "", "=" * 72]


def test_report_lines_and_file(spark, sf, tmp_path):
    raw = sr(spark, sf)
    log, validation = RP.step_log(CL.audit_counters(raw)), CL.validate_clean(sc(spark, sf))
    lines = RP.report_lines(log, validation, sl(spark, sf), len(raw.columns) - 1, generated="2001-02-03 04:05:06")
    got = [r["line"] for r in lines.orderBy("line_no").collect()]
    steps = [r.asDict() for r in log.orderBy("step").collect()]
    assert [r["step"] for r in steps] == list(range(1, 14))
    students = [r.asDict() for r in sl(spark, sf).collect()]
    assert got == rendered(steps, validation.first()["passed"], students, len(raw.columns) - 1, len(C.CLEAN_ORDER))
    RP.write_report(lines, str(tmp_path / "report"))
    files = glob.glob(str(tmp_path / "report" / "part-*"))
    assert len(files) == 1 and open(files[0], encoding="utf-8").read().split("\n")[:-1] == got


def test_step_details_wrap_long_notes(spark):
    notes = "word " * 40 + "x" * 70 + " end"
    log = spark.createDataFrame([(3, "T", "A", 5, 5, 0, notes), (4, "U" * 70, "B", 1200, 7, 1193, "")], "step int, title string, action string, rows_before long, rows_after long, rows_affected long, notes string")
    got = {}
    for r in RP.step_details(log).orderBy("step", "k").collect():
        got.setdefault(r["step"], []).append(r["line"])
    assert [x for x in got[3] if "Note" in x][:3] == [f"   Note    : {x}" for x in textwrap.wrap(notes, 72)[:3]]
    assert not any("Changed" in x for x in got[3]) and "   Changed : 1,193" in got[4] and got[4][1] == "-- Step 4: " + "U" * 70 + " "


def test_dashboard_of_a_table_that_is_not_there(spark, sf, tmp_path):
    schema = sl(spark, sf).schema
    empty = read_or_empty(spark, str(tmp_path / "none"), schema)
    assert empty.schema == schema and empty.count() == 0
    cards = {(r["card"], r["key"]): r["value"] for r in dashboard_summary(empty).collect()}
    assert cards["total_students", "all"] == 0 and cards["failed_rate", "all"] is None
    assert not any(c in ("track_count", "interest_count", "avg_gpa") for c, _ in cards)
    assert RP.dataset_profile(empty).where("section <> 'summary'").count() == 0
    sl(spark, sf).limit(3).write.parquet(str(tmp_path / "some"))
    assert read_or_empty(spark, str(tmp_path / "some"), schema).count() == 3
    (tmp_path / "bad").mkdir()
    with pytest.raises(AnalysisException):  # there, but no table
        read_or_empty(spark, str(tmp_path / "bad"), schema)


def test_label_index_of_many_labels(spark):
    df = spark.range(5000).select(F.format_string("l%04d", F.col("id") % 1700).alias("label_name"), "id").unionByName(spark.createDataFrame([(None, 9)], "label_name string, id long"))
    got = label_index(df, "label_name").collect()
    assert len(got) == 5000 and all(int(r["label_name"][1:]) == r["label"] for r in got)
