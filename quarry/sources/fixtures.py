"""Deterministic derived tables built from the driver's ``customer`` table.

SR  raw dirty student records (all text + ``row_order``), derived from
    customer by integer arithmetic; it grows with ``customer``.
SC  SR after the cleaning job.
SL  SC plus ``recommended_track`` from the track scoring rule.
BK  one basket (11 items) per SL row.

The dirty-value rules are fixture design (see FIXTURES.md section 3); the same
rules are written independently in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import config as C
from quarry.sources.tables import read_table

# Fixture constants (FIXTURES.md section 3): per-course multipliers.
GRADE_P = [3, 7, 11, 13, 17, 19, 23, 29]
GRADE_R = [31, 5, 43, 2, 53, 37, 47, 61]
GRADE_Q = [1, 4, 9, 16, 25, 36, 49, 64]
SEGMENT_INTEREST = {
    "AUTOMOBILE": "AI/ML",
    "BUILDING": "Web Development",
    "FURNITURE": "Networks",
    "HOUSEHOLD": "Data Science",
    "MACHINERY": "Software Engineering",
}
COPY_EVERY = 20        # exact duplicate rows planted where k % 20 == 0
COLLIDE_EVERY = 33     # id-collision rows planted where k % 33 == 1


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(key: Column, cases: dict[int, Column], default: Column) -> Column:
    out = None
    for v, expr in cases.items():
        out = F.when(key == v, expr) if out is None else out.when(key == v, expr)
    return out.otherwise(default)


def raw_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SR: the dirty raw student table (35 text columns incl. ``extra_info``,
    plus ``row_order``), three branches unioned."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    k = F.col("k")
    b = F.abs(F.col("c_acctbal")) * 100
    base = cust.select(
        F.col("c_custkey").alias("k"),
        F.col("c_mktsegment").alias("seg"),
        F.round(b).cast("long").alias("b"),
    ).withColumn("q", F.floor(F.col("b") / 71).cast("long"))
    for i in range(8):
        base = base.withColumn(
            f"g{i}", 30 + ((F.col("b") * GRADE_P[i] + F.col("q") * GRADE_R[i] + k * GRADE_Q[i]) % 71))
    gsum = sum((F.col(f"g{i}") for i in range(1, 8)), F.col("g0"))
    base = base.withColumn("h", F.floor(gsum / 2).cast("long"))
    gtext = F.concat(_s(F.floor(F.col("h") / 100).cast("long")), F.lit("."),
                     F.lpad(_s(F.col("h") % 100), 2, "0"))
    n = F.when(F.length(_s(k)) < 7, F.lpad(_s(k), 7, "0")).otherwise(_s(k))   # lpad cuts longer keys
    canon = F.create_map(*[x for s, i in SEGMENT_INTEREST.items() for x in (F.lit(s), F.lit(i))])[F.col("seg")]

    cols = {
        "row_order": k,
        "student_id": _case(k % 6, {
            0: F.concat(F.lit("stu"), n), 1: F.concat(F.lit("STU-"), n),
            2: F.concat(F.lit("STU "), n), 3: _s(k),
            4: F.concat(F.lit("  STU"), n, F.lit("  ")),
        }, F.concat(F.lit("STU"), n, F.lit("#"))),
        "gpa": _case(k % 37, {
            0: F.lit(""), 1: F.lit("N/A"), 2: F.lit("-1.5"), 3: F.lit("9.99"),
            4: F.concat(gtext, F.lit("a")), 5: F.concat(gtext, F.lit("!")), 6: F.lit("3.2.1"),
        }, gtext),
    }
    for i, g in enumerate(C.GRADE_COLS):
        gi = _s(F.col(f"g{i}"))
        cols[g] = _case((k + 7 * i) % 41, {
            0: F.lit(""), 1: F.lit("N/A"), 2: F.lit("-999"), 3: F.lit("150"),
            4: F.concat(gi, F.lit("%")), 5: F.concat(gi, F.lit(" pts")),
            6: F.concat(F.lit("  "), gi, F.lit("  ")), 7: F.lit("seventy"),
            8: F.concat(gi, F.lit(".5")), 9: F.lit("seventy-two"),
            10: F.concat(gi, F.lit("/100")),
        }, gi)
    cols["interest"] = _case(k % 13, {
        0: F.lit("UNDECIDED"), 1: F.lower(canon), 2: F.upper(canon),
        3: F.concat(F.lit("  "), canon, F.lit("  ")), 4: F.concat(canon, F.lit("@2024")),
        5: F.lit("Neetworks"), 6: F.lit("Softwre Engineering"), 7: F.lit("datascientist"),
        8: F.lit(""),
    }, canon)
    cols["passed_courses"] = F.lit("Programming|Web Development")
    cols["failed_courses"] = _case(k % 9, {
        0: F.lit("none"), 1: F.lit("N/A"), 2: F.lit("-"), 3: F.lit(""), 4: F.lit("nan"),
    }, F.lit("Mathematics|Networks"))
    cols["passed_count"] = _s(k % 12)
    cols["failed_count"] = _s(k % 9)
    cols["excellent_count"] = F.lit("0")
    cols["weak_count"] = F.lit("0")
    for i, key in enumerate(C.COURSE_KEYS):
        gi = F.col(f"g{i}")
        cols[f"{key}_passed"] = F.when(((k + i) % 31 == 0) | (gi >= 60), F.lit("1")).otherwise(F.lit("0"))
        cols[f"{key}_failed"] = (F.when((k + i) % 31 == 1, F.lit("0"))
                                 .when(gi < 60, F.lit("1")).otherwise(F.lit("0")))
    cols["extra_info"] = F.concat(F.lit("INFO_"), _s(k))

    order = ["row_order"] + [c for c in C.RAW_ORDER if c != "recommended_track"] + ["extra_info"]
    rows = base.select(k, *[cols[c].alias(c) for c in order if c != "row_order"])
    rows = rows.withColumnRenamed("k", "row_order")

    # two order numbers per key: 2k for a row and its copy, 2k + 1 for its collision
    copies = rows.filter(F.col("row_order") % COPY_EVERY == 0)
    plain = rows.unionByName(copies).withColumn("row_order", F.col("row_order") * 2)
    collisions = (rows.filter(F.col("row_order") % COLLIDE_EVERY == 1)
                  .withColumn("student_id", F.concat(F.lit("stu "), _s(F.col("row_order"))))
                  .withColumn("gpa", F.lit("4.0"))
                  .withColumn("row_order", F.col("row_order") * 2 + 1))
    return plain.unionByName(collisions)
