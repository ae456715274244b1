"""Oracle SQL for profiling, validation, step log and dashboard aggregates."""

from __future__ import annotations

from oracle.catalog import oracle
from oracle.sql import (DATA_COLS, GRADES, NONE_SQL, VALID_SQL, gpa_parse, grade_parse, nan_null,
                        norm_id, q, rnd, strip, with_ctes)
from quarry import config as C
from quarry.plans import report as RP

SR = with_ctes("sr")
SC = with_ctes("sc")
SL = with_ctes("sl")
RAW_COLS = DATA_COLS + ["extra_info"]
LOADED = "(SELECT row_order, " + ", ".join(f"{nan_null(c)} AS {c}" for c in RAW_COLS) + " FROM sr)"
CLEAN_COLS = [c for c in C.CLEAN_ORDER if c != "recommended_track"]
ANY_NULL = " OR ".join(f"{c} IS NULL" for c in RAW_COLS)
LABEL = "CASE course " + " ".join(f"WHEN {q(g)} THEN {q(C.COURSE_LABELS[g])}" for g in GRADES) + " END"


def nonnum(x: str) -> str:
    return rf"NOT coalesce(regexp_full_match(regexp_replace({x}, '[.\-]', '', 'g'), '[0-9]+'), false)"


oracle("row_reduction", SC + "SELECT CAST((SELECT count(*) FROM sr) AS BIGINT) AS rows_in, "
       "CAST(count(*) AS BIGINT) AS rows_out, CAST((SELECT count(*) FROM sr) - count(*) AS BIGINT) AS rows_removed, "
       + rnd("((SELECT count(*) FROM sr) - count(*)) / (SELECT count(*) FROM sr) * 100.0", 1)
       + " AS pct_removed FROM sc")
oracle("missing_profile", SR + " UNION ALL ".join(
    f"SELECT {q(c)} AS column_name, CAST(sum(CAST({c} IS NULL AS BIGINT)) AS BIGINT) AS missing_cells FROM {LOADED} t"
    for c in RAW_COLS))
oracle("rows_with_missing", SR + f"SELECT row_order FROM {LOADED} t WHERE {ANY_NULL}")
oracle("raw_issue_summary", SR + "SELECT CAST(count(*) AS BIGINT) AS total_rows, "
       f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(RAW_COLS)} FROM {LOADED} d) x) AS BIGINT) AS duplicate_rows, "
       "CAST(" + " + ".join(f"(CASE WHEN sum(CAST({c} IS NULL AS INTEGER)) > 0 THEN 1 ELSE 0 END)" for c in RAW_COLS)
       + " AS BIGINT) AS columns_with_missing, "
       "CAST(" + " + ".join(f"sum(CAST({c} IS NULL AS BIGINT))" for c in RAW_COLS) + " AS BIGINT) AS missing_cells, "
       f"CAST(sum(CAST(({ANY_NULL}) AS BIGINT)) AS BIGINT) AS rows_with_missing FROM {LOADED} t")
oracle("distinct_ids", SR + f"SELECT count(DISTINCT student_id) AS raw_distinct, "
       f"count(DISTINCT {norm_id('student_id')}) AS clean_distinct FROM {LOADED} t")
PN = (f"(SELECT row_order, CASE WHEN g < 0 OR g > 4 THEN NULL ELSE g END AS gpa, "
      + ", ".join(f"CASE WHEN {x} < 0 OR {x} > 100 THEN NULL ELSE {x} END AS {x}" for x in GRADES)
      + f" FROM (SELECT row_order, {gpa_parse('gpa')} AS g, "
      + ", ".join(f"{grade_parse(x)} AS {x}" for x in GRADES) + f" FROM {LOADED} l) p)")
oracle("column_medians", SR + "SELECT " + ", ".join(f"round(median({c}), 6) AS {c}" for c in ["gpa"] + GRADES)
       + ", (SELECT round(median(c_acctbal), 6) FROM customer) AS c_acctbal FROM " + PN + " t")
oracle("fill_median", SR + f"SELECT row_order, coalesce(gpa, {rnd(f'(SELECT median(gpa) FROM {PN} z)', 2)}) AS gpa FROM {PN} t")
oracle("noncanonical_count", SR + f"SELECT CAST(sum(CAST(interest IS NOT NULL AND interest NOT IN {VALID_SQL} AS BIGINT)) AS BIGINT) "
       f"AS noncanonical FROM {LOADED} t")
oracle("nonnumeric_count", SR + " UNION ALL ".join(
    f"SELECT {q(g)} AS course, CAST(sum(CAST({nonnum(g)} AS BIGINT)) AS BIGINT) AS text_cells FROM {LOADED} t"
    for g in GRADES))
oracle("null_token_count", SR + f"SELECT CAST(sum(CAST(coalesce(lower({strip('failed_courses')}) IN {NONE_SQL}, false) AS BIGINT)) AS BIGINT) "
       f"AS null_tokens FROM {LOADED} t")

# counters over the deduplicated rows (sc_nulled) and the final table (sc)
VALID_CHECKS = {
    "null_cells": " + ".join(f"sum(CAST({c} IS NULL AS BIGINT))" for c in CLEAN_COLS),
    "invalid_grades": " + ".join(f"sum(CAST({g} < 0 OR {g} > 100 AS BIGINT))" for g in GRADES),
    "invalid_gpa": "sum(CAST(gpa < 0 OR gpa > 4 AS BIGINT))",
    "invalid_interest": f"sum(CAST(NOT coalesce(interest IN {VALID_SQL}, false) AS BIGINT))",
    "flag_violations": " + ".join(f"sum(CAST({k}_passed + {k}_failed <> 1 AS BIGINT))" for k in C.COURSE_KEYS),
}
VALID_SEL = ", ".join(f"CAST(coalesce({v}, 0) AS BIGINT) AS {k}" for k, v in VALID_CHECKS.items())
FLAGS = " + ".join(
    f"sum(CAST(coalesce({strip(f'{k}_passed')}, 'nan') <> CAST(CAST(p_{k}_grade_c >= 60 AS INTEGER) AS VARCHAR) AS BIGINT))"
    for k in C.COURSE_KEYS)
COUNTERS = f"""
sc_loaded2 AS (
  SELECT {", ".join(f"{nan_null(c)} AS {c}" for c in RAW_COLS)} FROM sr
), counters AS (
  SELECT
    (SELECT count(*) FROM sr) AS rows_loaded,
    {len(RAW_COLS)} AS cols_loaded,
    (SELECT {" + ".join(f"sum(CAST({c} IS NULL AS BIGINT))" for c in RAW_COLS)} FROM sc_loaded2) AS missing_at_load,
    {len(DATA_COLS)} AS cols_kept,
    '[''extra_info'']' AS dropped_columns,
    (SELECT count(*) FROM sc_exact) AS rows_after_exact,
    a.*, v.*
  FROM (
    SELECT count(*) AS rows_clean,
      sum(CAST(p_gpa < 0 OR p_gpa > 4 AS BIGINT)) AS gpa_outliers,
      sum(CAST(n_gpa IS NULL AS BIGINT)) AS gpa_missing,
      {" + ".join(f"sum(CAST(p_{g} < 0 OR p_{g} > 100 AS BIGINT))" for g in GRADES)} AS grade_outliers,
      {" + ".join(f"sum(CAST(n_{g} IS NULL AS BIGINT))" for g in GRADES)} AS grade_missing,
      {" + ".join(f"sum(CAST({nonnum(g)} AS BIGINT))" for g in GRADES)} AS grade_text,
      sum(CAST(interest IS NOT NULL AND interest NOT IN {VALID_SQL} AS BIGINT)) AS interest_noncanonical,
      {FLAGS} AS flags_fixed,
      sum(CAST(coalesce(lower({strip('failed_courses')}) IN {NONE_SQL}, false) AS BIGINT)) AS none_fixed
    FROM (SELECT n.*, {", ".join(f"f.{g} AS p_{g}_c" for g in GRADES)}
          FROM sc_nulled n JOIN sc f ON n.row_order = f.row_order) x
  ) a, (SELECT {VALID_SEL} FROM sc) v
)"""
CNT = with_ctes("sc", COUNTERS)
oracle("flags_corrected", CNT + "SELECT CAST(flags_fixed AS BIGINT) AS flags_fixed FROM counters")


def _step_sql() -> str:
    rows = []
    n0, n4, n = "rows_loaded", "rows_after_exact", "rows_clean"

    def fmt(t: str, *vals: str) -> str:
        parts = t.split("{}")
        out = q(parts[0])
        for v, p in zip(vals, parts[1:]):
            out += f" || CAST({v} AS VARCHAR) || {q(p)}"
        return out

    act = {s: q(a) for s, _, a in RP.STEP_TEXT if a is not None}
    spec = [
        (1, n0, n0, "0", q("Read 'SR'"), fmt("{} columns, {} missing cells total", "cols_loaded", "missing_at_load")),
        (2, n0, n0, "0", "'Removed: ' || dropped_columns", fmt("Kept {} expected columns", "cols_kept")),
        (3, n0, n0, "0", act[3], q(RP.NOTE_3)),
        (4, n0, n4, "0", act[4], fmt("{} exact duplicate rows dropped", f"({n0} - {n4})")),
        (5, n4, n, "0", act[5], q(RP.NOTE_5)),
        (6, n, n, "gpa_missing + gpa_outliers", act[6], fmt(RP.NOTE_6, "gpa_outliers")),
        (7, n, n, "grade_missing + grade_outliers + grade_text", act[7], fmt(RP.NOTE_7, "grade_outliers")),
        (8, n, n, "interest_noncanonical", act[8], q(RP.NOTE_8)),
        (9, n, n, "flags_fixed", act[9], q(RP.NOTE_9)),
        (10, n, n, "0", act[10], q(RP.NOTE_10)),
        (11, n, n, "none_fixed", act[11], q(RP.NOTE_11)),
        (12, n, n, "0", act[12], "''"),
        (13, n, n, "0", act[13], fmt(RP.NOTE_13, "null_cells", "invalid_grades", "invalid_gpa",
                                     "invalid_interest", "flag_violations")),
    ]
    for step, b, a, cells, action, notes in spec:
        title = q(RP.STEP_TEXT[step - 1][1])
        rows.append(f"SELECT {step} AS step, {title} AS title, {action} AS action, CAST({b} AS BIGINT) AS rows_before, "
                    f"CAST({a} AS BIGINT) AS rows_after, CAST(CASE WHEN {b} <> {a} THEN {b} - {a} ELSE {cells} END AS BIGINT) "
                    f"AS rows_affected, {notes} AS notes FROM counters")
    return " UNION ALL ".join(rows)


oracle("step_log", CNT + _step_sql())
oracle("validate_clean", SC + f"SELECT CAST(count(*) AS BIGINT) AS rows, {VALID_SEL}, "
       "(" + " AND ".join(f"coalesce({v}, 0) = 0" for v in VALID_CHECKS.values()) + ") AS passed, "
       "CASE WHEN " + " AND ".join(f"coalesce({v}, 0) = 0" for v in VALID_CHECKS.values())
       + " THEN 'PASSED OK' ELSE 'WARNINGS (see report)' END AS status FROM sc")
oracle("value_counts", SL + "SELECT 'recommended_track' AS field, recommended_track AS value, count(*) AS count FROM sl GROUP BY 2 "
       "UNION ALL SELECT 'interest', interest, count(*) FROM sl GROUP BY 2 "
       "UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2")
oracle("value_counts_pct", SL + " UNION ALL ".join(
    f"SELECT {f} AS value, count(*) AS count, {rnd(f'count(*) / (SELECT count(*) FROM sl) * 100.0', 1)} AS pct, "
    f"{q(f)} AS field FROM sl GROUP BY {f}" for f in ["recommended_track", "interest"]))
oracle("group_mean", SL + f"SELECT recommended_track AS grp, {rnd('avg(gpa)', 2)} AS mean, 'gpa' AS measure FROM sl GROUP BY 1 "
       f"UNION ALL SELECT c_mktsegment, {rnd('avg(c_acctbal)', 2)}, 'c_acctbal' FROM customer GROUP BY 1")
MEANS = " UNION ALL ".join(f"SELECT {q(g)} AS course, {rnd(f'avg({g})', 1)} AS mean FROM sl" for g in GRADES)
oracle("column_means", SL + f"SELECT {LABEL} AS course_label, mean FROM ({MEANS}) t")
oracle("predicate_rate", SL + f"SELECT {rnd('avg(CAST(failed_count > 0 AS DOUBLE)) * 100.0', 1)} AS failed_rate FROM sl")
oracle("column_range_profile", SL + " UNION ALL ".join(
    f"SELECT {q(c)} AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, "
    f"round(avg({c}), 6) AS mean_value FROM sl" for c in ["gpa", "math_grade", "ai_grade", "programming_grade"]))
PROFILE_NAMES = (["total", "gpa_min", "gpa_max", "gpa_mean"]
                 + [f"{g}_{s}" for g in ["math_grade", "ai_grade", "programming_grade"] for s in ("mean", "min", "max")])
PROFILE_EXPR = {"total": "CAST(count(*) AS DOUBLE)", "gpa_min": "min(gpa)", "gpa_max": "max(gpa)", "gpa_mean": "avg(gpa)"}
for g in ["math_grade", "ai_grade", "programming_grade"]:
    PROFILE_EXPR[f"{g}_mean"] = f"avg({g})"
    PROFILE_EXPR[f"{g}_min"] = f"CAST(min({g}) AS DOUBLE)"
    PROFILE_EXPR[f"{g}_max"] = f"CAST(max({g}) AS DOUBLE)"
oracle("dataset_profile", SL + " UNION ALL ".join(
    f"SELECT 'summary' AS section, {q(k)} AS name, round({PROFILE_EXPR[k]}, 6) AS value FROM sl" for k in PROFILE_NAMES)
    + " UNION ALL SELECT 'summary', 'missing_cells', CAST(" + " + ".join(
        f"sum(CAST({c} IS NULL AS BIGINT))" for c in C.CLEAN_ORDER) + " AS DOUBLE) FROM sl"
    + " UNION ALL SELECT 'track', recommended_track, CAST(count(*) AS DOUBLE) FROM sl GROUP BY recommended_track"
    + " UNION ALL SELECT 'interest', interest, CAST(count(*) AS DOUBLE) FROM sl GROUP BY interest"
    + "".join(f" UNION ALL SELECT '{s}_pct', {c}, {rnd('count(*) / (SELECT count(*) FROM sl) * 100.0', 1)} FROM sl GROUP BY {c}" for s, c in (("track", "recommended_track"), ("interest", "interest"))))
DASH = (SL + "SELECT 'total_students' AS card, 'all' AS key, CAST(count(*) AS DOUBLE) AS value FROM sl "
        f"UNION ALL SELECT 'failed_rate', 'all', {rnd('avg(CAST(failed_count > 0 AS DOUBLE)) * 100.0', 1)} FROM sl "
        "UNION ALL SELECT 'track_count', recommended_track, CAST(count(*) AS DOUBLE) FROM sl GROUP BY 2 "
        "UNION ALL SELECT 'interest_count', interest, CAST(count(*) AS DOUBLE) FROM sl GROUP BY 2 "
        f"UNION ALL SELECT 'avg_gpa', recommended_track, {rnd('avg(gpa)', 2)} FROM sl GROUP BY 2 "
        f"UNION ALL SELECT 'avg_grade', {LABEL}, mean FROM ({MEANS}) t")
from oracle.o_rules import BASE  # noqa: E402

oracle("dashboard_summary", DASH.replace(SL, BASE, 1)
       + f" UNION ALL SELECT 'rules_shown', 'all', CAST(count(*) AS DOUBLE) FROM target WHERE rule_rank <= {C.DASHBOARD_RULES}")
oracle("dashboard_percentages", SL + "SELECT 'track_bar' AS bar, recommended_track AS key, "
       f"{rnd('count(*) / (SELECT count(*) FROM sl) * 100.0', 1)} AS width FROM sl GROUP BY 2 "
       f"UNION ALL SELECT 'interest_bar', interest, {rnd('count(*) / (SELECT count(*) FROM sl) * 100.0', 1)} FROM sl GROUP BY 2 "
       f"UNION ALL SELECT 'gpa_bar', recommended_track, {rnd(rnd('avg(gpa)', 2) + ' / 4.0 * 100.0', 1)} FROM sl GROUP BY 2")

oracle("distinct_sketches", "SELECT grp, count(DISTINCT id) AS n_distinct, true AS within FROM ("
       "SELECT o_orderpriority AS grp, o_custkey AS id FROM orders UNION ALL SELECT 'all orders', o_custkey FROM orders "
       "UNION ALL SELECT 'all', o_custkey FROM orders UNION ALL SELECT 'all', c_custkey FROM customer "
       "UNION ALL SELECT 'customers', c_custkey FROM customer) t GROUP BY grp")
oracle("numbered_scan", SR + "SELECT row_order, coalesce(student_id, '') AS student_id, row_number() OVER (ORDER BY row_order) - 1 AS position FROM sr")
