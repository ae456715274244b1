"""Oracle SQL for sources, schema operators, parsers and the cleaning job."""

from __future__ import annotations

from oracle.catalog import oracle
from oracle.sql import (GRADES, KEYS, NONE_SQL, DATA_COLS, band_sql, gpa_parse, grade_parse,
                        in_list, interest_std, nan_null, norm_id, q, recommend_sql, rnd, score_sql,
                        strip, token_sql, with_ctes)
from quarry import config as C

SR = with_ctes("sr")
SC = with_ctes("sc")
SL = with_ctes("sl")
CLEAN_COLS = [c for c in C.CLEAN_ORDER if c != "recommended_track"]
SR_COLS = ["row_order"] + DATA_COLS + ["extra_info"]


def grades_long(src: str = "sr", id_col: str = "row_order") -> str:
    return " UNION ALL ".join(f"SELECT {id_col}, {q(g)} AS course, {g} AS raw FROM {src}" for g in GRADES)


def clean_long(src: str = "sc") -> str:
    return " UNION ALL ".join(f"SELECT student_id, {q(g)} AS course, {g} AS grade FROM {src}" for g in GRADES)


# -- sources / schema --------------------------------------------------------
oracle("scan_text_csv", SR + f"SELECT {', '.join(SR_COLS)} FROM sr")
oracle("scan_clean", SC + f"SELECT {', '.join(CLEAN_COLS)} FROM sc")
oracle("historical_projection", SL + "SELECT student_id, gpa, interest, recommended_track, "
       + ", ".join(GRADES) + ", failed_courses FROM sl")
oracle("drop_unexpected_columns", SR + "SELECT " + ", ".join(c for c in SR_COLS if c != "extra_info") + " FROM sr")
oracle("normalize_column_names",
       "SELECT n_nationkey AS n_nationkey, n_name AS n_name, n_regionkey AS n_regionkey FROM nation")
oracle("canonical_order", SC + f"SELECT {', '.join(CLEAN_COLS)} FROM sc")
oracle("enforce_types", SC + f"SELECT {', '.join(CLEAN_COLS)} FROM sc")
oracle("union_all", "SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL "
       "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 20 = 0")
oracle("literal_nan_to_null", SR + "SELECT row_order, "
       + ", ".join(f"{nan_null(c)} AS {c}" for c in DATA_COLS + ["extra_info"]) + " FROM sr")

# -- parsers -----------------------------------------------------------------
oracle("normalize_id", SR + f"SELECT row_order, student_id AS raw, {norm_id('student_id')} AS student_id FROM sr")
oracle("parse_gpa", SR + f"SELECT row_order, gpa AS raw, {gpa_parse(nan_null('gpa'))} AS gpa FROM sr")
oracle("parse_grade", SR + f"SELECT row_order, course, raw, {grade_parse(nan_null('raw'))} AS grade "
       f"FROM ({grades_long()}) t")
oracle("strip_unit_suffix", SR + "SELECT row_order, course, "
       + strip(rf"regexp_replace(lower({strip('raw')}), '\s*(pts?|points?|marks?|/100|%)\s*$', '')")
       + f" AS stripped FROM ({grades_long()}) t")
WORDS = " ".join(f"WHEN {q(w)} THEN CAST({n} AS DOUBLE)" for w, n in C.WORD_TO_NUMBER.items())
oracle("word_to_number", SR + f"SELECT row_order, course, CASE lower({strip('raw')}) {WORDS} END AS number "
       f"FROM ({grades_long()}) t")
TOK = f"coalesce(lower({strip('raw')}) IN {NONE_SQL}, false)"
oracle("null_tokens", SR + f"SELECT row_order, raw, {TOK} AS is_token, "
       f"CASE WHEN {TOK} THEN 'None' ELSE raw END AS encoded "
       f"FROM (SELECT row_order, {nan_null('failed_courses')} AS raw FROM sr) t")
oracle("standardize_category", SR + f"SELECT row_order, interest AS raw, {interest_std(nan_null('interest'))} AS interest FROM sr")

_DIG = r"[0-9](?:_?[0-9])*"
PYFLOAT = rf"[+-]?(?:{_DIG}(?:\.(?:{_DIG})?)?|\.{_DIG})(?:[eE][+-]?{_DIG})?"


def coerce(x: str) -> str:
    t = strip(x)
    return (f"CASE WHEN regexp_full_match(lower({t}), '[+-]?nan') THEN NULL "
            f"WHEN regexp_full_match(lower({t}), '[+-]?(?:inf|infinity)') THEN "
            f"(CASE WHEN starts_with({t}, '-') THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END) "
            f"WHEN regexp_full_match({t}, '{PYFLOAT}') THEN TRY_CAST(replace({t}, '_', '') AS DOUBLE) "
            "ELSE NULL END")


oracle("coerce_numeric", SR + f"SELECT row_order, course, {coerce('raw')} AS value FROM ({grades_long()}) t")
oracle("nullify_outliers", SR + "SELECT row_order, course, parsed, "
       "CASE WHEN parsed < 0 OR parsed > 100 THEN NULL ELSE parsed END AS grade FROM "
       f"(SELECT row_order, course, {grade_parse(nan_null('raw'))} AS parsed FROM ({grades_long()}) t) u")
oracle("out_of_range", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
oracle("clip_values", "SELECT c_custkey, LEAST(5000.0, GREATEST(0.0, c_acctbal)) AS clipped FROM customer")
oracle("round_half_even", "SELECT l_orderkey, l_linenumber, " + rnd("l_extendedprice", 0) + " AS price_0dp, "
       + rnd("l_extendedprice * l_discount", 1) + " AS disc_1dp FROM lineitem")


def clamp_int(x: str) -> str:
    v = f"(CASE WHEN ({coerce(x)}) IS NULL OR isnan({coerce(x)}) THEN 70.0 ELSE {coerce(x)} END)"
    cl = f"LEAST(100.0, GREATEST(0.0, {v}))"
    return f"CAST(CASE WHEN {cl} >= 0 THEN floor({cl}) ELSE ceil({cl}) END AS INTEGER)"


def clamp_float(x: str) -> str:
    v = (f"(CASE WHEN regexp_full_match(lower({strip(x)}), '[+-]?nan') THEN 'nan'::DOUBLE "
         f"WHEN ({coerce(x)}) IS NULL THEN 0.0 ELSE {coerce(x)} END)")
    capped = f"(CASE WHEN isnan({v}) THEN 4.0 ELSE LEAST(4.0, {v}) END)"
    return f"GREATEST(0.0, {capped})"


oracle("clamp_int_input", SR + f"SELECT row_order, course, raw, {clamp_int('raw')} AS grade FROM ({grades_long()}) t")
oracle("clamp_float_input", SR + f"SELECT row_order, gpa AS raw, {clamp_float('gpa')} AS gpa FROM sr")


def safe(x: str, default: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR lower({strip(x)}) IN ('', 'none', 'nan', 'null') "
            f"THEN {q(default)} ELSE {strip(x)} END")


oracle("safe_text", SR + f"SELECT row_order, {safe(nan_null('failed_courses'), 'None')} AS text, "
       f"{safe('interest', 'Undecided')} AS interest FROM sr")
oracle("fallback_choice", SR + f"SELECT row_order, CASE WHEN interest IN {in_list(C.INTEREST_OPTIONS)} "
       "THEN interest ELSE 'Undecided' END AS interest FROM sr")

# -- cleaning job ------------------------------------------------------------
oracle("clean_students", SC + f"SELECT {', '.join(CLEAN_COLS)} FROM sc")
LOADED = "SELECT row_order, " + ", ".join(f"{nan_null(c)} AS {c}" for c in DATA_COLS) + " FROM sr"
oracle("dedupe_exact", SR + f"SELECT {', '.join(DATA_COLS)}, min(row_order) AS row_order FROM ({LOADED}) t GROUP BY ALL")
oracle("dedupe_key_keep_first", SR + f"SELECT row_order, student_id FROM (SELECT min(row_order) AS row_order, "
       f"{norm_id('student_id')} AS student_id FROM ({LOADED}) t GROUP BY {', '.join(DATA_COLS)}) u "
       "QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY row_order) = 1")
oracle("row_position", "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) "
       "AS position FROM orders")
oracle("clean_numeric_columns", SC + "SELECT student_id, gpa, " + ", ".join(GRADES) + " FROM sc")
oracle("pass_fail_flags", SC + "SELECT student_id, " + ", ".join(C.PASSED_COLS + C.FAILED_COLS) + " FROM sc")
oracle("row_counts", SC + "SELECT student_id, "
       + " + ".join(C.PASSED_COLS) + " AS passed_count, " + " + ".join(C.FAILED_COLS) + " AS failed_count, "
       + " + ".join(f"CAST({g} >= 85 AS INTEGER)" for g in GRADES) + " AS excellent_count, "
       + " + ".join(f"CAST({g} < 70 AS INTEGER)" for g in GRADES) + " AS weak_count FROM sc")
oracle("failed_courses_fix", SC + "SELECT student_id, failed_courses, failed_count FROM sc")
oracle("auto_gpa", SC + "SELECT student_id, " + rnd("((" + " + ".join(f"CAST({g} AS DOUBLE)" for g in GRADES)
                                                     + ") / 8.0) / 25.0", 2) + " AS auto_gpa FROM sc")
LEVEL = "CASE WHEN grade >= 85 THEN 'excellent' WHEN grade >= 70 THEN 'good' WHEN grade >= 60 THEN 'pass' ELSE 'failed' END"
oracle("grade_level", SC + f"SELECT student_id, course, grade, {LEVEL} AS level FROM ({clean_long()}) t")
ITEMLBL = "CASE course " + " ".join(f"WHEN {q(g)} THEN {q(C.ITEM_LABELS[g])}" for g in GRADES) + " END"
oracle("grade_band", SC + f"SELECT student_id, course, {band_sql('grade')} || '_' || {ITEMLBL} AS item "
       f"FROM ({clean_long()}) t")


def course_list(pred_fmt: str, first_n: int | None = None, cols=None) -> str:
    cols = cols or GRADES
    arr = "list_filter([" + ", ".join(f"CASE WHEN {pred_fmt.format(g=g)} THEN {q(C.COURSE_LABELS[g])} END"
                                      for g in cols) + "], lambda x: x IS NOT NULL)"
    if first_n:
        arr = f"{arr}[1:{first_n}]"
    return arr


oracle("join_course_list", SC + "SELECT student_id, "
       f"array_to_string({course_list('{g} >= 60')}, '|') AS passed_list, "
       f"CASE WHEN len({course_list('{g} < 60')}) = 0 THEN 'None' ELSE array_to_string({course_list('{g} < 60')}, '|') END "
       "AS failed_list FROM sc")
oracle("threshold_course_lists", SC + "SELECT student_id, "
       f"array_to_string({course_list('{g} < 60')}, '|') AS failed, "
       f"array_to_string({course_list('{g} < 70', 3)}, '|') AS weak_first3, "
       f"array_to_string({course_list('({g} >= 60 AND {g} < 70)')}, '|') AS weak_not_failed, "
       f"array_to_string({course_list('{g} >= 80', 4)}, '|') AS strong_first4 FROM sc")
oracle("track_scores", SC + " UNION ALL ".join(
    f"SELECT student_id, {q(t['track'])} AS track, round({score_sql(t)}, 6) AS score FROM sc" for t in C.TRACKS))
oracle("recommend_track", SC + f"SELECT student_id, {recommend_sql()} AS recommended_track FROM sc")
oracle("sanitize_token", SL + f"SELECT student_id, {token_sql('interest')} AS interest_token, "
       f"{token_sql('recommended_track')} AS track_token FROM sl")
PROFILE_ITEMS = ("[" + ", ".join(f"{band_sql(g)} || '_{C.ITEM_LABELS[g]}'" for g in GRADES)
                 + f", 'Interest_' || {token_sql('interest')}, CASE WHEN "
                 + " OR ".join(f"{g} < 60" for g in GRADES)
                 + " THEN 'Has_Failed_Course' ELSE 'No_Failed_Courses' END]")
oracle("profile_items", SL + f"SELECT student_id, array_to_string(list_sort({PROFILE_ITEMS}), '|') AS items FROM sl")
oracle("transactions", with_ctes("bk") + "SELECT student_id, array_to_string(items, '|') AS items FROM bk")
oracle("feature_target_split", SL + "SELECT student_id, " + ", ".join(C.FEATURES + [C.TARGET]) + " FROM sl")
SHORT = "CASE recommended_track " + " ".join(f"WHEN {q(t['track'])} THEN {q(t['short'])}" for t in C.TRACKS) + " END"
CLBL = "CASE course " + " ".join(f"WHEN {q(g)} THEN {q(C.COURSE_LABELS[g])}" for g in GRADES) + " END"
oracle("relabel_values", SL + f"SELECT student_id, {CLBL} AS course_label, {SHORT} AS track_short, grade FROM ("
       + " UNION ALL ".join(f"SELECT student_id, recommended_track, {q(g)} AS course, {g} AS grade FROM sl"
                            for g in GRADES) + ") t")
