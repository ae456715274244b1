"""DuckDB oracle SQL, written independently of the Spark code.

The derived tables are shared CTE text:
  sr  raw dirty students (from customer, FIXTURES.md section 3)
  sc  clean students (the 13-step cleaning rules, two-step dedupe)
  sl  sc + recommended_track (track scoring rule)
  bk  baskets of sl
Each oracle query is ``with_ctes(...) + final select``.
"""

from __future__ import annotations

from quarry import config as C

GRADES = C.GRADE_COLS
KEYS = C.COURSE_KEYS
P = [3, 7, 11, 13, 17, 19, 23, 29]
R = [31, 5, 43, 2, 53, 37, 47, 61]
Q = [1, 4, 9, 16, 25, 36, 49, 64]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def in_list(vals) -> str:
    return "(" + ", ".join(q(v) for v in vals) + ")"


NONE_SQL = in_list(C.NONE_VARIANTS)
VALID_SQL = in_list(C.VALID_INTERESTS)


def rnd(x: str, d: int) -> str:
    """numpy-style round half even: round_even(x * 10^d) / 10^d on DOUBLE."""
    if d == 0:
        return f"round_even(CAST({x} AS DOUBLE), 0)"
    return f"(round_even(CAST({x} AS DOUBLE) * {10 ** d}.0, 0) / {10 ** d}.0)"


# ---------------------------------------------------------------------------
# SR
# ---------------------------------------------------------------------------

def _sr() -> str:
    gcols = ",\n    ".join(f"30 + ((b*{P[i]} + q*{R[i]} + k*{Q[i]}) % 71) AS g{i}" for i in range(8))
    gsum = " + ".join(f"g{i}" for i in range(8))
    canon = ("CASE seg WHEN 'AUTOMOBILE' THEN 'AI/ML' WHEN 'BUILDING' THEN 'Web Development' "
             "WHEN 'FURNITURE' THEN 'Networks' WHEN 'HOUSEHOLD' THEN 'Data Science' "
             "WHEN 'MACHINERY' THEN 'Software Engineering' END")
    grade_sel = []
    for i, g in enumerate(GRADES):
        gi = f"CAST(g{i} AS VARCHAR)"
        grade_sel.append(
            f"CASE (k + {7 * i}) % 41 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN '-999' "
            f"WHEN 3 THEN '150' WHEN 4 THEN {gi} || '%' WHEN 5 THEN {gi} || ' pts' "
            f"WHEN 6 THEN '  ' || {gi} || '  ' WHEN 7 THEN 'seventy' WHEN 8 THEN {gi} || '.5' "
            f"WHEN 9 THEN 'seventy-two' WHEN 10 THEN {gi} || '/100' ELSE {gi} END AS {g}")
    flag_sel = []
    for i, k in enumerate(KEYS):
        flag_sel.append(f"CASE WHEN (k + {i}) % 31 = 0 OR g{i} >= 60 THEN '1' ELSE '0' END AS {k}_passed")
        flag_sel.append(f"CASE WHEN (k + {i}) % 31 = 1 THEN '0' WHEN g{i} < 60 THEN '1' ELSE '0' END AS {k}_failed")
    raw_cols = ["student_id", "gpa"] + GRADES + ["interest", "passed_courses", "failed_courses",
                                                 "passed_count", "failed_count", "excellent_count",
                                                 "weak_count"] + C.RAW_FLAG_COLS + ["extra_info"]
    rest = ", ".join(c for c in raw_cols if c not in ("student_id", "gpa"))
    return f"""
sr_b AS (
  SELECT c_custkey AS k, c_mktsegment AS seg,
         CAST(ROUND(ABS(c_acctbal) * 100) AS BIGINT) AS b
  FROM customer
), sr_q AS (
  SELECT *, CAST(FLOOR(b / 71) AS BIGINT) AS q FROM sr_b
), sr_g AS (
  SELECT k, seg, b, q,
    {gcols}
  FROM sr_q
), sr_h AS (
  SELECT *, CAST(FLOOR(({gsum}) / 2) AS BIGINT) AS h,
         CASE WHEN k < 1000000 THEN lpad(CAST(k AS VARCHAR), 7, '0') ELSE CAST(k AS VARCHAR) END AS n, {canon} AS canon
  FROM sr_g
), sr_t AS (
  SELECT *, CAST(CAST(FLOOR(h / 100) AS BIGINT) AS VARCHAR) || '.' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') AS gt
  FROM sr_h
), sr_base AS (
  SELECT k AS row_order,
    CASE k % 6 WHEN 0 THEN 'stu' || n WHEN 1 THEN 'STU-' || n WHEN 2 THEN 'STU ' || n
      WHEN 3 THEN CAST(k AS VARCHAR) WHEN 4 THEN '  STU' || n || '  ' ELSE 'STU' || n || '#' END AS student_id,
    CASE k % 37 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN '-1.5' WHEN 3 THEN '9.99'
      WHEN 4 THEN gt || 'a' WHEN 5 THEN gt || '!' WHEN 6 THEN '3.2.1' ELSE gt END AS gpa,
    {", ".join(grade_sel)},
    CASE k % 13 WHEN 0 THEN 'UNDECIDED' WHEN 1 THEN lower(canon) WHEN 2 THEN upper(canon)
      WHEN 3 THEN '  ' || canon || '  ' WHEN 4 THEN canon || '@2024' WHEN 5 THEN 'Neetworks'
      WHEN 6 THEN 'Softwre Engineering' WHEN 7 THEN 'datascientist' WHEN 8 THEN '' ELSE canon END AS interest,
    'Programming|Web Development' AS passed_courses,
    CASE k % 9 WHEN 0 THEN 'none' WHEN 1 THEN 'N/A' WHEN 2 THEN '-' WHEN 3 THEN '' WHEN 4 THEN 'nan'
      ELSE 'Mathematics|Networks' END AS failed_courses,
    CAST(k % 12 AS VARCHAR) AS passed_count, CAST(k % 9 AS VARCHAR) AS failed_count,
    '0' AS excellent_count, '0' AS weak_count,
    {", ".join(flag_sel)},
    'INFO_' || CAST(k AS VARCHAR) AS extra_info
  FROM sr_t
), sr AS (
  SELECT row_order * 2 AS row_order, student_id, gpa, {rest} FROM sr_base
  UNION ALL SELECT row_order * 2, student_id, gpa, {rest} FROM sr_base WHERE row_order % 20 = 0
  UNION ALL SELECT row_order * 2 + 1 AS row_order, 'stu ' || CAST(row_order AS VARCHAR) AS student_id,
    '4.0' AS gpa, {rest}
  FROM sr_base WHERE row_order % 33 = 1
)"""


# ---------------------------------------------------------------------------
# SC
# ---------------------------------------------------------------------------

def norm_id(x: str) -> str:
    text = f"upper(regexp_replace({x}, '[^a-zA-Z0-9]', '', 'g'))"
    digits = f"regexp_extract({text}, '([0-9]+)', 1)"
    num = f"(CASE WHEN ltrim({digits}, '0') = '' THEN '0' ELSE ltrim({digits}, '0') END)"
    return (f"CASE WHEN {x} IS NULL THEN 'UNKNOWN' WHEN {digits} <> '' THEN 'STU' || "
            f"(CASE WHEN length({num}) < 4 THEN lpad({num}, 4, '0') ELSE {num} END) "
            f"WHEN {text} <> '' THEN {text} ELSE 'UNKNOWN' END")


def gpa_parse(x: str) -> str:
    t = f"lower({strip(x)})"
    cleaned = f"regexp_replace({t}, '[^0-9.]', '', 'g')"
    return (f"CASE WHEN {x} IS NULL OR {t} IN {NONE_SQL} THEN NULL "
            rf"WHEN regexp_full_match({cleaned}, '[0-9]+\.?[0-9]*|\.[0-9]+') THEN TRY_CAST({cleaned} AS DOUBLE) "
            "ELSE NULL END")


_DIG = r"[0-9](?:_?[0-9])*"
PYFLOAT = rf"[+-]?(?:{_DIG}(?:\.(?:{_DIG})?)?|\.{_DIG})(?:[eE][+-]?{_DIG})?"


def grade_parse(x: str) -> str:
    t = f"lower({strip(x)})"
    t2 = strip(rf"regexp_replace({t}, '\s*(pts?|points?|marks?|/100|%)\s*$', '')")
    words = " ".join(f"WHEN {q(w)} THEN CAST({n} AS DOUBLE)" for w, n in C.WORD_TO_NUMBER.items())
    return (f"CASE WHEN {x} IS NULL OR {t} IN {NONE_SQL} THEN NULL "
            f"WHEN (CASE {t2} {words} END) IS NOT NULL THEN (CASE {t2} {words} END) "
            f"WHEN regexp_full_match({t2}, '[+-]?nan') THEN NULL "
            f"WHEN regexp_full_match({t2}, '[+-]?(?:inf|infinity)') THEN "
            f"(CASE WHEN starts_with({t2}, '-') THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END) "
            f"WHEN regexp_full_match({t2}, '{PYFLOAT}') THEN TRY_CAST(replace({t2}, '_', '') AS DOUBLE) "
            rf"WHEN regexp_matches({t2}, '^-?[0-9]+(?:\.[0-9]+)?') THEN "
            rf"TRY_CAST(regexp_extract({t2}, '^(-?[0-9]+(?:\.[0-9]+)?)', 1) AS DOUBLE) "
            "ELSE NULL END")


def interest_std(x: str) -> str:
    key = (f"regexp_replace(lower(trim(regexp_replace({x}, '[^a-zA-Z0-9/ ]', '', 'g'))), "
           r"'\s+', ' ', 'g')")
    exact = "CASE " + key + " " + " ".join(f"WHEN {q(v)} THEN {q(c)}" for v, c in C.INTEREST_VARIANTS) + " END"
    prefix = "CASE " + " ".join(
        f"WHEN starts_with({key}, {q(v)}) OR starts_with({q(v)}, left({key}, 6)) THEN {q(c)}"
        for v, c in C.INTEREST_VARIANTS) + " ELSE 'Undecided' END"
    return f"CASE WHEN {x} IS NULL THEN 'Undecided' ELSE coalesce({exact}, {prefix}) END"


def nan_null(c: str) -> str:
    return f"CASE WHEN {c} IN ('nan', 'NaN', 'NAN') THEN NULL ELSE {c} END"


DATA_COLS = [c for c in C.RAW_ORDER if c != "recommended_track"]


def _sc() -> str:
    loaded = ", ".join(f"{nan_null(c)} AS {c}" for c in DATA_COLS)
    dcols = ", ".join(DATA_COLS)
    parsed = [f"{gpa_parse('gpa')} AS p_gpa"] + [f"{grade_parse(g)} AS p_{g}" for g in GRADES]
    nulled = ["CASE WHEN p_gpa < 0 OR p_gpa > 4 THEN NULL ELSE p_gpa END AS n_gpa"] + \
             [f"CASE WHEN p_{g} < 0 OR p_{g} > 100 THEN NULL ELSE p_{g} END AS n_{g}" for g in GRADES]
    meds = [f"{rnd('median(n_gpa)', 2)} AS m_gpa"] + [f"{rnd(f'median(n_{g})', 0)} AS m_{g}" for g in GRADES]
    filled = [f"{rnd('LEAST(4.0, GREATEST(0.0, coalesce(n_gpa, m_gpa)))', 2)} AS gpa"] + \
             [f"CAST({rnd(f'LEAST(100.0, GREATEST(0.0, coalesce(n_{g}, m_{g})))', 0)} AS INTEGER) AS {g}"
              for g in GRADES]
    passed = [f"CAST({g} >= 60 AS INTEGER) AS {k}_passed" for k, g in zip(KEYS, GRADES)]
    failed = [f"CAST({g} < 60 AS INTEGER) AS {k}_failed" for k, g in zip(KEYS, GRADES)]
    fsum = " + ".join(f"CAST({g} < 60 AS INTEGER)" for g in GRADES)
    psum = " + ".join(f"CAST({g} >= 60 AS INTEGER)" for g in GRADES)
    esum = " + ".join(f"CAST({g} >= 85 AS INTEGER)" for g in GRADES)
    wsum = " + ".join(f"CAST({g} < 70 AS INTEGER)" for g in GRADES)
    tok = f"lower({strip('raw_failed_courses')}) IN {NONE_SQL}"
    return f"""
sc_loaded AS (
  SELECT row_order, {loaded} FROM sr
), sc_exact AS (
  SELECT {dcols}, min(row_order) AS row_order FROM sc_loaded GROUP BY ALL
), sc_ided AS (
  SELECT *, {norm_id('student_id')} AS sid FROM sc_exact
), sc_dedup AS (
  SELECT * FROM sc_ided QUALIFY row_number() OVER (PARTITION BY sid ORDER BY row_order) = 1
), sc_parsed AS (
  SELECT *, {", ".join(parsed)} FROM sc_dedup
), sc_nulled AS (
  SELECT *, {", ".join(nulled)} FROM sc_parsed
), sc_meds AS (
  SELECT {", ".join(meds)} FROM sc_nulled
), sc_filled AS (
  SELECT n.row_order, n.sid AS student_id, {", ".join(filled)},
         n.interest AS raw_interest, n.passed_courses, n.failed_courses AS raw_failed_courses
  FROM sc_nulled n, sc_meds m
), sc AS (
  SELECT student_id, gpa, {", ".join(GRADES)},
    {interest_std('raw_interest')} AS interest,
    passed_courses,
    CASE WHEN ({fsum}) = 0 THEN 'None' WHEN {tok} THEN 'None' ELSE raw_failed_courses END AS failed_courses,
    CAST({psum} AS INTEGER) AS passed_count, CAST({fsum} AS INTEGER) AS failed_count,
    CAST({esum} AS INTEGER) AS excellent_count, CAST({wsum} AS INTEGER) AS weak_count,
    {", ".join(passed)}, {", ".join(failed)},
    row_order
  FROM sc_filled
)"""


# ---------------------------------------------------------------------------
# SL and baskets
# ---------------------------------------------------------------------------

def _mean_sql(cols) -> str:
    return "((" + " + ".join(f"CAST({c} AS DOUBLE)" for c in cols) + f") / {float(len(cols))})"


def score_sql(t: dict, interest: str = "interest", gpa: str = "gpa", prefix: str = "") -> str:
    core = [prefix + c for c in t["core"]]
    allc = [prefix + c for c in GRADES]
    fc = " + ".join(f"CAST({c} < 60 AS INTEGER)" for c in core)
    wc = " + ".join(f"CAST({c} < 70 AS INTEGER)" for c in core)
    base = (f"((CAST(0.58 AS DOUBLE) * {_mean_sql(core)}) + (CAST(0.17 AS DOUBLE) * {_mean_sql(allc)}) "
            f"+ ((CAST(0.25 AS DOUBLE) * CAST({gpa} AS DOUBLE)) * CAST(25 AS DOUBLE)))")
    bonus = f"(CASE WHEN {interest} = {q(t['interest'])} THEN 13.0 WHEN {interest} = 'Undecided' THEN 1.0 ELSE 0.0 END)"
    return f"((({base} + {bonus}) - CAST(({fc}) * 18 AS DOUBLE)) - CAST(({wc}) * 4 AS DOUBLE))"


def recommend_sql(interest: str = "interest", gpa: str = "gpa", prefix: str = "") -> str:
    """Argmax with first-track tie-break, as a CASE over pairwise comparisons."""
    scores = [score_sql(t, interest, gpa, prefix) for t in C.TRACKS]
    parts = []
    for i, t in enumerate(C.TRACKS):
        conds = []
        for j in range(len(C.TRACKS)):
            if j < i:
                conds.append(f"{scores[i]} > {scores[j]}")
            elif j > i:
                conds.append(f"{scores[i]} >= {scores[j]}")
        parts.append(f"WHEN {' AND '.join(conds)} THEN {q(t['track'])}")
    return "CASE " + " ".join(parts) + " END"


def _sl() -> str:
    return f"""
sl AS (
  SELECT sc.*, {recommend_sql()} AS recommended_track FROM sc
)"""


def band_sql(g: str) -> str:
    return (f"(CASE WHEN {g} >= 85 THEN 'Excellent' WHEN {g} >= 70 THEN 'Good' "
            f"WHEN {g} < 60 THEN 'Failed' ELSE 'Weak' END)")


def token_sql(x: str) -> str:
    return f"replace(replace({x}, '/', '_'), ' ', '_')"


def _bk() -> str:
    items = [f"{band_sql(g)} || '_{C.ITEM_LABELS[g]}'" for g in GRADES]
    items.append(f"'Interest_' || {token_sql('interest')}")
    items.append("CASE WHEN failed_count > 0 THEN 'Has_Failed_Course' ELSE 'No_Failed_Courses' END")
    items.append(f"'Track_' || {token_sql('recommended_track')}")
    return f"""
bk AS (
  SELECT student_id, row_order, [{", ".join(items)}] AS items FROM sl
)"""


CTE_BUILDERS = {"sr": _sr, "sc": _sc, "sl": _sl, "bk": _bk}
CTE_ORDER = ["sr", "sc", "sl", "bk"]


def with_ctes(upto: str, extra: str = "") -> str:
    """``WITH`` clause holding the derived tables up to ``upto``."""
    names = CTE_ORDER[:CTE_ORDER.index(upto) + 1]
    body = ",".join(CTE_BUILDERS[n]() for n in names)
    if extra:
        body += "," + extra
    return "WITH " + body + "\n"
