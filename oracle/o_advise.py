"""Oracle SQL for lookups, profile features and batch advising."""

from __future__ import annotations

from oracle.catalog import oracle
from oracle.o_rules import MATCH
from oracle.o_clean import clamp_float, clamp_int
from oracle.sql import GRADES, q, recommend_sql, rnd, with_ctes
from quarry import config as C
from quarry.plans import advise as A

SL = with_ctes("sl")
SR = with_ctes("sr")


def key_sql(x: str) -> str:
    return (f"regexp_replace(lower(trim(regexp_replace({x}, '[^a-zA-Z0-9/ ]', '', 'g'))), "
            r"'\s+', ' ', 'g')")


FEATS = ", ".join(
    [f"CAST({' + '.join(f'CAST({g} >= 60 AS INTEGER)' for g in GRADES)} AS INTEGER) AS passed_count",
     f"CAST({' + '.join(f'CAST({g} < 60 AS INTEGER)' for g in GRADES)} AS INTEGER) AS failed_count",
     f"CAST({' + '.join(f'CAST({g} >= 85 AS INTEGER)' for g in GRADES)} AS INTEGER) AS excellent_count",
     f"CAST({' + '.join(f'CAST({g} < 70 AS INTEGER)' for g in GRADES)} AS INTEGER) AS weak_count"]
    + [f"CAST({k}_grade >= 60 AS INTEGER) AS {k}_passed, CAST({k}_grade < 60 AS INTEGER) AS {k}_failed"
       for k in C.COURSE_KEYS])
AUTO = rnd("((" + " + ".join(f"CAST({g} AS DOUBLE)" for g in GRADES) + ") / 8.0) / 25.0", 2)
PROFILE = (f"SELECT student_id, '{C.DEFAULT_ALGORITHM}' AS algorithm, interest, "
           f"CASE WHEN GREATEST(0.0, LEAST(4.0, gpa)) > 0 THEN GREATEST(0.0, LEAST(4.0, gpa)) ELSE {AUTO} END AS gpa, "
           + ", ".join(GRADES) + " FROM sl")

oracle("profile_features", SL + f"SELECT student_id, algorithm, gpa, interest, {', '.join(GRADES)}, {FEATS} "
       f"FROM ({PROFILE}) p")
oracle("align_features", SL + f"SELECT student_id, {', '.join(C.FEATURES)}, 0 AS enrolment_year FROM "
       f"(SELECT student_id, gpa, interest, {', '.join(GRADES)}, {FEATS} FROM ({PROFILE}) p) t")
oracle("membership_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
DIM = "(VALUES " + ", ".join(f"({i}, {q(v)}, {q(c)})" for i, (v, c) in enumerate(C.INTEREST_VARIANTS)) + ") d(priority, variant, canonical)"
oracle("dictionary_lookup", SR + f"SELECT k.key, k.row_order, d.canonical FROM (SELECT row_order, {key_sql('interest')} AS key "
       f"FROM sr) k LEFT JOIN {DIM} ON k.key = d.variant")
PREFIX = "CASE " + " ".join(f"WHEN starts_with(key, {q(v)}) OR starts_with({q(v)}, left(key, 6)) THEN {q(c)}"
                            for v, c in C.INTEREST_VARIANTS) + " END"
oracle("prefix_lookup", SR + f"SELECT row_order, key, {PREFIX} AS canonical FROM (SELECT row_order, {key_sql('interest')} AS key FROM sr) k")
TDIM = "(VALUES " + ", ".join(f"({q(t['track'])}, {q(t['short'])}, {q(t['interest'])}, {q('|'.join(t['electives']))})"
                              for t in C.TRACKS) + ") d(recommended_track, short, track_interest, electives)"
oracle("track_dim_join", SL + f"SELECT s.recommended_track, s.student_id, d.short, d.track_interest, d.electives "
       f"FROM sl s JOIN {TDIM} ON s.recommended_track = d.recommended_track")


def courses(pred: str, cols) -> str:
    return ("list_filter([" + ", ".join(f"CASE WHEN {pred.format(g=g)} THEN {q(C.COURSE_LABELS[g])} END" for g in cols)
            + "], lambda x: x IS NOT NULL)")


def by_track(fn) -> str:
    return "CASE track " + " ".join(f"WHEN {q(t['track'])} THEN {fn(t)}" for t in C.TRACKS) + " END"


def fill(template: str, **vals: str) -> str:
    out, rest = [], template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        out += [q(pre), vals[name]]
    out.append(q(rest))
    return "(" + " || ".join(out) + ")"


STRONG = by_track(lambda t: courses("{g} >= 80", t["core"]))
WEAK = by_track(lambda t: courses("{g} < 70", t["core"]))
WNF = by_track(lambda t: courses("({g} >= 60 AND {g} < 70)", t["core"]))
FAILED = courses("{g} < 60", GRADES)
OWN = by_track(lambda t: q(t["interest"]))
OTHER = "CASE interest " + " ".join(f"WHEN {q(t['interest'])} THEN {q(t['track'])}" for t in C.TRACKS) + " END"
EXPL = ("list_filter([" + ", ".join([
    f"CASE WHEN interest = {OWN} THEN {fill(A.MSG_INTEREST_MATCH, track='track')} "
    f"WHEN interest IS NOT NULL AND interest <> '' AND interest <> 'Undecided' THEN "
    f"(CASE WHEN {OTHER} IS NOT NULL AND {OTHER} <> track THEN {fill(A.MSG_INTEREST_OTHER, other=OTHER, track='track')} END) "
    f"ELSE {q(A.MSG_NO_INTEREST)} END",
    f"CASE WHEN len({STRONG}) > 0 THEN {fill(A.MSG_STRONG, list=f'array_to_string(({STRONG})[1:4], chr(44) || chr(32))')} END",
    f"CASE WHEN len({WEAK}) > 0 THEN {fill(A.MSG_WEAK, list=f'array_to_string(({WEAK})[1:3], chr(44) || chr(32))')} END",
    fill(A.MSG_CONFIDENCE, track="track", prob="CAST(top_prob AS VARCHAR)"),
    f"CASE WHEN first_rule_conf IS NOT NULL THEN {fill(A.MSG_RULES, conf='CAST(first_rule_conf AS VARCHAR)')} END",
]) + "], lambda x: x IS NOT NULL)")
WARN_LIST = ("list_filter([" + ", ".join([
    f"CASE WHEN len({FAILED}) > 0 THEN {fill(A.WARN_FAILED, list=f'array_to_string({FAILED}, chr(44) || chr(32))')} END",
    f"CASE WHEN len({WEAK}) > 0 THEN {fill(A.WARN_WEAK_CORE, list=f'array_to_string({WEAK}, chr(44) || chr(32))')} END",
    f"CASE WHEN track IN ({', '.join(q(x) for x in A.MATH_TRACKS)}) AND math_grade < 70 THEN {q(A.WARN_MATH)} END",
    f"CASE WHEN track IN ({', '.join(q(x) for x in A.PROGRAMMING_TRACKS)}) AND programming_grade < 70 THEN {q(A.WARN_PROGRAMMING)} END",
    f"CASE WHEN track = {q(A.NETWORK_TRACK)} AND networks_grade < 70 THEN {q(A.WARN_NETWORKS)} END",
]) + "], lambda x: x IS NOT NULL)")
WARN = f"(CASE WHEN len({WARN_LIST}) = 0 THEN [{q(A.WARN_NONE)}] ELSE {WARN_LIST} END)"
ADV = (MATCH.rstrip() + f""", prof2 AS ({PROFILE}),
firsts AS (
  SELECT student_id, count(*) AS rules_matched,
    arg_min({rnd('confidence * 100.0', 1)}, rule_rank) AS first_rule_conf
  FROM matched WHERE pos <= {C.RULES_PER_PROFILE} GROUP BY student_id
), adv AS (
  SELECT p.*, {recommend_sql('p.interest', 'p.gpa', 'p.')} AS track, f.rules_matched, f.first_rule_conf,
         CAST(100.0 AS DOUBLE) AS top_prob
  FROM prof2 p LEFT JOIN firsts f ON p.student_id = f.student_id
)
""")
oracle("explain_recommendation", ADV + f"SELECT student_id, CAST(g.i - 1 AS INTEGER) AS line_no, g.x AS line "
       f"FROM adv, LATERAL (SELECT unnest({EXPL}) AS x, generate_subscripts({EXPL}, 1) AS i) g")
oracle("advising_warnings", ADV + f"SELECT student_id, CAST(g.i - 1 AS INTEGER) AS line_no, g.x AS line "
       f"FROM adv, LATERAL (SELECT unnest({WARN}) AS x, generate_subscripts({WARN}, 1) AS i) g")
ELECT = by_track(lambda t: "[" + ", ".join(q(e) for e in t["electives"]) + "]")
FIRST_ITEMS = (f"list_filter([CASE WHEN len({FAILED}) > 0 THEN {q(A.PLAN_RETAKE)} || array_to_string(({FAILED})[1:3], chr(44) || chr(32)) END, "
               f"CASE WHEN len({WNF}) > 0 THEN {q(A.PLAN_REVIEW)} || array_to_string(({WNF})[1:3], chr(44) || chr(32)) END], lambda x: x IS NOT NULL)")
FIRST = f"list_concat(CASE WHEN len({FIRST_ITEMS}) = 0 THEN [{q(A.PLAN_START)}] ELSE {FIRST_ITEMS} END, [{q(A.PLAN_MEET)}])"
SECOND = f"list_concat(({ELECT})[1:3], [{q(A.PLAN_PORTFOLIO)} || track])"
THIRD = f"[({ELECT})[4], ({ELECT})[5], {q(A.PLAN_CAPSTONE)} || track, {q(A.PLAN_INTERNSHIP)}]"
TERMS = " UNION ALL ".join(
    f"SELECT student_id, {i + 1} AS term_no, {q(n)} AS term, g.x AS item, CAST(g.i - 1 AS INTEGER) AS pos "
    f"FROM adv, LATERAL (SELECT unnest({items}) AS x, generate_subscripts({items}, 1) AS i) g"
    for i, (n, items) in enumerate(zip(A.PLAN_TERMS, [FIRST, SECOND, THIRD])))
oracle("graduation_path", ADV + TERMS)
oracle("advisor_report", ADV + f"SELECT student_id, algorithm, track, top_prob AS confidence, gpa, interest, "
       f"array_to_string({FAILED}, chr(44) || chr(32)) AS failed_courses, CAST(len({FAILED}) AS INTEGER) AS failed_n, "
       f"CAST(coalesce(rules_matched, 0) AS BIGINT) AS rules_matched, first_rule_conf, "
       f"array_to_string({EXPL}, ' || ') AS explanation, array_to_string({WARN}, ' || ') AS warnings FROM adv")

FORM = ("(SELECT DISTINCT row_order, CASE row_order % 5 " + " ".join(f"WHEN {i} THEN {q(a)}" for i, a in enumerate(C.ALGORITHM_LABELS)) + f" ELSE {q(C.DEFAULT_ALGORITHM)} END AS algorithm, "
        f"{clamp_float('gpa')} AS entered, CASE WHEN interest IN ({', '.join(q(x) for x in C.INTEREST_OPTIONS)}) THEN interest ELSE 'Undecided' END AS interest, "
        + ", ".join(f"{clamp_int(g)} AS {g}" for g in GRADES) + " FROM sr)")
oracle("request_profiles", SR + f"SELECT row_order, algorithm, round(CASE WHEN entered > 0 THEN entered ELSE {AUTO} END, 6) AS gpa, interest, {', '.join(GRADES)}, "
       f"CAST({' + '.join(f'CAST({g} >= 60 AS INTEGER)' for g in GRADES)} AS INTEGER) AS passed_count, "
       f"CAST({' + '.join(f'CAST({g} < 70 AS INTEGER)' for g in GRADES)} AS INTEGER) AS weak_count FROM {FORM} f")
