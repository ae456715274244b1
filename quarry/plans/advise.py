"""Batch advising: the per-request advice of the original, re-aimed as one
projection over a table of profiles.

Track-dependent parts (core courses, electives) are CASE expressions over
the five-row track dimension, so a profile table of any size is advised in
a single narrow stage; matched rules come from the rule-matching equi-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.bands import courses_where, profile_items
from quarry.functions.numeric import round_half_even
from quarry.session import hand_off

# ---------------------------------------------------------------------------
# FIXED VALUES: advice texts (must read exactly like the original's advice).
# ---------------------------------------------------------------------------
MSG_INTEREST_MATCH = "Your selected interest matches the {track} track."
MSG_INTEREST_OTHER = "Your interest points toward {other}, but your grades more strongly support {track}."
MSG_NO_INTEREST = "No specific interest was selected, so the model relied more on your academic performance."
MSG_STRONG = "Strong core performance in: {list}."
MSG_WEAK = "Some core subjects need attention: {list}."
MSG_CONFIDENCE = "The selected model gave {track} the highest confidence score at {prob}%."
MSG_RULES = ("Association rules found historical student patterns supporting this recommendation "
             "with up to {conf}% confidence.")
WARN_FAILED = "Retake or improve failed courses before taking advanced electives: {list}."
WARN_WEAK_CORE = "For this track, strengthen these prerequisite areas first: {list}."
WARN_MATH = "Mathematics is important for this path. Add statistics, linear algebra, or probability practice."
WARN_PROGRAMMING = ("Programming is a key prerequisite. Complete extra coding practice before advanced "
                    "software courses.")
WARN_NETWORKS = ("Networks is the main foundation course for this path. Retake or review it before "
                 "advanced networking/security electives.")
WARN_NONE = "No critical risk detected. You can start track electives while keeping your GPA stable."
MATH_TRACKS = ["AI/Machine Learning", "Data Science"]
PROGRAMMING_TRACKS = ["Software Engineering", "Web Development"]
NETWORK_TRACK = "Network Engineering"
PLAN_TERMS = ["Next semester", "Following semester", "Graduation preparation"]
PLAN_RETAKE = "Retake: "
PLAN_REVIEW = "Review: "
PLAN_START = "Start the first two recommended electives"
PLAN_MEET = "Meet advisor to confirm prerequisite order"
PLAN_PORTFOLIO = "Portfolio or mini-project in "
PLAN_CAPSTONE = "Capstone project aligned with "
PLAN_INTERNSHIP = "Internship or professional certification"


def _text(template: str, **cols: Column) -> Column:
    """Fill ``{name}`` slots of a fixed text with Columns."""
    parts, out, rest = [], [], template
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        out += [F.lit(pre), cols[name]]
    out.append(F.lit(rest))
    return F.concat(*out)


def by_track(track: Column, fn) -> Column:
    """CASE over the track dimension: ``fn(track_dict)`` per track."""
    expr = None
    for t in C.TRACKS:
        expr = F.when(track == t["track"], fn(t)) if expr is None else expr.when(track == t["track"], fn(t))
    return expr


def strong_core(track: Column) -> Column:
    return by_track(track, lambda t: courses_where(lambda g: g >= C.STRONG_CORE_MARK, t["core"]))


def weak_core(track: Column) -> Column:
    return by_track(track, lambda t: courses_where(lambda g: g < C.GOOD_MARK, t["core"]))


def weak_not_failed_core(track: Column) -> Column:
    return by_track(track, lambda t: courses_where(lambda g: (g >= C.PASS_MARK) & (g < C.GOOD_MARK), t["core"]))


def failed_courses_list() -> Column:
    return courses_where(lambda g: g < C.PASS_MARK)


def explanation(track: Column, interest: Column, top_prob: Column, first_rule_conf: Column) -> Column:
    """Reason lines (array<string>), in the original order."""
    own = by_track(track, lambda t: F.lit(t["interest"]))
    other = F.create_map(*[x for t in C.TRACKS for x in (F.lit(t["interest"]), F.lit(t["track"]))])[interest]
    first = (F.when(interest == own, _text(MSG_INTEREST_MATCH, track=track))
             .when(interest.isNotNull() & (interest != "") & (interest != "Undecided"),
                   F.when(other.isNotNull() & (other != track),
                          _text(MSG_INTEREST_OTHER, other=other, track=track)))
             .otherwise(F.lit(MSG_NO_INTEREST)))
    strong = F.slice(strong_core(track), 1, 4)
    weak = F.slice(weak_core(track), 1, 3)
    lines = [
        first,
        F.when(F.size(strong) > 0, _text(MSG_STRONG, list=F.array_join(strong, ", "))),
        F.when(F.size(weak) > 0, _text(MSG_WEAK, list=F.array_join(weak, ", "))),
        _text(MSG_CONFIDENCE, track=track, prob=top_prob.cast("string")),
        F.when(first_rule_conf.isNotNull(), _text(MSG_RULES, conf=first_rule_conf.cast("string"))),
    ]
    return F.array_compact(F.array(*lines))


def warnings(track: Column) -> Column:
    failed = failed_courses_list()
    weak = weak_core(track)
    lines = [
        F.when(F.size(failed) > 0, _text(WARN_FAILED, list=F.array_join(failed, ", "))),
        F.when(F.size(weak) > 0, _text(WARN_WEAK_CORE, list=F.array_join(weak, ", "))),
        F.when(track.isin(*MATH_TRACKS) & (F.col("math_grade") < C.GOOD_MARK), F.lit(WARN_MATH)),
        F.when(track.isin(*PROGRAMMING_TRACKS) & (F.col("programming_grade") < C.GOOD_MARK), F.lit(WARN_PROGRAMMING)),
        F.when((track == NETWORK_TRACK) & (F.col("networks_grade") < C.GOOD_MARK), F.lit(WARN_NETWORKS)),
    ]
    arr = F.array_compact(F.array(*lines))
    return F.when(F.size(arr) == 0, F.array(F.lit(WARN_NONE))).otherwise(arr)


def graduation_path(track: Column) -> Column:
    """array<struct<term_no, term, items array<string>>> (three terms)."""
    failed = F.slice(failed_courses_list(), 1, 3)
    review = F.slice(weak_not_failed_core(track), 1, 3)
    first = F.array_compact(F.array(
        F.when(F.size(failed) > 0, F.concat(F.lit(PLAN_RETAKE), F.array_join(failed, ", "))),
        F.when(F.size(review) > 0, F.concat(F.lit(PLAN_REVIEW), F.array_join(review, ", ")))))
    first = F.when(F.size(first) == 0, F.array(F.lit(PLAN_START))).otherwise(first)
    first = F.concat(first, F.array(F.lit(PLAN_MEET)))
    electives = by_track(track, lambda t: F.array(*[F.lit(e) for e in t["electives"]]))
    second = F.concat(F.slice(electives, 1, 3), F.array(F.concat(F.lit(PLAN_PORTFOLIO), track)))
    third = F.array(electives[3], electives[4], F.concat(F.lit(PLAN_CAPSTONE), track), F.lit(PLAN_INTERNSHIP))
    return F.array(*[F.struct(F.lit(i + 1).alias("term_no"), F.lit(n).alias("term"), items.alias("items"))
                     for i, (n, items) in enumerate(zip(PLAN_TERMS, [first, second, third]))])


def track_dimension(spark) -> DataFrame:
    """The five-row track dimension (fixed values) as a DataFrame."""
    rows = [(t["track"], t["short"], t["interest"], t["core"], t["electives"], t["careers"], t["desc"])
            for t in C.TRACKS]
    return spark.createDataFrame(rows, "track string, short string, interest string, core array<string>, "
                                       "electives array<string>, careers array<string>, description string")


def profile_inputs(profiles: DataFrame) -> DataFrame:
    """Form-style text inputs -> clean profile values (clamps, fallbacks,
    automatic gpa), keeping the id."""
    from quarry.functions.numeric import auto_gpa, clamp_float_input, clamp_int_input
    from quarry.functions.text import fallback_choice
    grades = [clamp_int_input(F.col(g)).alias(g) for g in C.GRADE_COLS]
    base = profiles.select("student_id",
                           fallback_choice("algorithm", list(C.ALGORITHM_LABELS), C.DEFAULT_ALGORITHM).alias("algorithm"),
                           fallback_choice("interest", C.INTEREST_OPTIONS, "Undecided").alias("interest"),
                           clamp_float_input("gpa").alias("entered_gpa"), *grades)
    return base.withColumn("gpa", F.when(F.col("entered_gpa") > 0, F.col("entered_gpa")).otherwise(auto_gpa())) \
               .drop("entered_gpa")


def feature_row() -> list[Column]:
    """Model feature columns derived from profile grades (counts, flags)."""
    g = [F.col(c) for c in C.GRADE_COLS]
    cnt = lambda pred: reduce(lambda a, b: a + b, [pred(x).cast("int") for x in g])
    cols = [cnt(lambda x: x >= C.PASS_MARK).alias("passed_count"), cnt(lambda x: x < C.PASS_MARK).alias("failed_count"),
            cnt(lambda x: x >= C.EXCELLENT_MARK).alias("excellent_count"), cnt(lambda x: x < C.GOOD_MARK).alias("weak_count")]
    for k in C.COURSE_KEYS:
        cols += [(F.col(f"{k}_grade") >= C.PASS_MARK).cast("int").alias(f"{k}_passed"),
                 (F.col(f"{k}_grade") < C.PASS_MARK).cast("int").alias(f"{k}_failed")]
    return cols


def model_profiles(requests: DataFrame) -> DataFrame:
    """Form requests (row_order, algorithm, gpa, interest and grades, all
    text) as the models read them, one row each under its number."""
    p = profile_inputs(requests.withColumn("student_id", F.col("row_order").cast("string")))
    return p.select("student_id", F.col("student_id").cast("long").alias("row_order"), "algorithm", "gpa", "interest", *C.GRADE_COLS, *feature_row())


def model_advice(models: dict, requests: DataFrame) -> DataFrame:
    """The whole report of each request by the model it names (or the default):
    track and probability, all models' answers, matched rules, explanation,
    warnings, plan, track facts and similar students."""
    from quarry.operators import rules as R
    from quarry.plans import models as M
    full = hand_off(model_profiles(requests), "advice-profiles")
    scored = hand_off(M.predict_all(models, full).withColumn("pct", round_half_even(F.col("confidence") * 100.0, 1)), "advice-scored")
    chosen = (full.select("student_id", F.col("algorithm").alias("model")).join(scored, ["student_id", "model"])
              .select("student_id", F.col("predicted").alias("track"), F.col("pct").alias("top_prob")))
    label = F.create_map(*[F.lit(x) for kv in C.ALGORITHM_LABELS.items() for x in kv])
    order = F.array_position(F.array(*[F.lit(m) for m in C.ALGORITHM_LABELS]), F.col("model"))
    # three answers a profile
    answers = scored.join(chosen, "student_id").groupBy("student_id").agg(F.array_sort(F.collect_list(F.struct(
        order.alias("place"), label[F.col("model")].alias("algorithm"), F.col("predicted").alias("track"), F.col("pct").alias("confidence"), (F.col("predicted") == F.col("track")).alias("agrees")))).alias("c"))
    comparison = F.transform("c", lambda x: x.dropFields("place")).alias("comparison")
    matched = R.match_rules(full.select("student_id", profile_items().alias("items")), models["rules"], per_profile=C.RULES_PER_PROFILE)
    rules = matched.groupBy("student_id").agg(F.count(F.lit(1)).alias("rules_matched"), F.min_by(R.display_rule_columns(matched)[1], F.col("rule_rank")).alias("first_rule_conf"))
    # four neighbours a profile
    near = M.similar_students(models, full).groupBy("student_id").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour_id", "gpa", "interest", "track", "failed_courses", "similarity"))).alias("similar"))
    dim = track_dimension(full.sparkSession).select("track", "short", "electives", "careers", F.col("description").alias("track_description"))
    accuracy = models["metrics"].select(F.col("model").alias("algorithm"), F.col("accuracy_pct").alias("accuracy"))
    a = (full.join(chosen, "student_id").join(answers.select("student_id", comparison), "student_id").join(rules, "student_id", "left").join(near, "student_id", "left")
         .join(F.broadcast(dim), "track").join(F.broadcast(accuracy), "algorithm"))   # five and three rows
    a = hand_off(a, "advice-joined")   # the texts below are planned once, not anew after each stage of the joins
    track, interest = F.col("track"), F.col("interest")
    return a.select(
        "row_order", "algorithm", "accuracy", "track", F.col("top_prob").alias("confidence"), "gpa", "interest", F.array_join(failed_courses_list(), ", ").alias("failed_courses"),
        F.coalesce("rules_matched", F.lit(0).cast("long")).alias("rules_matched"), explanation(track, interest, F.col("top_prob"), F.col("first_rule_conf")).alias("explanation"),
        warnings(track).alias("warnings"), graduation_path(track).alias("plan"), "short", "electives", "careers", "track_description", "comparison", "similar")
