"""Deterministic track scoring rule and its argmax."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import config as C


def _mean(cols: list[str]) -> Column:
    return reduce(add, [F.col(c).cast("double") for c in cols]) / float(len(cols))


def track_score(track: dict, interest: Column | str = "interest", gpa: Column | str = "gpa") -> Column:
    """Score of one track, evaluated in the same operation order as the
    original (so float ties resolve identically):
    ``0.58*core_avg + 0.17*all_avg + 0.25*gpa*25`` + interest bonus
    - 18 per failed core course - 4 per weak core course."""
    interest = F.col(interest) if isinstance(interest, str) else interest
    gpa = F.col(gpa) if isinstance(gpa, str) else gpa
    core = track["core"]
    score = (F.lit(C.SCORE_CORE_WEIGHT) * _mean(core)) + (F.lit(C.SCORE_ALL_WEIGHT) * _mean(C.GRADE_COLS)) \
        + ((F.lit(C.SCORE_GPA_WEIGHT) * gpa.cast("double")) * F.lit(float(C.SCORE_GPA_SCALE)))
    bonus = (F.when(interest == track["interest"], F.lit(float(C.SCORE_INTEREST_BONUS)))
             .when(interest == "Undecided", F.lit(float(C.SCORE_UNDECIDED_BONUS)))
             .otherwise(F.lit(0.0)))
    failed_core = reduce(add, [(F.col(c) < C.PASS_MARK).cast("int") for c in core])
    weak_core = reduce(add, [(F.col(c) < C.GOOD_MARK).cast("int") for c in core])
    score = F.when(bonus != 0.0, score + bonus).otherwise(score)
    score = score - (failed_core * C.SCORE_FAILED_CORE_PENALTY).cast("double")
    score = score - (weak_core * C.SCORE_WEAK_CORE_PENALTY).cast("double")
    return score


def score_struct_array(interest="interest", gpa="gpa") -> Column:
    """array<struct<track, priority, score>> over the track dimension."""
    return F.array(*[F.struct(F.lit(t["track"]).alias("track"), F.lit(i).alias("priority"),
                              track_score(t, interest, gpa).alias("score"))
                     for i, t in enumerate(C.TRACKS)])


def recommend_track(interest="interest", gpa="gpa") -> Column:
    """Argmax of the track scores; the first track in dictionary order wins ties."""
    best = F.array_max(F.array(*[
        F.struct(track_score(t, interest, gpa).alias("score"), F.lit(-i).alias("neg_priority"),
                 F.lit(t["track"]).alias("track"))
        for i, t in enumerate(C.TRACKS)]))
    return best["track"]


def with_recommended_track(df, out: str = "recommended_track", interest="interest", gpa="gpa"):
    """Add the argmax track with the five scores staged as columns first
    (keeps each score expression computed once, and codegen small)."""
    names = [f"__score_{i}" for i in range(len(C.TRACKS))]
    staged = df.select("*", *[track_score(t, interest, gpa).alias(n) for t, n in zip(C.TRACKS, names)])
    best = F.array_max(F.array(*[
        F.struct(F.col(n).alias("score"), F.lit(-i).alias("neg_priority"), F.lit(t["track"]).alias("track"))
        for i, (t, n) in enumerate(zip(C.TRACKS, names))]))
    return staged.withColumn(out, best["track"]).drop(*names)
