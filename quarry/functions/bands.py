"""Grade banding, basket items and row-wise course lists."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.text import col_, sanitize_token


def grade_level(c: Column | str) -> Column:
    """Display level: >=85 excellent, >=70 good, >=60 pass, else failed."""
    g = col_(c)
    return (F.when(g >= C.EXCELLENT_MARK, "excellent").when(g >= C.GOOD_MARK, "good")
            .when(g >= C.PASS_MARK, "pass").otherwise("failed"))


def grade_band(c: Column | str) -> Column:
    """Item band: >=85 Excellent, >=70 Good, <60 Failed, else Weak."""
    g = col_(c)
    return (F.when(g >= C.EXCELLENT_MARK, "Excellent").when(g >= C.GOOD_MARK, "Good")
            .when(g < C.PASS_MARK, "Failed").otherwise("Weak"))


def band_item(grade_col: str, label: str | None = None) -> Column:
    """``<Band>_<Label>`` item of one grade column (absent grade -> 0)."""
    label = label or C.ITEM_LABELS[grade_col]
    g = F.coalesce(F.col(grade_col), F.lit(0))
    return F.concat(grade_band(g), F.lit("_" + label))


def interest_item(c: Column | str = "interest") -> Column:
    return F.concat(F.lit("Interest_"), sanitize_token(F.coalesce(col_(c), F.lit("Undecided"))))


def track_item(c: Column | str = "recommended_track") -> Column:
    return F.concat(F.lit("Track_"), sanitize_token(col_(c)))


def failed_flag_item(has_failed: Column) -> Column:
    return F.when(has_failed, F.lit("Has_Failed_Course")).otherwise(F.lit("No_Failed_Courses"))


def any_failed_grade(grade_cols: list[str] | None = None) -> Column:
    cols = grade_cols or C.GRADE_COLS
    return F.greatest(*[(F.coalesce(F.col(g), F.lit(0)) < C.PASS_MARK) for g in cols]) \
        if len(cols) > 1 else (F.col(cols[0]) < C.PASS_MARK)


def profile_items() -> Column:
    """The 10 items of a profile: 8 bands, interest, failed flag from grades."""
    return F.array(*[band_item(g) for g in C.GRADE_COLS], interest_item("interest"),
                   failed_flag_item(any_failed_grade()))


def transaction_items() -> Column:
    """The 11 items of a training basket: as a profile, but the failed flag
    comes from ``failed_count`` and the track item is appended."""
    return F.array(*[band_item(g) for g in C.GRADE_COLS], interest_item("interest"),
                   failed_flag_item(F.coalesce(F.col("failed_count"), F.lit(0)) > 0),
                   track_item("recommended_track"))


def basket_items() -> list[str]:
    """Every item that a training basket can hold, sorted."""
    token = lambda s: re.sub(r"\W", "_", s)
    bands = [f"{b}_{C.ITEM_LABELS[g]}" for g in C.GRADE_COLS for b in ("Excellent", "Good", "Failed", "Weak")]
    return sorted([*bands, *(f"Interest_{token(i)}" for i in {*C.VALID_INTERESTS, "Undecided"}), *(f"Track_{token(t)}" for t in C.TRACK_NAMES), "Has_Failed_Course", "No_Failed_Courses"])


def courses_where(pred, grade_cols: list[str] | None = None, first_n: int | None = None) -> Column:
    """Labels of the grade columns meeting ``pred``, in the given column order,
    optionally only the first ``n``."""
    cols = grade_cols or C.GRADE_COLS
    arr = F.array_compact(F.array(*[F.when(pred(F.col(g)), F.lit(C.COURSE_LABELS[g]))
                                    for g in cols]))
    return F.slice(arr, 1, first_n) if first_n else arr


def join_course_list(arr: Column, empty: str | None = "None") -> Column:
    """Pipe-joined list; ``empty`` when the list is empty (``None`` for
    failed lists; pass ``empty=None`` to keep ``''`` as the passed list does)."""
    joined = F.concat_ws("|", arr)
    if empty is None:
        return joined
    return F.when(F.size(arr) == 0, F.lit(empty)).otherwise(joined)
