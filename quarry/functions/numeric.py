"""Numeric cleaning expressions: range masks, clipping, numpy-style rounding,
profile-form clamps.  All built-in Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import config as C
from quarry.functions.text import PY_FLOAT_RE, PY_INF_RE, PY_NAN_RE, col_, py_strip


def out_of_range(c: Column | str, lo: float, hi: float) -> Column:
    """Non-null value outside ``[lo, hi]`` (null gives false)."""
    c = col_(c)
    return F.coalesce(c.isNotNull() & ((c < lo) | (c > hi)), F.lit(False))


def nullify_outside(c: Column | str, lo: float, hi: float) -> Column:
    """Impossible values become null."""
    c = col_(c)
    return F.when(out_of_range(c, lo, hi), F.lit(None).cast("double")).otherwise(c)


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clip a value into ``[lo, hi]``; null stays null."""
    c = col_(c)
    return F.when(c.isNull(), c).otherwise(F.least(F.lit(hi), F.greatest(F.lit(lo), c)))


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    """numpy ``Series.round``: ``rint(x * 10^d) / 10^d`` (ties to even).
    Spark's ``round`` rounds half up, so it is not used here."""
    c = col_(c)
    if digits == 0:
        return F.rint(c)
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def coerce_numeric(c: Column | str) -> Column:
    """Text -> double, anything unparseable -> null (``to_numeric`` coerce).
    The strict Python-float gate keeps Spark's extra literal forms out."""
    c = col_(c)
    t = py_strip(c)
    lt = F.lower(t)
    return (F.when(lt.rlike(PY_NAN_RE), F.lit(None).cast("double"))
            .when(lt.rlike(PY_INF_RE), F.when(lt.startswith("-"), F.lit(float("-inf")))
                  .otherwise(F.lit(float("inf"))))
            .when(t.rlike(PY_FLOAT_RE), F.regexp_replace(t, "_", "").try_cast("double"))
            .otherwise(F.lit(None).cast("double")))


def clamp_int_input(c: Column | str, default: int = C.FORM_GRADE_DEFAULT,
                    low: int = 0, high: int = 100) -> Column:
    """Form grade: ``int(float(v))`` truncates; unparseable/NaN -> default;
    clamp to ``[low, high]`` before the int cast (no overflow; it truncates).
    The text is parsed where it is mentioned, so it is mentioned once."""
    v = F.coalesce(F.nanvl(coerce_numeric(c), F.lit(float(default))), F.lit(float(default)))
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), v)).cast("int")


def clamp_float_input(c: Column | str, default: float = C.FORM_GPA_DEFAULT,
                      low: float = 0.0, high: float = 4.0) -> Column:
    """Form gpa: unparseable -> default; ``max(low, min(high, v))`` (NaN -> high,
    like Python's ``min`` with NaN second)."""
    lt = F.lower(py_strip(col_(c)))
    v = F.when(lt.rlike(PY_NAN_RE), F.lit(float("nan"))).otherwise(coerce_numeric(c))
    capped = F.least(F.lit(float(high)), F.coalesce(v, F.lit(float(default))))   # NaN is above all numbers
    return F.greatest(F.lit(float(low)), capped)


def auto_gpa(grade_cols: list[str] | None = None) -> Column:
    """GPA estimated from grades: mean / 25, 2 dp; no grades -> 0.0."""
    cols = grade_cols or C.GRADE_COLS
    if not cols:
        return F.lit(0.0)
    total = reduce(add, [F.col(g).cast("double") for g in cols])
    return round_half_even(total / float(len(cols)) / 25.0, 2)


def row_sum(cols: list[str]) -> Column:
    """Row-wise sum of columns."""
    return reduce(add, [F.col(c) for c in cols])


def row_count_where(cols: list[str], pred) -> Column:
    """Row-wise count of columns meeting ``pred``."""
    return reduce(add, [pred(F.col(c)).cast("int") for c in cols])
