"""Text cleaning expressions (all JVM-side Column expressions, no UDFs).

Each function reproduces one cell-level parser of the original pipeline.
Python's ``str.strip`` is emulated with a regex because Spark's ``trim``
only removes spaces.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import config as C

# Python float() syntax: sign, digits with optional single underscores,
# optional fraction, optional exponent.
_DIGITS = r"[0-9](?:_?[0-9])*"
PY_FLOAT_RE = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
PY_INF_RE = r"^[+-]?(?:inf|infinity)$"
PY_NAN_RE = r"^[+-]?nan$"
LEADING_NUMBER_RE = r"^(-?[0-9]+(?:\.[0-9]+)?)"
GPA_NUMBER_RE = r"^(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"
SIGNED_GPA_NUMBER_RE = r"^-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def literal_nan_to_null(c: Column | str) -> Column:
    """Whole-cell ``nan``/``NaN``/``NAN`` (unstripped) become null."""
    c = col_(c)
    return F.when(c.isin(*C.LITERAL_NAN), F.lit(None).cast("string")).otherwise(c)


def is_null_token(c: Column | str) -> Column:
    """True when the stripped, lower-cased text is a no-value token.
    Null input gives false (pandas ``isin`` on NaN)."""
    return F.coalesce(F.lower(py_strip(c)).isin(*C.NONE_VARIANTS), F.lit(False))


def null_tokens_to(c: Column | str, replacement: str | None = None) -> Column:
    """No-value tokens become ``replacement`` (null by default)."""
    c = col_(c)
    rep = F.lit(replacement) if replacement is not None else F.lit(None).cast("string")
    return F.when(is_null_token(c), rep).otherwise(c)


def normalize_id(c: Column | str) -> Column:
    """``STU`` + first digit run as an integer, zero-padded to 4 digits;
    no digits -> the cleaned upper-case text; nothing left -> ``UNKNOWN``."""
    c = col_(c)
    text = F.upper(F.regexp_replace(c, r"[^a-zA-Z0-9]", ""))
    digits = F.regexp_extract(text, r"([0-9]+)", 1)
    stripped = F.regexp_replace(digits, r"^0+", "")
    num = F.when(stripped == "", F.lit("0")).otherwise(stripped)
    padded = F.when(F.length(num) < 4, F.lpad(num, 4, "0")).otherwise(num)
    return (F.when(c.isNull(), F.lit("UNKNOWN"))
            .when(digits != "", F.concat(F.lit("STU"), padded))
            .when(text != "", text)
            .otherwise(F.lit("UNKNOWN")))


def with_normalized_id(df, src: str, out: str):
    """``normalize_id`` with its intermediate texts staged as columns."""
    t, d, n = f"__t_{out}", f"__d_{out}", f"__n_{out}"
    s1 = df.select("*", F.col(src).isNull().alias(n),
                   F.upper(F.regexp_replace(F.col(src), r"[^a-zA-Z0-9]", "")).alias(t))
    s2 = s1.select("*", F.regexp_extract(F.col(t), r"([0-9]+)", 1).alias(d))
    s3 = s2.select("*", F.regexp_replace(F.col(d), r"^0+", "").alias(d + "z"))
    num = F.when(F.col(d + "z") == "", F.lit("0")).otherwise(F.col(d + "z"))
    s4 = s3.select("*", num.alias(d + "n"))
    padded = F.when(F.length(d + "n") < 4, F.lpad(d + "n", 4, "0")).otherwise(F.col(d + "n"))
    res = (F.when(F.col(n), F.lit("UNKNOWN"))
           .when(F.col(d) != "", F.concat(F.lit("STU"), padded))
           .when(F.col(t) != "", F.col(t))
           .otherwise(F.lit("UNKNOWN")))
    s5 = s4.select("*", res.alias("__res"))
    cols = [F.col("__res").alias(out) if c == out else F.col(f"`{c}`") for c in df.columns]
    if out not in df.columns:
        cols.append(F.col("__res").alias(out))
    return s5.select(*cols)


def parse_gpa(c: Column | str, keep_sign: bool = False) -> Column:
    """Strip + lower; no-value tokens -> null; delete every character outside
    ``[0-9.]`` (so a minus sign is lost unless ``keep_sign``); float or null."""
    c = col_(c)
    text = F.lower(py_strip(c))
    if keep_sign:
        cleaned = F.regexp_replace(text, r"[^0-9.\-]", "")
        ok = cleaned.rlike(SIGNED_GPA_NUMBER_RE)
    else:
        cleaned = F.regexp_replace(text, r"[^0-9.]", "")
        ok = cleaned.rlike(GPA_NUMBER_RE)
    return (F.when(c.isNull() | is_null_token(c), F.lit(None).cast("double"))
            .when(ok, cleaned.try_cast("double"))
            .otherwise(F.lit(None).cast("double")))


def strip_unit_suffix(c: Column | str) -> Column:
    """Remove one trailing unit (``pt``, ``pts``, ``point(s)``, ``mark(s)``,
    ``/100``, ``%``) with surrounding spaces, then strip."""
    return py_strip(F.regexp_replace(col_(c), C.GRADE_SUFFIX_PATTERN, ""))


def word_to_number(c: Column | str) -> Column:
    """Exact grade word -> number (double), else null."""
    pairs = [x for w, n in C.WORD_TO_NUMBER.items() for x in (F.lit(w), F.lit(float(n)))]
    return F.create_map(*pairs)[col_(c)]


def parse_grade(c: Column | str) -> Column:
    """Grade text -> double or null, following the original parser:
    strip+lower, no-value tokens, one unit suffix, grade words, a full
    Python float literal, else a leading ``-?digits(.digits)?``.
    (Single-expression form; plans use ``grade_stages`` so the shared
    sub-expressions are computed once.)"""
    c = col_(c)
    text = F.lower(py_strip(c))
    return parse_grade_from(c, text, strip_unit_suffix(text))


def grade_stages(c: Column | str) -> tuple[Column, Column]:
    """(lower-stripped text, text without unit suffix) for staged parsing."""
    text = F.lower(py_strip(col_(c)))
    return text, strip_unit_suffix(text)


def parse_grade_from(c: Column, text: Column, t: Column) -> Column:
    """Grade value from the raw cell, its lower-stripped text and the text
    without its unit suffix."""
    word = word_to_number(t)
    plain = F.regexp_replace(t, "_", "")
    return (F.when(c.isNull() | text.isin(*C.NONE_VARIANTS), F.lit(None).cast("double"))
            .when(word.isNotNull(), word)
            .when(t.rlike(PY_NAN_RE), F.lit(None).cast("double"))
            .when(t.rlike(PY_INF_RE),
                  F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
            .when(t.rlike(PY_FLOAT_RE), plain.try_cast("double"))
            .when(t.rlike(LEADING_NUMBER_RE),
                  F.regexp_extract(t, LEADING_NUMBER_RE, 1).try_cast("double"))
            .otherwise(F.lit(None).cast("double")))


def is_nonnumeric_text(c: Column | str) -> Column:
    """The original 'string grade' test: after deleting ``.`` and ``-`` the
    text is not all digits.  Null, blank and padded cells count as text."""
    cleaned = F.regexp_replace(col_(c), r"[.\-]", "")
    return ~F.coalesce(cleaned.rlike(r"^[0-9]+$"), F.lit(False))


def category_key(c: Column | str) -> Column:
    """Normalised lookup key: keep ``[A-Za-z0-9/ ]``, strip, lower, collapse spaces."""
    kept = F.regexp_replace(col_(c), r"[^a-zA-Z0-9/ ]", "")
    return F.regexp_replace(F.lower(F.trim(kept)), r"\s+", " ")


def standardize_category(c: Column | str, variants=None, default: str = "Undecided",
                         blank_to: str | None = None) -> Column:
    """Map messy text to a canonical value: exact dictionary hit first, then
    the first variant (in dictionary order) that the key starts with or whose
    text starts with the key's first six characters; else ``default``.
    A null cell gives ``default``.  An empty key matches the first variant
    (original behaviour) unless ``blank_to`` is given.
    (Single-expression form; plans use ``with_standardized_category``.)"""
    c = col_(c)
    key = category_key(c)
    return category_from_key(c.isNull(), key, F.substring(key, 1, 6), variants, default, blank_to)


def category_from_key(is_null: Column, key: Column, head: Column, variants=None,
                      default: str = "Undecided", blank_to: str | None = None) -> Column:
    variants = variants or C.INTEREST_VARIANTS
    exact = F.create_map(*[x for v, canon in variants for x in (F.lit(v), F.lit(canon))])[key]
    chain = reduce(
        lambda acc, vc: acc.when(key.startswith(vc[0]) | F.lit(vc[0]).startswith(head),
                                 F.lit(vc[1])),
        variants[1:],
        F.when(key.startswith(variants[0][0]) | F.lit(variants[0][0]).startswith(head),
               F.lit(variants[0][1])),
    ).otherwise(F.lit(default))
    out = F.when(is_null, F.lit(default))
    if blank_to is not None:
        out = out.when(key == "", F.lit(blank_to))
    return out.otherwise(F.coalesce(exact, chain))


def with_standardized_category(df, src: str, out: str, **kw):
    """Add ``out`` = standardized ``src`` with the key computed once per row
    (staged projections: Catalyst keeps the shared key instead of inlining
    it into every branch of the variant chain)."""
    k, h, n = f"__k_{out}", f"__h_{out}", f"__n_{out}"
    staged = df.select("*", F.col(src).isNull().alias(n), category_key(src).alias(k))
    staged = staged.select("*", F.substring(k, 1, 6).alias(h))
    res = staged.select("*", category_from_key(F.col(n), F.col(k), F.col(h), **kw).alias("__res"))
    cols = [F.col("__res").alias(out) if c == out else F.col(f"`{c}`") for c in df.columns]
    if out not in df.columns:
        cols.append(F.col("__res").alias(out))
    return res.select(*cols)


def safe_text(c: Column | str, default: str = "None") -> Column:
    """Display text: null, blank, ``none``, ``nan``, ``null`` -> default; else stripped."""
    c = col_(c)
    s = py_strip(c)
    return F.when(c.isNull() | F.lower(s).isin("", "none", "nan", "null"),
                  F.lit(default)).otherwise(s)


def sanitize_token(c: Column | str) -> Column:
    """Item-token form of a label: ``/`` and space become ``_``."""
    return F.translate(col_(c), "/ ", "__")


def fallback_choice(c: Column | str, allowed: list[str], fallback: str) -> Column:
    """Value if it is one of ``allowed`` (exact), else ``fallback``."""
    c = col_(c)
    return F.when(F.coalesce(c.isin(*allowed), F.lit(False)), c).otherwise(F.lit(fallback))


def relabel(c: Column | str, mapping: dict[str, str], title_unknown: bool = True) -> Column:
    """Dictionary relabel; unknown keys become title-cased with ``_`` as space."""
    c = col_(c)
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    if title_unknown:
        return F.coalesce(m[c], F.initcap(F.regexp_replace(c, "_", " ")))
    return m[c]
