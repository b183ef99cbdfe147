"""Numeric column expressions: coercion, yield parsing, durations, tolerances.

Spark 4 runs ANSI mode, where ``cast('abc' as double)`` fails and
``try_cast('5d')`` is 5.0, so coercion of text goes through an anchored
number pattern first.  Ratios use ``try_divide`` (x / 0 -> NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.text import strip_ws

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# A number inside yield text: mixed fraction, fraction, or decimal.
NUMBER_RE = r"(?:\d+\s+\d+/\d+|\d+/\d+|\d+(?:\.\d+)?)"
# Serving patterns, tried in this order; the first that matches wins.
SERVINGS_DOZEN_RE = (
    r"(\d+(?:\.\d+)?)\s*(?:dozen|doz)\s*\b(?:servings?|people|persons?|portions?)\b"
)
SERVES_DOZEN_RE = r"\b(?:serves?)\b\s*(\d+(?:\.\d+)?)\s*(?:dozen|doz)\b"
SERVES_RANGE_RE = (
    r"\b(?:serves?|serving)\b\s*(" + NUMBER_RE + r")(?:\s*(?:-|to)\s*(" + NUMBER_RE + r"))?"
)
RANGE_SERVINGS_RE = (
    r"(" + NUMBER_RE + r")(?:\s*(?:-|to)\s*(" + NUMBER_RE + r"))?\s*"
    r"\b(?:servings?|people|persons?|portions?)\b"
)
# Non-serving yield units, tried in this order.
YIELD_UNIT_PATTERNS = [
    ("yield__loaf", r"\bloaves\b|\bloaf\b"),
    ("yield__muffin", r"\bmuffins\b|\bmuffin\b"),
    ("yield__cookie", r"\bcookies\b|\bcookie\b"),
    ("yield__cup", r"\bcups\b|\bcup\b"),
    ("yield__pie", r"\bpies\b|\bpie\b"),
    ("yield__cake", r"\bcakes\b|\bcake\b"),
    ("yield__quart", r"\bquarts\b|\bquart\b|\bqts\b|\bqt\b"),
    ("yield__batch", r"\bbatches\b|\bbatch\b"),
    ("yield__piece", r"\bpieces\b|\bpiece\b|\bpcs\b|\bpc\b"),
    ("yield__slice", r"\bslices\b|\bslice\b"),
    ("yield__jar", r"\bjars\b|\bjar\b"),
    ("yield__bottle", r"\bbottles\b|\bbottle\b"),
    ("yield__pint", r"\bpints\b|\bpint\b|\bpts\b|\bpt\b"),
    ("yield__gallon", r"\bgallons\b|\bgallon\b|\bgals\b|\bgal\b"),
]
# np.isclose defaults used by the time-arithmetic checks.
ISCLOSE_RTOL = 1e-05
ISCLOSE_ATOL = 1e-08
# ---------------------------------------------------------------------------

_NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                  T.DoubleType, T.DecimalType)


def to_number(df: DataFrame, name: str) -> Column:
    """Numeric coercion, bad values -> NULL (never NaN / infinity)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, _NUMERIC_TYPES):
        d = c.cast("double")
    else:
        d = F.when(c.cast("string").rlike(_NUMERIC_TEXT), F.expr(f"try_cast(trim(`{name}`) AS DOUBLE)"))
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def number_token(t: Column) -> Column:
    """``a b/c`` -> a + b/c, ``a/b`` -> a/b, else the decimal; x/0 -> NULL."""
    t = strip_ws(t)
    mixed = r"^(\d+)\s+(\d+)/(\d+)$"
    frac = r"^(\d+)/(\d+)$"

    def grp(p, i):
        return F.regexp_extract(t, p, i).cast("double")

    return (
        F.when(t.rlike(mixed), grp(mixed, 1) + F.try_divide(grp(mixed, 2), grp(mixed, 3)))
        .when(t.rlike(frac), F.try_divide(grp(frac, 1), grp(frac, 2)))
        .when(t.rlike(r"^\d+(?:\.\d+)?$"), t.cast("double"))
    )


def average_range(lo: Column, hi: Column) -> Column:
    """F8: midpoint of a range, or the single value when there is no upper end."""
    return F.when(hi.isNull(), lo).otherwise((lo + hi) / 2.0)


def yield_text(c: Column) -> Column:
    """Yield text as the serving patterns see it: stripped, lower, dashes, spaces."""
    s = F.lower(strip_ws(c.cast("string")))
    s = F.regexp_replace(s, "[–—]", "-")
    return F.regexp_replace(s, r"(?U)\s+", " ")


def servings_from_yield_text(s: Column) -> Column:
    """F9 on text already passed through :func:`yield_text`.

    The first of four ordered patterns that matches wins; ``dozen`` forms
    multiply by 12, ranges give their midpoint.
    """
    def g(p, i):
        return F.nullif(F.regexp_extract(s, "(?U)" + p, i), F.lit(""))

    def rng(p):
        return average_range(number_token(g(p, 1)), number_token(g(p, 2)))

    return (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("double"))
        .when(s.rlike("(?U)" + SERVINGS_DOZEN_RE), g(SERVINGS_DOZEN_RE, 1).cast("double") * 12.0)
        .when(s.rlike("(?U)" + SERVES_DOZEN_RE), g(SERVES_DOZEN_RE, 1).cast("double") * 12.0)
        .when(s.rlike("(?U)" + SERVES_RANGE_RE), rng(SERVES_RANGE_RE))
        .when(s.rlike("(?U)" + RANGE_SERVINGS_RE), rng(RANGE_SERVINGS_RE))
    )


def servings_from_yield(c: Column) -> Column:
    """servings stated in raw yield text."""
    return servings_from_yield_text(yield_text(c))


def with_servings_parse(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """F9 as staged columns on ``df`` (same result as :func:`servings_from_yield_text`).

    Stages (matching pattern -> its groups -> numbers -> value) keep every
    generated expression small enough for whole-stage codegen.
    """
    s = F.col(text_col)
    pats = [SERVINGS_DOZEN_RE, SERVES_DOZEN_RE, SERVES_RANGE_RE, RANGE_SERVINGS_RE]
    idx = F.when(s.isNull() | (s == ""), F.lit(0))
    for i, p in enumerate(pats, start=1):
        idx = idx.when(s.rlike("(?U)" + p), F.lit(i))
    df = df.withColumn("__sp_idx", idx.otherwise(F.lit(0)))
    k = F.col("__sp_idx")
    g1 = F.when(k == 0, F.lit(None).cast("string"))
    for i, p in enumerate(pats, start=1):
        g1 = g1.when(k == i, F.regexp_extract(s, "(?U)" + p, 1))
    g2 = (F.when(k == 3, F.regexp_extract(s, "(?U)" + pats[2], 2))
          .when(k == 4, F.regexp_extract(s, "(?U)" + pats[3], 2)))
    df = df.withColumns({"__sp_g1": F.nullif(g1, F.lit("")), "__sp_g2": F.nullif(g2, F.lit(""))})
    df = df.withColumns({"__sp_lo": number_token(F.col("__sp_g1")),
                         "__sp_hi": number_token(F.col("__sp_g2"))})
    value = (F.when(k.isin(1, 2), F.col("__sp_g1").cast("double") * 12.0)
             .when(k.isin(3, 4), average_range(F.col("__sp_lo"), F.col("__sp_hi"))))
    return df.withColumn(out_col, value).drop("__sp_idx", "__sp_g1", "__sp_g2", "__sp_lo", "__sp_hi")


def yield_unit_from_text(s: Column, servings: Column) -> Column:
    """F10 on normalized yield text, given its parsed servings."""
    out = F.when(s.isNull() | (s == "") | servings.isNotNull(), F.lit(""))
    for token, pattern in YIELD_UNIT_PATTERNS:
        out = out.when(s.rlike("(?U)" + pattern), F.lit(token))
    return out.otherwise(F.lit(""))


def yield_unit_token(c: Column) -> Column:
    """broad non-serving unit of a yield text; ``""`` when servings parse."""
    s = yield_text(c)
    return yield_unit_from_text(s, servings_from_yield_text(s))


_DUR_NUM = r"(\d+(?:[.,]\d+)?)"
ISO_DURATION_RE = (
    r"^([+-])?P(?:" + _DUR_NUM + r"Y)?(?:" + _DUR_NUM + r"M)?(?:" + _DUR_NUM + r"W)?(?:"
    + _DUR_NUM + r"D)?(?:T(?:" + _DUR_NUM + r"H)?(?:" + _DUR_NUM + r"M)?(?:"
    + _DUR_NUM + r"S)?)?$"
)


def iso_duration_minutes(c: Column) -> Column:
    """ISO-8601 duration text -> minutes.

    ``PT1H30M`` -> 90, ``P1DT2H`` -> 1560, ``PT90S`` -> 1.5, ``-PT5M`` -> -5,
    ``P1W`` -> 10080.  Year / month parts and junk -> NULL (ruling R8).
    """
    s = strip_ws(c.cast("string"))

    def part(i):
        v = F.regexp_extract(s, ISO_DURATION_RE, i)
        return F.coalesce(F.nullif(F.replace(v, F.lit(","), F.lit(".")), F.lit("")).cast("double"),
                          F.lit(0.0))

    def present(i):
        return F.regexp_extract(s, ISO_DURATION_RE, i) != ""

    any_part = present(4) | present(5) | present(6) | present(7) | present(8)
    minutes = part(4) * 10080.0 + part(5) * 1440.0 + part(6) * 60.0 + part(7) + part(8) / 60.0
    sign = F.when(F.regexp_extract(s, ISO_DURATION_RE, 1) == "-", F.lit(-1.0)).otherwise(1.0)
    return F.when(
        s.rlike(ISO_DURATION_RE) & any_part & ~present(2) & ~present(3), sign * minutes
    )


def isclose(a: Column, b: Column, rtol: float = ISCLOSE_RTOL, atol: float = ISCLOSE_ATOL) -> Column:
    """``|a - b| <= atol + rtol * |b|`` (NULL when either side is NULL)."""
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def percent(count: Column, total: Column) -> Column:
    """percent rounded to 4 places, 0.0 when the total is 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(
        F.round(F.lit(100.0) * count.cast("double") / total.cast("double"), 4))


def non_negative(c: Column) -> Column:
    """P5: negative values are invalid -> NULL."""
    return F.when(c >= 0, c)


def positive(c: Column) -> Column:
    """P5: zero or negative values are invalid -> NULL."""
    return F.when(c > 0, c)
