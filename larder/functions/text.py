"""Text column expressions: list cells, categories, tokens, tokenizer.

All are ``Column -> Column`` built from Spark's JVM-side string, regex and
higher-order array functions, so they run inside whole-stage codegen with no
Python worker.  Java's ``\\w`` / ``\\s`` are ASCII unless a pattern starts with
``(?U)``; every word-class pattern here carries it so accented text
(``crème``) stays one word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Words a token normalizer treats as "no token".
NULL_WORDS = ["", "nan", "none", "null"]
# Time-like keyword tags removed from keyword documents (anchored, in order).
TIME_KEYWORD_PATTERNS = [
    r"^\d+_mins?$",
    r"^\d+_minutes?$",
    r"^\d+_hours?$",
    r"^\d+_hours_or_less$",
    r"^time_to_make$",
    r"^weeknight$",
]
# Token pattern of the content vectorizer (applied after lowercasing).
VECTORIZER_TOKEN_PATTERN = r"(?U)\b[\w/]+\b"
# Token pattern of the legacy text vectorizer (two or more word characters).
LEGACY_TOKEN_PATTERN = r"(?U)\b\w\w+\b"
# ---------------------------------------------------------------------------

# Every character Python's ``str.strip()`` removes (derived, not listed).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (no regex)."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def blank_missing(c: Column) -> Column:
    """A cell is missing when NULL or only whitespace."""
    return c.isNull() | c.cast("string").rlike(r"(?U)^\s*$")


def clean_text(c: Column) -> Column:
    """Strip; blank becomes NULL."""
    s = strip_ws(c.cast("string"))
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def category_clean(c: Column) -> Column:
    """lower, punctuation to space, collapse, underscores; blank -> NULL.

    ``Lunch/Snacks`` -> ``lunch_snacks``; ``< 15 Mins`` -> ``15_mins``.
    """
    s = F.lower(strip_ws(c.cast("string")))
    s = F.regexp_replace(s, r"(?U)[^\w\s]+", " ")
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    s = F.regexp_replace(strip_ws(s), " ", "_")
    return F.when(blank_missing(c) | (s == ""), F.lit(None).cast("string")).otherwise(s)


def _null_word_to_empty(s: Column) -> Column:
    return F.when(s.isin(*NULL_WORDS), F.lit("")).otherwise(s)


def normalize_token(c: Column) -> Column:
    """content-token normalization; ``/`` is kept, ``&`` becomes ``and``.

    ``Salt & Pepper`` -> ``salt_and_pepper``; ``Crème Fraîche`` ->
    ``crème_fraîche``; null words -> ``""``.  Never returns NULL for a
    non-NULL input.
    """
    s = F.lower(strip_ws(c.cast("string")))
    s = _null_word_to_empty(s)
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = F.replace(s, F.lit("'"), F.lit(""))
    s = F.regexp_replace(s, r"(?U)[^\w\s/-]+", " ")
    s = F.regexp_replace(s, r"(?U)[\s-]+", "_")
    s = F.regexp_replace(s, r"_+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return _null_word_to_empty(s)


def normalize_token_ascii(c: Column) -> Column:
    """audit-side normalization, ASCII letters/digits only."""
    s = F.lower(strip_ws(c.cast("string")))
    s = F.regexp_replace(s, r"[^a-z0-9 ]+", " ")
    s = F.regexp_replace(s, r" +", " ")
    return F.replace(strip_ws(s), F.lit(" "), F.lit("_"))


def dedupe_sorted(arr: Column) -> Column:
    """F16: distinct non-empty tokens in code-point order."""
    return F.array_sort(F.array_distinct(F.filter(arr, lambda t: t != "")))


def is_time_like(token: Column) -> Column:
    """a normalized keyword that only states a duration."""
    return token.rlike("|".join(f"(?:{p})" for p in TIME_KEYWORD_PATTERNS))


def vectorizer_terms(token: Column, pattern: str = VECTORIZER_TOKEN_PATTERN) -> Column:
    """terms the vectorizer sees inside one normalized token.

    Applied per token (tokens are joined by spaces in a document, and a space
    is never a word character, so per-token extraction equals extraction on
    the joined text).  An edge ``/`` is cut off, so ``/x`` and ``x`` merge.
    """
    return F.regexp_extract_all(F.lower(token), F.lit(pattern), 0)


# -- F1 / F2 / F3: list cells -------------------------------------------------

_QUOTED_ITEM = r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'"
_QUOTED_LIST = (
    r"(?s)^\s*[\[(]?\s*(?:" + _QUOTED_ITEM + r")(?:\s*,\s*(?:" + _QUOTED_ITEM
    + r"))*\s*,?\s*[\])]?\s*$"
)


def _quoted_items(s: Column) -> Column:
    items = F.regexp_extract_all(s, F.lit(_QUOTED_ITEM), 0)
    return F.transform(
        items,
        lambda x: F.regexp_replace(
            F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1"),
    )


def _comma_split(s: Column) -> Column:
    pieces = F.filter(F.split(s, ","), lambda v: v != "")
    return F.transform(pieces, lambda v: F.regexp_replace(strip_ws(v), r"^\"+|\"+$", ""))


def parse_list(c: Column) -> Column:
    """list cell from ``c("a", "b")``, a quoted list, or plain text.

    NULL / blank -> ``[]``.  A cell that is wholly a comma list of quoted
    items yields the items (escapes undone); anything else is split on every
    comma, each piece stripped of whitespace and edge quotes, empty pieces
    dropped (``c("a, b", NA)`` -> ``a``, ``b``, ``NA``; ``character(0)``
    stays one item).
    """
    s = strip_ws(c.cast("string"))
    s = F.when(s.startswith("c(") & s.endswith(")"),
               F.substring(s, F.lit(3), F.length(s) - 3)).otherwise(s)
    empty = F.array().cast("array<string>")
    return (
        F.when(c.isNull() | (s == ""), empty)
        .when(s.rlike(_QUOTED_LIST), _quoted_items(s))
        .otherwise(_comma_split(s))
    )


# Literals of lists and tuples as Python prints them.  Quantifiers are possessive, so the patterns
# take linear time and constant stack on cells of any length.
_STR = r"\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\"|'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_STRS = rf"(?:{_STR})(?:\s*+(?:{_STR}))*+"
_NUM = r"[+-]?(?:\d++(?:\.\d*+)?|\.\d++)(?:[eE][+-]?\d++)?"
_NESTED = rf"[\[(](?:[^\[\](){{}}\"']++|{_STR})*+[\])]"
_ITEM = rf"(?:{_STRS}|{_NUM}|None|True|False|{_NESTED})"
_MANY = rf"(?:{_ITEM}(?:\s*+,\s*+{_ITEM})*+\s*+,?)?"
_LIST = rf"(?s)^\s*+\[\s*+{_MANY}\s*+\]\s*+$"
_TUPLE = rf"(?s)^\s*+\(\s*+{_MANY}\s*+\)\s*+$"
_SCALAR = rf"(?s)^\s*+(?:{_STRS}|{_NUM}|True|False)\s*+$"


def _unquoted(piece: Column) -> Column:
    """The text of a quoted literal, escapes undone."""
    s = F.replace(F.substring(piece, F.lit(2), F.length(piece) - 2), F.lit("\\\\"), F.lit("\x00"))
    for code, char in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r")):
        s = F.replace(s, F.lit(code), F.lit(char))
    return F.replace(F.regexp_replace(s, r"\\(.)", "$1"), F.lit("\x00"), F.lit("\\"))


def _literal_text(item: Column) -> Column:
    parts = F.regexp_extract_all(item, F.lit(rf"(?s){_STR}"), F.lit(0))
    return F.when(item.rlike(r"^[\"']"), F.array_join(F.transform(parts, _unquoted), "")).otherwise(item)


def _literal_items(s: Column) -> Column:
    inner = F.substring(s, F.lit(2), F.length(s) - 2)
    return F.transform(F.regexp_extract_all(inner, F.lit(rf"(?s){_ITEM}"), F.lit(0)), _literal_text)


def parse_list_repr(c: Column) -> Column:
    """the items of a list or tuple as Python prints it.

    A scalar literal is one item, ``None``, blank and NULL are none, and malformed text is one item
    as it stands.  Adjacent strings are one; numbers and inner lists (one level) keep their text.
    """
    s = strip_ws(c.cast("string"))
    empty = F.array().cast("array<string>")
    return (F.when(c.isNull() | s.isin("", "None"), empty).when(s.rlike(_LIST) | s.rlike(_TUPLE), _literal_items(s))
            .when(s.rlike(_SCALAR), F.array(_literal_text(s))).otherwise(F.array(s)))


def parse_list_checked(c: Column) -> Column:
    """``struct(items, ok)``; only a list literal is parsed, anything else gives no items and ok = false."""
    s = strip_ws(c.cast("string"))
    ok = F.coalesce(s.rlike(_LIST), F.lit(False))
    return F.struct(F.when(ok, _literal_items(s)).otherwise(F.array().cast("array<string>")).alias("items"), ok.alias("ok"))
