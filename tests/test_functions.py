"""Golden cases for the column expressions (read off the reference's rules)."""

import pytest
from pyspark.sql import functions as F

from larder.functions.numbers import (
    iso_duration_minutes, servings_from_yield, with_servings_parse, yield_text, yield_unit_token,
)
from larder.functions.text import (
    category_clean, dedupe_sorted, is_time_like, normalize_token, parse_list, vectorizer_terms,
)
from larder.operators.resolve import resolve_times


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


YIELD_CASES = [
    ("4 servings", 4.0, ""), ("serves 4-6", 5.0, ""), ("serves 4 to 6", 5.0, ""),
    ("2 dozen servings", 24.0, ""), ("serves 2 dozen", 24.0, ""), ("1 9-inch pie, serves 8", 8.0, ""),
    ("1 1/2 servings", 1.5, ""), ("1/2 portions", 0.5, ""), ("4–6 servings", 5.0, ""),
    ("6-8 persons", 7.0, ""), ("serves 4 tomatoes", 4.0, ""), ("12 muffins", None, "yield__muffin"),
    ("1 loaf", None, "yield__loaf"), ("2 pie cakes", None, "yield__pie"),
    ("10 1/2 cup servings", None, "yield__cup"), ("serves many", None, ""), ("   ", None, ""), (None, None, ""),
]


def test_servings_and_unit_tokens(spark):
    texts = [c[0] for c in YIELD_CASES]
    assert one_col(spark, texts, servings_from_yield) == [c[1] for c in YIELD_CASES]
    assert one_col(spark, texts, yield_unit_token) == [c[2] for c in YIELD_CASES]
    df = spark.createDataFrame([(t,) for t in texts], "x string").withColumn("t", yield_text(F.col("x")))
    staged = [r[0] for r in with_servings_parse(df, "t", "s").select("s").collect()]
    assert staged == [c[1] for c in YIELD_CASES]


def test_servings_zero_denominator_is_null(spark):
    assert one_col(spark, ["serves 1/0"], servings_from_yield) == [None]


def test_durations(spark):
    cases = [("PT30M", 30.0), ("PT1H30M", 90.0), ("P1DT2H", 1560.0), ("PT90S", 1.5), ("-PT5M", -5.0),
             ("P1W", 10080.0), ("junk", None), ("P1Y", None), (None, None), ("PT1,5H", 90.0)]
    assert one_col(spark, [c[0] for c in cases], iso_duration_minutes) == [c[1] for c in cases]


def test_list_cells(spark):
    cases = [
        ('c("butter", "brown sugar")', ["butter", "brown sugar"]), ('"butter"', ["butter"]),
        ('c("a, b", "c")', ["a, b", "c"]), ('c("a, b", NA)', ["a", "b", "NA"]), ("salt", ["salt"]),
        ("a,,b", ["a", "b"]), ('c("pan 8\\" wide", "x")', ['pan 8" wide', "x"]),
        ('c("1", NA, "2")', ["1", "NA", "2"]), ("character(0)", ["character(0)"]), ("  ", []), (None, []),
        ("['a', 'b']", ["a", "b"]),
    ]
    assert one_col(spark, [c[0] for c in cases], parse_list) == [c[1] for c in cases]


def test_tokens(spark):
    cases = [("Salt & Pepper", "salt_and_pepper"), ("< 60 Mins", "60_mins"), ("half-and-half", "half_and_half"),
             ("Baker's sugar", "bakers_sugar"), ("Crème Fraîche", "crème_fraîche"), ("1/2 lemon", "1/2_lemon"),
             ("Lunch/Snacks", "lunch/snacks"), ("NaN", ""), ("-- --", ""), ("  None ", "")]
    assert one_col(spark, [c[0] for c in cases], normalize_token) == [c[1] for c in cases]
    # idempotent
    out = [c[1] for c in cases]
    assert one_col(spark, out, normalize_token) == out


def test_categories(spark):
    cases = [("Lunch/Snacks", "lunch_snacks"), ("< 15 Mins", "15_mins"), ("   ", None), ("!!!", None),
             (None, None), ("Crème  Brûlée", "crème_brûlée")]
    assert one_col(spark, [c[0] for c in cases], category_clean) == [c[1] for c in cases]


def test_time_like_and_terms(spark):
    toks = ["15_mins", "60_minutes", "4_hours", "4_hours_or_less", "time_to_make", "weeknight", "easy", "mins"]
    assert one_col(spark, toks, is_time_like) == [True] * 6 + [False] * 2
    assert one_col(spark, ["/x", "x/", "1/2_lemon", "a//b", "/"], vectorizer_terms) == [
        ["x"], ["x"], ["1/2_lemon"], ["a//b"], []]


def test_dedupe_sorted(spark):
    df = spark.createDataFrame([(["b", "a", "", "b"],)], "x array<string>")
    assert df.select(dedupe_sorted(F.col("x"))).first()[0] == ["a", "b"]


@pytest.mark.parametrize("prep,cook,total,resolved,flags", [
    (10.0, None, 30.0, (10.0, 20.0, 30.0), ("cook", 1, 0)),
    (10.0, None, 10.0, (10.0, 0.0, 10.0), ("cook", 1, 0)),
    (40.0, None, 30.0, (40.0, None, 30.0), (None, 0, 0)),
    (None, 20.0, 30.0, (10.0, 20.0, 30.0), ("prep", 1, 0)),
    (10.0, 20.0, None, (10.0, 20.0, 30.0), ("total", 1, 0)),
    (10.0, 20.0, 35.0, (10.0, 20.0, 35.0), (None, 0, 1)),
    (-5.0, 20.0, 30.0, (10.0, 20.0, 30.0), ("prep", 1, 0)),
])
def test_time_resolution(spark, prep, cook, total, resolved, flags):
    df = spark.createDataFrame([(prep, cook, total)],
                               "PrepTime_Minutes double, CookTime_Minutes double, TotalTime_Minutes double")
    r = resolve_times(df).first()
    assert (r["PrepTime_Minutes_resolved"], r["CookTime_Minutes_resolved"], r["TotalTime_Minutes_resolved"]) == resolved
    derived = {"cook": r["cooktime_derived_from_total_prep"], "prep": r["preptime_derived_from_total_cook"],
               "total": r["totaltime_derived_from_prep_cook"]}
    which, consistent, mismatch = flags
    assert [k for k, v in derived.items() if v] == ([which] if which else [])
    assert r["time_arithmetic_consistent"] == consistent
    assert r["time_arithmetic_mismatch"] == mismatch


def _by_ast(text):
    """Items of a list cell by Python's own literal parser: lenient, and (items, ok) of the checked rule."""
    import ast
    if text is None:
        return [], ([], False)
    cell = text.strip()
    try:
        value = ast.literal_eval(cell)
    except (ValueError, SyntaxError):
        return [cell] if cell else [], ([], False)
    lenient = [] if value is None else [str(x) for x in value] if isinstance(value, list | tuple) else [str(value)]
    return lenient, (([str(x) for x in value], True) if isinstance(value, list) else ([], False))


def test_list_literals_agree_with_python(spark):
    import random

    from larder.functions.text import parse_list_checked, parse_list_repr
    rng = random.Random(6)
    atoms = ["plain", "it's", 'say "x"', "back\\slash", "a, b", "[x]", "(y", "é漢", "", "tab\tline\n", 1, -25, 2.5, None, True, False, ["in", 2], ("one",)]
    cells = [repr([rng.choice(atoms) for _ in range(rng.randint(0, 6))]) for _ in range(60)]
    cells += [repr(tuple(rng.choice(atoms[:10]) for _ in range(rng.randint(0, 4)))) for _ in range(20)] + [repr(x) for x in atoms]
    cells += [None, "", "  ", "['a'", "'a']", "a, b", "['a' 'b', \"c\" 'd']", "[ 'x' , ]", "\n['y']  ", "[,]", "['a',,'b']", "['a' b]", "['a')", "(1, 2", "None", "['a'] x", "[1 2]", "\"open"]
    cells += ["['" + "', '".join(["word"] * 30_000) + "']", "'" + "x" * 300_000 + "'", "['" + "\\'" * 100_000]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, cell string").repartition(4)
    got = df.select("i", parse_list_repr(F.col("cell")).alias("a"), parse_list_checked(F.col("cell")).alias("b")).collect()
    for r in got:
        assert (r.a, (r.b["items"], r.b["ok"])) == _by_ast(cells[r.i]), cells[r.i][:80]


def test_numbers_from_text_are_finite(spark):
    from larder.functions.numbers import to_number
    df = spark.createDataFrame([("1e999",), ("-1e999",), ("1e308",), (" 2.5 ",), ("inf",), ("nan",), ("x",), (None,)], "t string")
    assert [r.n for r in df.select(to_number(df, "t").alias("n")).collect()] == [None, None, 1e308, 2.5, None, None, None, None]
