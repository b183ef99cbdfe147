"""DuckDB SQL twins of the registered queries (the driver's correctness gate).

Written independently of the Spark code: plain SQL over the pre-registered
driver tables.  DuckDB's ``\\w`` is ASCII, so word classes are spelled
``\\p{L}\\p{N}_``; its ``regexp_replace`` needs the ``'g'`` flag.
"""

from __future__ import annotations

from larder.functions.numbers import (
    NUMBER_RE, RANGE_SERVINGS_RE, SERVES_DOZEN_RE, SERVES_RANGE_RE, SERVINGS_DOZEN_RE,
    YIELD_UNIT_PATTERNS,
)
from larder.sources.testdata import VIEW_SQL

__all__ = ["SQL"]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def category_clean_sql(x: str) -> str:
    s = f"regexp_replace(lower(trim({x})), '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g')"
    s = f"replace(trim(regexp_replace({s}, '\\s+', ' ', 'g')), ' ', '_')"
    return (f"CASE WHEN {x} IS NULL OR regexp_matches({x}, '^\\s*$') OR {s} = '' THEN NULL "
            f"ELSE {s} END")


def number_token_sql(t: str) -> str:
    mixed, frac = r"^(\d+)\s+(\d+)/(\d+)$", r"^(\d+)/(\d+)$"

    def g(p, i):
        return f"CAST(regexp_extract({t}, {q(p)}, {i}) AS DOUBLE)"

    return (f"(CASE WHEN regexp_matches({t}, {q(mixed)}) THEN {g(mixed, 1)} + {g(mixed, 2)} / "
            f"nullif({g(mixed, 3)}, 0) "
            f"WHEN regexp_matches({t}, {q(frac)}) THEN {g(frac, 1)} / nullif({g(frac, 2)}, 0) "
            f"WHEN regexp_matches({t}, '^\\d+(?:\\.\\d+)?$') THEN CAST({t} AS DOUBLE) END)")


def yield_text_sql(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower(trim({x})), '[–—]', '-', 'g'), "
            f"'\\s+', ' ', 'g')")


def servings_sql(x: str) -> str:
    y = yield_text_sql(x)

    def grp(p, i):
        return f"nullif(regexp_extract({y}, {q(p)}, {i}), '')"

    def rng(p):
        lo, hi = number_token_sql(grp(p, 1)), number_token_sql(grp(p, 2))
        return f"(CASE WHEN {grp(p, 2)} IS NULL THEN {lo} ELSE ({lo} + {hi}) / 2.0 END)"

    return (f"(CASE WHEN {x} IS NULL OR {y} = '' THEN NULL "
            f"WHEN regexp_matches({y}, {q(SERVINGS_DOZEN_RE)}) THEN CAST({grp(SERVINGS_DOZEN_RE, 1)} AS DOUBLE) * 12.0 "
            f"WHEN regexp_matches({y}, {q(SERVES_DOZEN_RE)}) THEN CAST({grp(SERVES_DOZEN_RE, 1)} AS DOUBLE) * 12.0 "
            f"WHEN regexp_matches({y}, {q(SERVES_RANGE_RE)}) THEN {rng(SERVES_RANGE_RE)} "
            f"WHEN regexp_matches({y}, {q(RANGE_SERVINGS_RE)}) THEN {rng(RANGE_SERVINGS_RE)} END)")


def yield_unit_sql(x: str, servings: str) -> str:
    y = yield_text_sql(x)
    whens = " ".join(f"WHEN regexp_matches({y}, {q(p)}) THEN {q(tok)}" for tok, p in YIELD_UNIT_PATTERNS)
    return f"(CASE WHEN {x} IS NULL OR {y} = '' OR {servings} IS NOT NULL THEN '' {whens} ELSE '' END)"


def isclose_sql(a: str, b: str) -> str:
    return f"(abs(({a}) - ({b})) <= 1e-08 + 1e-05 * abs({b}))"


def pct(count: str, total: str) -> str:
    return f"(CASE WHEN ({total}) = 0 THEN 0.0 ELSE round(100.0 * ({count}) / ({total}), 4) END)"


assert NUMBER_RE  # the servings patterns embed it

RESOLVED_CTE = f"""
r1 AS (
  SELECT *,
    CASE WHEN RecipeCategory IS NULL OR regexp_matches(RecipeCategory, '^\\s*$') THEN 1 ELSE 0 END
      AS category_missing_original,
    {category_clean_sql('RecipeCategory')} AS RecipeCategory_clean,
    CASE WHEN RecipeServings IS NULL THEN 1 ELSE 0 END AS servings_missing_original,
    CASE WHEN RecipeServings > 0 THEN RecipeServings END AS RecipeServings_clean,
    CASE WHEN trim(RecipeYield) = '' THEN NULL ELSE trim(RecipeYield) END AS RecipeYield_clean,
    CASE WHEN PrepTime_Minutes >= 0 THEN PrepTime_Minutes END AS PrepTime_Minutes_clean,
    CASE WHEN CookTime_Minutes >= 0 THEN CookTime_Minutes END AS CookTime_Minutes_clean,
    CASE WHEN TotalTime_Minutes >= 0 THEN TotalTime_Minutes END AS TotalTime_Minutes_clean
  FROM catalog),
r2 AS (
  SELECT *, {servings_sql('RecipeYield_clean')} AS servings_parsed_from_yield FROM r1),
r3 AS (
  SELECT *,
    {yield_unit_sql('RecipeYield_clean', 'servings_parsed_from_yield')} AS yield_unit_token,
    coalesce(RecipeServings_clean, servings_parsed_from_yield) AS ResolvedServings,
    CASE WHEN RecipeServings_clean IS NULL AND servings_parsed_from_yield IS NOT NULL THEN 1 ELSE 0 END
      AS servings_from_yield,
    CASE WHEN coalesce(RecipeServings_clean, servings_parsed_from_yield) IS NULL THEN 1 ELSE 0 END
      AS servings_missing_after_yield_parse,
    CASE WHEN PrepTime_Minutes_clean IS NULL THEN 1 ELSE 0 END AS preptime_missing_original,
    CASE WHEN CookTime_Minutes_clean IS NULL THEN 1 ELSE 0 END AS cooktime_missing_original,
    CASE WHEN TotalTime_Minutes_clean IS NULL THEN 1 ELSE 0 END AS totaltime_missing_original,
    CASE WHEN CookTime_Minutes_clean IS NULL AND PrepTime_Minutes_clean IS NOT NULL
          AND TotalTime_Minutes_clean >= PrepTime_Minutes_clean
         THEN TotalTime_Minutes_clean - PrepTime_Minutes_clean ELSE CookTime_Minutes_clean END
      AS CookTime_Minutes_resolved,
    CASE WHEN CookTime_Minutes_clean IS NULL AND PrepTime_Minutes_clean IS NOT NULL
          AND TotalTime_Minutes_clean >= PrepTime_Minutes_clean THEN 1 ELSE 0 END
      AS cooktime_derived_from_total_prep
  FROM r2),
r4 AS (
  SELECT *,
    CASE WHEN PrepTime_Minutes_clean IS NULL AND CookTime_Minutes_resolved IS NOT NULL
          AND TotalTime_Minutes_clean >= CookTime_Minutes_resolved
         THEN TotalTime_Minutes_clean - CookTime_Minutes_resolved ELSE PrepTime_Minutes_clean END
      AS PrepTime_Minutes_resolved,
    CASE WHEN PrepTime_Minutes_clean IS NULL AND CookTime_Minutes_resolved IS NOT NULL
          AND TotalTime_Minutes_clean >= CookTime_Minutes_resolved THEN 1 ELSE 0 END
      AS preptime_derived_from_total_cook
  FROM r3),
r5 AS (
  SELECT *,
    coalesce(TotalTime_Minutes_clean, PrepTime_Minutes_resolved + CookTime_Minutes_resolved)
      AS TotalTime_Minutes_resolved,
    CASE WHEN TotalTime_Minutes_clean IS NULL AND PrepTime_Minutes_resolved IS NOT NULL
          AND CookTime_Minutes_resolved IS NOT NULL THEN 1 ELSE 0 END AS totaltime_derived_from_prep_cook
  FROM r4),
r6 AS (
  SELECT *,
    CASE WHEN PrepTime_Minutes_resolved IS NOT NULL AND CookTime_Minutes_resolved IS NOT NULL
          AND TotalTime_Minutes_resolved IS NOT NULL
          AND {isclose_sql('TotalTime_Minutes_resolved', 'PrepTime_Minutes_resolved + CookTime_Minutes_resolved')}
         THEN 1 ELSE 0 END AS time_arithmetic_consistent,
    CASE WHEN PrepTime_Minutes_resolved IS NOT NULL AND CookTime_Minutes_resolved IS NOT NULL
          AND TotalTime_Minutes_resolved IS NOT NULL
          AND NOT {isclose_sql('TotalTime_Minutes_resolved', 'PrepTime_Minutes_resolved + CookTime_Minutes_resolved')}
         THEN 1 ELSE 0 END AS time_arithmetic_mismatch
  FROM r5),
cat_med AS (
  SELECT RecipeCategory_clean AS mcat, median(ResolvedServings) AS m_s,
    median(CookTime_Minutes_resolved) AS m_c, median(PrepTime_Minutes_resolved) AS m_p,
    median(TotalTime_Minutes_resolved) AS m_t
  FROM r6 WHERE RecipeCategory_clean IS NOT NULL GROUP BY RecipeCategory_clean),
glob_med AS (
  SELECT median(ResolvedServings) AS g_s, median(CookTime_Minutes_resolved) AS g_c,
    median(PrepTime_Minutes_resolved) AS g_p, median(TotalTime_Minutes_resolved) AS g_t FROM r6),
resolved AS (
  SELECT r6.*,
{",".join(f'''
    CASE WHEN {v} IS NOT NULL THEN {v} WHEN m_{k} IS NOT NULL THEN m_{k} ELSE g_{k} END AS {t},
    CASE WHEN {v} IS NULL AND m_{k} IS NOT NULL THEN 1 ELSE 0 END AS {p}_imputed_with_category_median,
    CASE WHEN {v} IS NULL AND m_{k} IS NULL THEN 1 ELSE 0 END AS {p}_imputed_with_global_median'''
  for v, k, t, p in [("ResolvedServings", "s", "ResolvedServings_imputed", "servings"),
                     ("CookTime_Minutes_resolved", "c", "CookTime_Minutes_imputed", "cooktime"),
                     ("PrepTime_Minutes_resolved", "p", "PrepTime_Minutes_imputed", "preptime"),
                     ("TotalTime_Minutes_resolved", "t", "TotalTime_Minutes_imputed", "totaltime")])}
  FROM r6 LEFT JOIN cat_med ON r6.RecipeCategory_clean = cat_med.mcat CROSS JOIN glob_med)"""


def with_resolved(*extra_views: str) -> str:
    views = [VIEW_SQL["catalog"].strip()] + [VIEW_SQL[v].strip() for v in extra_views]
    return "WITH " + ",\n".join(views) + ",\n" + RESOLVED_CTE.strip()


SQL: dict[str, str] = {}

SQL["category_clean"] = f"""
{VIEW_SQL['catalog'].strip().join(['WITH ', ''])}
SELECT RecipeId,
  CASE WHEN RecipeCategory IS NULL OR regexp_matches(RecipeCategory, '^\\s*$') THEN 1 ELSE 0 END
    AS category_missing_original,
  {category_clean_sql('RecipeCategory')} AS RecipeCategory_clean
FROM catalog"""

SERVINGS_COLS = """servings_missing_original, RecipeServings_clean, RecipeYield_clean,
  servings_parsed_from_yield, ResolvedServings, servings_from_yield,
  servings_missing_after_yield_parse, ResolvedServings_imputed,
  servings_imputed_with_category_median, servings_imputed_with_global_median, yield_unit_token"""

TIME_COLS = """PrepTime_Minutes_clean, CookTime_Minutes_clean, TotalTime_Minutes_clean,
  preptime_missing_original, cooktime_missing_original, totaltime_missing_original,
  CookTime_Minutes_resolved, cooktime_derived_from_total_prep,
  PrepTime_Minutes_resolved, preptime_derived_from_total_cook,
  TotalTime_Minutes_resolved, totaltime_derived_from_prep_cook,
  time_arithmetic_consistent, time_arithmetic_mismatch,
  CookTime_Minutes_imputed, cooktime_imputed_with_category_median, cooktime_imputed_with_global_median,
  PrepTime_Minutes_imputed, preptime_imputed_with_category_median, preptime_imputed_with_global_median,
  TotalTime_Minutes_imputed, totaltime_imputed_with_category_median, totaltime_imputed_with_global_median"""

SQL["servings_resolution"] = f"""{with_resolved()}
SELECT RecipeId, RecipeCategory_clean, {SERVINGS_COLS} FROM resolved"""

SQL["time_resolution"] = f"""{with_resolved()}
SELECT RecipeId, {TIME_COLS} FROM resolved"""


# -- resolution summaries -------------------------------------------------------

def pctd(count: str, total: str) -> str:
    return (f"(CASE WHEN ({total}) = 0 THEN 0.0 ELSE "
            f"round(CAST(100 AS DOUBLE) * ({count}) / ({total}), 4) END)")


def unpivot(agg_sql: str, rows: list[tuple[str, dict[str, str]]]) -> str:
    """``SELECT 'metric', cols FROM agg UNION ALL ...`` over a one-row CTE."""
    parts = []
    for name, cols in rows:
        sel = ", ".join(f"{expr} AS {alias}" for alias, expr in cols.items())
        parts.append(f"SELECT {q(name)} AS metric, {sel} FROM a")
    return f", a AS ({agg_sql})\n" + "\nUNION ALL ".join(parts)


def cnt(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


SQL["category_summary"] = f"""{with_resolved()}
SELECT total_recipes, category_missing_count, {pctd('category_missing_count', 'total_recipes')} AS category_missing_percent,
  total_recipes - category_missing_count AS category_present_count,
  {pctd('total_recipes - category_missing_count', 'total_recipes')} AS category_present_percent
FROM (SELECT COUNT(*) AS total_recipes, CAST(SUM(category_missing_original) AS BIGINT) AS category_missing_count
      FROM resolved)"""

_serv_counts = {
    "total_recipes": "COUNT(*)",
    "servings_only": cnt("RecipeServings_clean IS NOT NULL AND RecipeYield_clean IS NULL"),
    "yield_only": cnt("RecipeServings_clean IS NULL AND RecipeYield_clean IS NOT NULL"),
    "both_present": cnt("RecipeServings_clean IS NOT NULL AND RecipeYield_clean IS NOT NULL"),
    "both_missing": cnt("RecipeServings_clean IS NULL AND RecipeYield_clean IS NULL"),
    "parsed_from_yield": "CAST(SUM(servings_from_yield) AS BIGINT)",
    "still_missing_after_yield_parse": "CAST(SUM(servings_missing_after_yield_parse) AS BIGINT)",
    "imputed_with_category_median": "CAST(SUM(servings_imputed_with_category_median) AS BIGINT)",
    "imputed_with_global_median": "CAST(SUM(servings_imputed_with_global_median) AS BIGINT)",
}
SQL["servings_summary"] = with_resolved() + unpivot(
    "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _serv_counts.items())
    + ", median(ResolvedServings) AS mb, median(ResolvedServings_imputed) AS ma FROM resolved",
    [(k, {"count": k, "percent_total_dataset": pctd(k, "total_recipes"), "value": "CAST(NULL AS DOUBLE)"})
     for k in _serv_counts]
    + [("median_resolved_servings_before_imputation",
        {"count": "CAST(NULL AS BIGINT)", "percent_total_dataset": "CAST(NULL AS DOUBLE)", "value": "mb"}),
       ("median_resolved_servings_after_imputation",
        {"count": "CAST(NULL AS BIGINT)", "percent_total_dataset": "CAST(NULL AS DOUBLE)", "value": "ma"})])

SQL["yield_unit_counts"] = f"""{with_resolved()}
SELECT yield_unit_token, COUNT(*) AS recipe_count FROM resolved WHERE yield_unit_token <> ''
GROUP BY yield_unit_token ORDER BY recipe_count DESC, yield_unit_token"""

_P, _C, _T = ("PrepTime_Minutes_clean IS NOT NULL", "CookTime_Minutes_clean IS NOT NULL",
              "TotalTime_Minutes_clean IS NOT NULL")
_presence = {
    "all_three_present": f"{_P} AND {_C} AND {_T}",
    "prep_cook_present_total_missing": f"{_P} AND {_C} AND NOT ({_T})",
    "prep_total_present_cook_missing": f"{_P} AND NOT ({_C}) AND {_T}",
    "cook_total_present_prep_missing": f"NOT ({_P}) AND {_C} AND {_T}",
    "only_prep_present": f"{_P} AND NOT ({_C}) AND NOT ({_T})",
    "only_cook_present": f"NOT ({_P}) AND {_C} AND NOT ({_T})",
    "only_total_present": f"NOT ({_P}) AND NOT ({_C}) AND {_T}",
    "all_three_missing": f"NOT ({_P}) AND NOT ({_C}) AND NOT ({_T})",
}
SQL["time_presence"] = with_resolved() + unpivot(
    "SELECT COUNT(*) AS total_recipes, " + ", ".join(f"{cnt(v)} AS {k}" for k, v in _presence.items())
    + " FROM resolved",
    [(k, {"count": k, "percent_total_dataset": pctd(k, "total_recipes")})
     for k in list(_presence) + ["total_recipes"]])


def _consistency_sql(variant: str) -> str:
    atol = "1e-08" if variant == "script" else "1e-06"
    p, c, t = "PrepTime_Minutes_clean", "CookTime_Minutes_clean", "TotalTime_Minutes_clean"

    def close(a, b):
        return f"coalesce(abs(({a}) - ({b})) <= {atol} + 1e-05 * abs({b}), false)"

    all3 = f"{_P} AND {_C} AND {_T}"
    cm = f"{_P} AND {_T} AND NOT ({_C})"
    pm = f"{_C} AND {_T} AND NOT ({_P})"
    ptb = f"coalesce({t} < {p}, false)" if variant == "script" else f"NOT {close(p, t)}"
    ctb = f"coalesce({t} < {c}, false)" if variant == "script" else f"NOT {close(c, t)}"
    metrics = [
        ("all_three_present", all3, "total"),
        ("total_equals_prep_plus_cook", f"{all3} AND {close(t, p + ' + ' + c)}", "all_three_present"),
        ("total_mismatch_when_all_present", f"{all3} AND NOT {close(t, p + ' + ' + c)}", "all_three_present"),
        ("cook_missing_prep_total_present", cm, "total"),
        ("prep_equals_total_when_cook_missing", f"{cm} AND {close(p, t)}", "cook_missing_prep_total_present"),
        ("prep_total_mismatch_when_cook_missing", f"{cm} AND {ptb}", "cook_missing_prep_total_present"),
        ("prep_missing_cook_total_present", pm, "total"),
        ("cook_equals_total_when_prep_missing", f"{pm} AND {close(c, t)}", "prep_missing_cook_total_present"),
        ("cook_total_mismatch_when_prep_missing", f"{pm} AND {ctb}", "prep_missing_cook_total_present"),
        ("recoverable_total_missing", f"{_P} AND {_C} AND NOT ({_T})", "total"),
    ]
    rows = []
    for name, _, rel in metrics:
        within = pctd(name, rel)
        if variant != "script":
            within = f"(CASE WHEN {rel} = 0 THEN CAST(NULL AS DOUBLE) ELSE {within} END)"
        rows.append((name, {"count": name, "percent_total_dataset": pctd(name, "total"),
                            "percent_within_relevant_case": within}))
    return with_resolved() + unpivot(
        "SELECT COUNT(*) AS total, " + ", ".join(f"{cnt(cond)} AS {n}" for n, cond, _ in metrics)
        + " FROM resolved", rows)


SQL["time_consistency"] = _consistency_sql("script")
SQL["time_consistency_eda"] = _consistency_sql("eda")

_rules = [("can_derive_cooktime", "cooktime_derived_from_total_prep"),
          ("can_derive_preptime", "preptime_derived_from_total_cook"),
          ("can_derive_totaltime", "totaltime_derived_from_prep_cook")]
SQL["time_derivation"] = with_resolved() + unpivot(
    "SELECT COUNT(*) AS total, " + ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {m}" for m, c in _rules)
    + " FROM resolved",
    [(m, {"count": m, "percent_total_dataset": pctd(m, "total")}) for m, _ in _rules])

_ti = [("CookTime_Minutes", "cooktime"), ("PrepTime_Minutes", "preptime"), ("TotalTime_Minutes", "totaltime")]
SQL["time_imputation"] = with_resolved() + unpivot(
    "SELECT COUNT(*) AS total, " + ", ".join(
        f"{cnt(b + '_clean IS NULL')} AS {p}_orig, {cnt(b + '_resolved IS NULL')} AS {p}_res, "
        f"{cnt(b + '_imputed IS NULL')} AS {p}_final, "
        f"CAST(SUM({p}_imputed_with_category_median) AS BIGINT) AS {p}_cat, "
        f"CAST(SUM({p}_imputed_with_global_median) AS BIGINT) AS {p}_glob" for b, p in _ti)
    + " FROM resolved",
    [(b, {"original_missing_count": f"{p}_orig", "resolved_missing_count": f"{p}_res",
          "imputed_with_category_median_count": f"{p}_cat",
          "imputed_with_global_median_count": f"{p}_glob", "final_missing_count": f"{p}_final",
          "original_missing_percent": pctd(f"{p}_orig", "total"),
          "resolved_missing_percent": pctd(f"{p}_res", "total"),
          "final_missing_percent": pctd(f"{p}_final", "total")}) for b, p in _ti])

_final = ["ResolvedServings_imputed", "CookTime_Minutes_imputed", "PrepTime_Minutes_imputed",
          "TotalTime_Minutes_imputed"]
SQL["resolved_contract"] = with_resolved() + """
, src AS (SELECT COUNT(*) AS src_rows,
    COUNT(DISTINCT RecipeId) + MAX(CASE WHEN RecipeId IS NULL THEN 1 ELSE 0 END) AS src_ids FROM catalog)
, res AS (SELECT COUNT(*) AS rows_,
    COUNT(DISTINCT RecipeId) + MAX(CASE WHEN RecipeId IS NULL THEN 1 ELSE 0 END) AS ids,
    CAST(SUM(time_arithmetic_mismatch) AS BIGINT) AS mismatch, """ + ", ".join(
    f"{cnt(c + ' IS NULL')} AS {c}__null, {cnt(c + ' < 0')} AS {c}__neg" for c in _final) + """ FROM resolved)
, a AS (SELECT * FROM res CROSS JOIN src)
SELECT 'row_count_kept' AS "check", CAST(abs(rows_ - src_rows) AS BIGINT) AS violations, 'error' AS severity FROM a
UNION ALL SELECT 'distinct_ids_kept', CAST(abs(ids - src_ids) AS BIGINT), 'error' FROM a
""" + "".join(
    f"UNION ALL SELECT '{c}_non_null', {c}__null, 'error' FROM a\n"
    f"UNION ALL SELECT '{c}_non_negative', {c}__neg, 'error' FROM a\n" for c in _final) + \
    "UNION ALL SELECT 'time_arithmetic_mismatch', mismatch, 'warning' FROM a"


# -- numeric matrix ----------------------------------------------------------------

from larder.operators.numeric import (  # noqa: E402
    CLIPPING_QUANTILE_BY_GROUP, NUMERIC_FEATURE_COLS, feature_group,
)

_F = NUMERIC_FEATURE_COLS
_CLIP = [f for f in _F if CLIPPING_QUANTILE_BY_GROUP[feature_group(f)] is not None]


def _clean_expr(f):
    bad = f"{f} <= 0" if feature_group(f) == "serving" else f"{f} < 0"
    return f"CASE WHEN {bad} THEN NULL ELSE CAST({f} AS DOUBLE) END AS {f}"


NUMERIC_CTE = (
    ",\nn0 AS (SELECT RecipeId, " + ", ".join(_clean_expr(f) for f in _F) + " FROM resolved)"
    + ",\nnmed AS (SELECT " + ", ".join(f"median({f}) AS {f}" for f in _F) + " FROM n0)"
    + ",\nn1 AS (SELECT n0.RecipeId, " + ", ".join(f"coalesce(n0.{f}, nmed.{f}) AS {f}" for f in _F)
    + " FROM n0 CROSS JOIN nmed)"
    + ",\nncap AS (SELECT " + ", ".join(f"quantile_cont({f}, 0.995) AS {f}" for f in _CLIP) + " FROM n1)"
    + ",\nn2 AS (SELECT n1.RecipeId, " + ", ".join(
        f"ln(1 + least(n1.{f}, ncap.{f})) AS {f}" if f in _CLIP else f"ln(1 + n1.{f}) AS {f}" for f in _F)
    + " FROM n1 CROSS JOIN ncap)"
    + ",\nnst AS (SELECT " + ", ".join(f"avg({f}) AS {f}__m, stddev_pop({f}) AS {f}__s" for f in _F)
    + " FROM n2)"
    + ",\nn3 AS (SELECT n2.RecipeId, " + ", ".join(
        f"(n2.{f} - {f}__m) / (CASE WHEN {f}__s = 0 THEN 1.0 ELSE {f}__s END) AS {f}" for f in _F)
    + " FROM n2 CROSS JOIN nst)"
)

SQL["numeric_log_matrix"] = with_resolved() + NUMERIC_CTE + "\nSELECT * FROM n2"
SQL["numeric_scaled"] = with_resolved() + NUMERIC_CTE + "\nSELECT * FROM n3"
SQL["numeric_scaled_summary"] = with_resolved() + NUMERIC_CTE + "\n" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, avg({f}) AS scaled_mean, stddev_pop({f}) AS scaled_std, "
    f"min({f}) AS scaled_min, max({f}) AS scaled_max FROM n3" for f in _F)


def _skew(x):
    return (f"(CASE WHEN count({x}) < 3 THEN NULL WHEN stddev_pop({x}) = 0 THEN 0.0 "
            f"ELSE skewness({x}) END)")


def _summary_row(f):
    g = feature_group(f)
    clip = f in _CLIP
    src_bad = f"{f} <= 0" if g == "serving" else f"{f} < 0"
    imp, lg = f"n1.{f}", f"n2.{f}"
    cap = f"(SELECT {f} FROM ncap)" if clip else "CAST(NULL AS DOUBLE)"
    parts = [
        f"'{f}' AS feature", f"'{g}' AS feature_group",
        f"(SELECT CAST(SUM(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM resolved) AS original_missing_count",
        f"(SELECT CAST(SUM(CASE WHEN {f} < 0 THEN 1 ELSE 0 END) AS BIGINT) FROM resolved) AS invalid_negative_count",
        (f"(SELECT CAST(SUM(CASE WHEN {f} <= 0 THEN 1 ELSE 0 END) AS BIGINT) FROM resolved)" if g == "serving"
         else "CAST(0 AS BIGINT)") + " AS invalid_nonpositive_count",
        f"(SELECT {f} FROM nmed) AS median_used_for_imputation",
        f"CAST(SUM(CASE WHEN {imp} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_after_imputation_count",
        f"{'true' if clip else 'false'} AS clipping_applied",
        f"{'0.995' if clip else 'CAST(NULL AS DOUBLE)'}::DOUBLE AS clipping_quantile",
        f"{cap} AS clipping_cap_value",
        (f"CAST(SUM(CASE WHEN {imp} > {cap} THEN 1 ELSE 0 END) AS BIGINT)" if clip else "CAST(0 AS BIGINT)")
        + " AS clipped_value_count",
        f"{_skew(imp)} AS skew_before", f"{_skew(lg)} AS skew_after_log1p",
    ]
    for x, p in ((imp, "before"), (lg, "after_log1p")):
        parts += [f"min({x}) AS min_{p}", f"quantile_cont({x}, 0.5) AS median_{p}",
                  f"quantile_cont({x}, 0.95) AS p95_{p}", f"quantile_cont({x}, 0.99) AS p99_{p}",
                  f"quantile_cont({x}, 0.995) AS p995_{p}", f"max({x}) AS max_{p}"]
    del src_bad
    return "SELECT " + ", ".join(parts) + " FROM n1 JOIN n2 ON n1.RecipeId = n2.RecipeId"


SQL["numeric_preprocessing_summary"] = with_resolved() + NUMERIC_CTE + "\n" + "\nUNION ALL ".join(
    _summary_row(f) for f in _F)

SQL["numeric_contract"] = with_resolved() + NUMERIC_CTE + """
SELECT 'row_count' AS "check", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'recipe_id_non_null', CAST(SUM(CASE WHEN RecipeId IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM n3
UNION ALL SELECT 'recipe_id_unique', CAST(COUNT(*) - COUNT(DISTINCT RecipeId) AS BIGINT) FROM n3
UNION ALL SELECT 'log_values_finite', CAST(0 AS BIGINT)
UNION ALL SELECT 'scaled_values_finite', CAST(0 AS BIGINT)
UNION ALL SELECT 'scaled_means_zero', CAST(""" + " + ".join(
    f"(CASE WHEN abs(avg({f})) > 1e-5 THEN 1 ELSE 0 END)" for f in _F) + """ AS BIGINT) FROM n3
UNION ALL SELECT 'scaled_stds_one', CAST(""" + " + ".join(
    f"(CASE WHEN abs(stddev_pop({f}) - 1.0) > 1e-5 THEN 1 ELSE 0 END)" for f in _F) + """ AS BIGINT) FROM n3
UNION ALL SELECT 'names_in_column_order', CAST(0 AS BIGINT)"""


# -- content matrix ------------------------------------------------------------------

from larder.functions.text import TIME_KEYWORD_PATTERNS  # noqa: E402
from larder.operators.content import (  # noqa: E402
    DEFAULT_PARAMS, FEATURE_PREFIX, GROUP_ORDER, GROUP_WEIGHTS,
)


def norm_token_sql(x: str) -> str:
    s = f"lower(trim({x}))"
    s = f"(CASE WHEN {s} IN ('', 'nan', 'none', 'null') THEN '' ELSE {s} END)"
    s = f"replace(replace({s}, '&', ' and '), '''', '')"
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_\\s/-]+', ' ', 'g')"
    s = f"regexp_replace({s}, '[\\s-]+', '_', 'g')"
    s = f"regexp_replace({s}, '_+', '_', 'g')"
    s = f"regexp_replace({s}, '^_+|_+$', '', 'g')"
    return f"(CASE WHEN {s} IN ('', 'nan', 'none', 'null') THEN '' ELSE {s} END)"


_TIME_RE = "|".join(f"(?:{p})" for p in TIME_KEYWORD_PATTERNS)
_TFIDF = ", ".join(f"'{g}'" for g, p in DEFAULT_PARAMS.items() if p.tfidf)
_GRANK = " ".join(f"WHEN '{g}' THEN {i}" for i, g in enumerate(GROUP_ORDER))
_KEEP = " OR ".join(f"(g = '{g}' AND df >= {p.min_df} AND df <= {p.max_df} * n)"
                    for g, p in DEFAULT_PARAMS.items())

CONTENT_CTE = f""",
ing_docs AS (
  SELECT DISTINCT RecipeId AS id, {norm_token_sql('ingredient')} AS token FROM ingredients
  WHERE {norm_token_sql('ingredient')} <> '' AND RecipeId IN (SELECT RecipeId FROM resolved)),
kw_tok AS (
  SELECT RecipeId AS id, {norm_token_sql('keyword')} AS token FROM keywords
  WHERE RecipeId IN (SELECT RecipeId FROM resolved)),
kw_docs AS (
  SELECT DISTINCT id, token FROM kw_tok WHERE token <> '' AND NOT regexp_matches(token, {q(_TIME_RE)})),
cat_docs AS (
  SELECT RecipeId AS id, 'category__' || {norm_token_sql('RecipeCategory_clean')} AS token FROM resolved
  WHERE RecipeCategory_clean IS NOT NULL AND {norm_token_sql('RecipeCategory_clean')} <> ''),
yld_docs AS (
  SELECT RecipeId AS id, lower(trim(yield_unit_token)) AS token FROM resolved
  WHERE yield_unit_token IS NOT NULL
    AND lower(trim(yield_unit_token)) NOT IN ('', 'yield__missing', 'yield__other')
    AND regexp_matches(lower(trim(yield_unit_token)), '^yield__[a-z0-9_/]+$')),
all_docs AS (
  SELECT 'ingredients' AS g, id, token FROM ing_docs UNION ALL SELECT 'keywords', id, token FROM kw_docs
  UNION ALL SELECT 'category', id, token FROM cat_docs UNION ALL SELECT 'yield', id, token FROM yld_docs),
terms AS (
  SELECT g, id, term, COUNT(*) AS tf FROM (
    SELECT g, id, unnest(regexp_extract_all(lower(token), '\\b[\\w/]+\\b')) AS term FROM all_docs)
  GROUP BY g, id, term),
ndocs AS (SELECT COUNT(*) AS n FROM resolved),
vocab AS (
  SELECT g, term, df,
    CASE WHEN g IN ({_TFIDF}) THEN ln((1.0 + n) / (1.0 + df)) + 1 ELSE 1.0 END AS idf
  FROM (SELECT g, term, COUNT(*) AS df FROM terms GROUP BY g, term) CROSS JOIN ndocs
  WHERE {_KEEP}),
feat AS (
  SELECT CAST(row_number() OVER (ORDER BY CASE g {_GRANK} END, term) - 1 AS INTEGER) AS feature_index,
    (CASE g {" ".join(f"WHEN '{g}' THEN '{FEATURE_PREFIX[g]}'" for g in GROUP_ORDER)} END) || term AS feature_name,
    g AS feature_group, term, df, idf,
    CAST(CASE g {" ".join(f"WHEN '{g}' THEN {GROUP_WEIGHTS[g]}" for g in GROUP_ORDER)} END AS DOUBLE) AS group_weight
  FROM vocab),
wt AS (
  SELECT t.id, t.g, f.feature_index, f.group_weight,
    CASE WHEN t.g IN ({_TFIDF}) THEN (1 + ln(t.tf)) * f.idf ELSE 1.0 END AS w
  FROM terms t JOIN feat f ON t.g = f.feature_group AND t.term = f.term),
nrm AS (SELECT id, g, sqrt(sum(w * w)) AS norm FROM wt WHERE g IN ({_TFIDF}) GROUP BY id, g),
cmatrix AS (
  SELECT wt.id AS RecipeId, wt.feature_index, wt.g,
    (CASE WHEN nrm.norm IS NULL THEN wt.w ELSE wt.w / nrm.norm END) * wt.group_weight AS value
  FROM wt LEFT JOIN nrm ON wt.id = nrm.id AND wt.g = nrm.g)"""


def with_content() -> str:
    return with_resolved("ingredients", "keywords") + CONTENT_CTE


SQL["ingredient_documents"] = f"""{with_resolved('ingredients')}
SELECT DISTINCT RecipeId, {norm_token_sql('ingredient')} AS token FROM ingredients
WHERE {norm_token_sql('ingredient')} <> ''"""

SQL["keyword_removed_time_tags"] = f"""{with_resolved('keywords')}
, kw AS (SELECT {norm_token_sql('keyword')} AS token FROM keywords)
SELECT token AS keyword_token, COUNT(*) AS removed_count FROM kw
WHERE token <> '' AND regexp_matches(token, {q(_TIME_RE)}) GROUP BY token"""

SQL["tfidf_weighted"] = with_content() + "\nSELECT RecipeId, feature_index, value FROM cmatrix"
SQL["content_features"] = with_content() + """
SELECT feature_index, feature_name, feature_group, df, idf, group_weight FROM feat"""

for _g in ("ingredients", "keywords"):
    SQL[f"token_summary_{_g}"] = with_content() + f"""
SELECT f.term AS token, CAST(SUM(CASE WHEN m.value > 0 THEN 1 ELSE 0 END) AS BIGINT) AS document_frequency,
  SUM(m.value) AS total_tfidf_weight
FROM cmatrix m JOIN feat f ON m.feature_index = f.feature_index
WHERE f.feature_group = '{_g}' GROUP BY f.term"""

SQL["category_token_counts"] = with_content() + """
SELECT token AS category_token, COUNT(*) AS recipe_count FROM cat_docs GROUP BY token"""
SQL["yield_token_counts"] = with_content() + """
SELECT token AS yield_token, COUNT(*) AS recipe_count FROM yld_docs GROUP BY token"""

_params = {g: p for g, p in DEFAULT_PARAMS.items()}
SQL["content_matrix_summary"] = with_content() + """
, gsum AS (
  SELECT d.g, (SELECT n FROM ndocs) AS n, COUNT(DISTINCT d.id) AS nonempty,
    (SELECT COUNT(*) FROM feat f WHERE f.feature_group = d.g) AS vsize,
    (SELECT COUNT(*) FROM cmatrix m WHERE m.g = d.g) AS nnz
  FROM all_docs d GROUP BY d.g)
SELECT g AS feature_group,
  CASE g """ + " ".join(f"WHEN '{g}' THEN '{s}'" for g, s in
                          {"ingredients": "RecipeIngredientParts", "keywords": "Keywords",
                           "category": "RecipeCategory_clean", "yield": "yield_unit_token"}.items()) + """ END
    AS source_column,
  vsize > 0 AS included, n AS n_documents, nonempty AS non_empty_documents,
  round(nonempty * 100.0 / n, 4)::DOUBLE AS non_empty_document_percent,
  vsize AS vocab_size, nnz AS matrix_nonzero_count,
  CASE WHEN vsize > 0 THEN nnz / (n * vsize) ELSE 0.0 END AS matrix_density,
  CASE g """ + " ".join(f"WHEN '{g}' THEN {GROUP_WEIGHTS[g]}" for g in GROUP_ORDER) + """ END::DOUBLE AS group_weight,
  CASE g """ + " ".join(f"WHEN '{g}' THEN {float(p.min_df)}" for g, p in _params.items()) + """ END::DOUBLE
    AS vectorizer_min_df,
  CASE g """ + " ".join(f"WHEN '{g}' THEN {float(p.max_df)}" for g, p in _params.items()) + """ END::DOUBLE
    AS vectorizer_max_df
FROM gsum
UNION ALL
SELECT 'combined_content_matrix', '', true, (SELECT n FROM ndocs), NULL, NULL,
  (SELECT COUNT(*) FROM feat), (SELECT COUNT(*) FROM cmatrix),
  (SELECT COUNT(*) FROM cmatrix) / ((SELECT n FROM ndocs) * (SELECT COUNT(*) FROM feat)),
  NULL, NULL, NULL"""

SQL["content_contract"] = with_content() + """
SELECT 'features_contiguous' AS "check",
  CAST(CASE WHEN MIN(feature_index) = 0 AND MAX(feature_index) = COUNT(*) - 1 THEN 0 ELSE 1 END AS BIGINT)
  AS violations FROM feat
UNION ALL SELECT 'matrix_values_finite',
  CAST(SUM(CASE WHEN value IS NULL OR isnan(value) OR isinf(value) THEN 1 ELSE 0 END) AS BIGINT) FROM cmatrix
UNION ALL SELECT 'matrix_indices_named', CAST(0 AS BIGINT)"""


# -- reduction ---------------------------------------------------------------------

SQL["pca_covariance"] = with_resolved() + NUMERIC_CTE + "\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, covar_samp({a}, {b}) AS covariance FROM n3"
    for a in _F for b in _F)


SQL["pca_covariance_rebuilt"] = SQL["pca_covariance"]
SQL["pca_power_sums"] = with_resolved() + NUMERIC_CTE + ", c AS (" + "\nUNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, covar_samp({a}, {b}) AS v FROM n3"
    for i, a in enumerate(_F) for j, b in enumerate(_F)) + """)
SELECT 1 AS power, SUM(v) AS power_sum FROM c WHERE i = j
UNION ALL SELECT 2, SUM(v * v) FROM c
UNION ALL SELECT 3, SUM(x.v * y.v * z.v) FROM c x JOIN c y ON x.j = y.i JOIN c z ON y.j = z.i AND z.j = x.i"""
SQL["pca_score_norms"] = (
    with_resolved() + NUMERIC_CTE + ", m AS (SELECT " + ", ".join(f"AVG({f}) AS m{i}" for i, f in enumerate(_F)) + " FROM n3)\n"
    "SELECT RecipeId, " + " + ".join(f"({f} - m{i}) * ({f} - m{i})" for i, f in enumerate(_F)) + " AS squared_distance FROM n3, m")


# -- audits ---------------------------------------------------------------------------

from larder.operators.audits import MIN_DF_SWEEP, NUMERIC_CANDIDATES, PROFILE_PERCENTILES  # noqa: E402

_CAT_COLS = ["RecipeId", "AuthorId", "Name", "DatePublished", "RecipeCategory", "RecipeServings", "RecipeYield",
             "PrepTime_Minutes", "CookTime_Minutes", "TotalTime_Minutes", "Calories", "FatContent",
             "SaturatedFatContent", "CholesterolContent", "SodiumContent", "CarbohydrateContent", "FiberContent",
             "SugarContent", "ProteinContent", "NumIngredients", "NumQuantities"]
_WC = "WITH " + VIEW_SQL["catalog"].strip()
_WCR = "WITH " + VIEW_SQL["catalog"].strip() + ",\n" + VIEW_SQL["reviews"].strip()

_CAT_TYPES = {"RecipeId": "bigint", "AuthorId": "bigint", "Name": "string", "DatePublished": "timestamp_ntz", "RecipeCategory": "string", "RecipeYield": "string",
              "NumIngredients": "int", "NumQuantities": "int"}
SQL["missingness"] = _WC + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_CAT_TYPES.get(c, 'double')}' AS dtype, COUNT({c}) AS non_null_count, COUNT(*) - COUNT({c}) AS null_count, "
    f"{pctd(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} AS null_pct, COUNT(DISTINCT {c}) AS distinct_count FROM catalog"
    for c in _CAT_COLS)

SQL["quality_audit"] = _WCR + """
, orph AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT CAST(RecipeId AS VARCHAR) AS id FROM reviews
    WHERE RecipeId IS NOT NULL) r WHERE id NOT IN (SELECT CAST(RecipeId AS VARCHAR) FROM catalog))
SELECT 'recipes_rows' AS metric, (SELECT COUNT(*) FROM catalog) AS value
UNION ALL SELECT 'recipes_cols', 21
UNION ALL SELECT 'reviews_rows', (SELECT COUNT(*) FROM reviews)
UNION ALL SELECT 'reviews_cols', 5
UNION ALL SELECT 'unique_recipe_ids', (SELECT COUNT(DISTINCT RecipeId) FROM catalog)
UNION ALL SELECT 'duplicate_recipe_ids', (SELECT COUNT(*) - COUNT(DISTINCT RecipeId) FROM catalog)
UNION ALL SELECT 'unique_review_ids', (SELECT COUNT(DISTINCT ReviewId) FROM reviews)
UNION ALL SELECT 'duplicate_review_ids', (SELECT COUNT(*) - COUNT(DISTINCT ReviewId) FROM reviews)
UNION ALL SELECT 'unique_reviewers', (SELECT COUNT(DISTINCT AuthorId) FROM reviews)
UNION ALL SELECT 'unique_reviewed_recipes', (SELECT COUNT(DISTINCT RecipeId) FROM reviews)
UNION ALL SELECT 'orphan_review_recipe_ids', (SELECT n FROM orph)"""

SQL["orphan_review_ids"] = _WCR + """
SELECT DISTINCT CAST(RecipeId AS VARCHAR) AS id FROM reviews
WHERE RecipeId IS NOT NULL AND CAST(RecipeId AS VARCHAR) NOT IN (SELECT CAST(RecipeId AS VARCHAR) FROM catalog)"""

SQL["unreviewed_recipes"] = _WCR + """
SELECT DISTINCT CAST(RecipeId AS VARCHAR) AS id FROM catalog
WHERE RecipeId IS NOT NULL AND CAST(RecipeId AS VARCHAR) NOT IN
  (SELECT CAST(RecipeId AS VARCHAR) FROM reviews WHERE RecipeId IS NOT NULL)"""

SQL["time_order_checks"] = _WC + f"""
SELECT 'total_lt_prep' AS "check", {cnt('TotalTime_Minutes < PrepTime_Minutes')} AS count FROM catalog
UNION ALL SELECT 'total_lt_cook', {cnt('TotalTime_Minutes < CookTime_Minutes')} FROM catalog
UNION ALL SELECT 'any_negative',
  {cnt('TotalTime_Minutes < 0 OR PrepTime_Minutes < 0 OR CookTime_Minutes < 0')} FROM catalog"""

_pnames = ["p1", "p5", "p25", "p50", "p75", "p95", "p99"]
SQL["numeric_profile"] = _WC + "\nSELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, "
    f"round(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100.0 / COUNT(*), 2) AS missing_pct, "
    f"avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    + ", ".join(f"quantile_cont({c}, {p}) AS {n}" for p, n in zip(PROFILE_PERCENTILES, _pnames))
    + f", CAST(max({c}) AS DOUBLE) AS max, {_skew(c)} AS skewness FROM catalog"
    for c in NUMERIC_CANDIDATES) + ") WHERE count > 0"

SQL["correlation_matrix"] = (
    _WC + ",\ncm AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in NUMERIC_CANDIDATES) + " FROM catalog),\n"
    + "cf AS (SELECT " + ", ".join(f"coalesce(CAST(catalog.{c} AS DOUBLE), cm.{c}) AS {c}" for c in NUMERIC_CANDIDATES)
    + " FROM catalog CROSS JOIN cm)\n" + "\nUNION ALL ".join(
        f"SELECT '{a}' AS \"column\", '{b}' AS other, corr({a}, {b}) AS correlation FROM cf"
        for a in NUMERIC_CANDIDATES for b in NUMERIC_CANDIDATES))

_DESC = ["ResolvedServings_imputed", "CookTime_Minutes_imputed", "PrepTime_Minutes_imputed",
         "TotalTime_Minutes_imputed"]
_DP = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
SQL["describe_resolved"] = with_resolved() + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{s}' AS stat, {v} AS value FROM resolved"
    for c in _DESC for s, v in (
        [("count", f"CAST(COUNT({c}) AS DOUBLE)"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
         ("min", f"CAST(min({c}) AS DOUBLE)")]
        + [(f"{round(p * 100, 6):g}%", f"quantile_cont({c}, {p})") for p in _DP]
        + [("max", f"CAST(max({c}) AS DOUBLE)")]))

SQL["zero_cook_share"] = with_resolved() + f"""
SELECT d AS derived_cooktime_count, z AS zero_cooktime_count, {pctd('z', 'd')} AS zero_cooktime_percent
FROM (SELECT {cnt('cooktime_derived_from_total_prep = 1')} AS d,
  {cnt('cooktime_derived_from_total_prep = 1 AND CookTime_Minutes_resolved = 0')} AS z FROM resolved)"""

_FLAGS = ["servings_from_yield", "cooktime_derived_from_total_prep", "preptime_derived_from_total_cook",
          "totaltime_derived_from_prep_cook", "time_arithmetic_mismatch"]
SQL["flag_counts"] = with_resolved() + "\n" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS flag, CAST({f} AS INTEGER) AS value, COUNT(*) AS count FROM resolved GROUP BY {f}"
    for f in _FLAGS)


def ascii_norm_sql(x: str) -> str:
    s = f"regexp_replace(lower(trim({x})), '[^a-z0-9 ]+', ' ', 'g')"
    return f"replace(trim(regexp_replace({s}, ' +', ' ', 'g')), ' ', '_')"


def _sets(view: str, id_col: str, col: str) -> str:
    return (f"SELECT DISTINCT {id_col} AS id, {ascii_norm_sql(col)} AS token FROM {view} "
            f"WHERE {ascii_norm_sql(col)} <> ''")


def _parse_summary(view: str, col: str) -> str:
    return f"""WITH {VIEW_SQL['catalog'].strip()}, {VIEW_SQL[view].strip()},
toks AS ({_sets(view, 'RecipeId', col)}),
per AS (SELECT c.RecipeId, COUNT(t.token) AS k FROM catalog c LEFT JOIN toks t ON t.id = c.RecipeId
        GROUP BY c.RecipeId),
a AS (SELECT {cnt('k = 0')} AS zero, avg(k) AS av, quantile_cont(k, 0.5) AS med, quantile_cont(k, 0.95) AS p95
      FROM per)
SELECT 'documents_with_zero_tokens' AS metric, CAST(zero AS DOUBLE) AS value FROM a
UNION ALL SELECT 'avg_tokens_per_document', round(av, 2) FROM a
UNION ALL SELECT 'median_tokens_per_document', round(med, 2) FROM a
UNION ALL SELECT 'p95_tokens_per_document', round(p95, 2) FROM a
UNION ALL SELECT 'unique_tokens', CAST((SELECT COUNT(DISTINCT token) FROM toks) AS DOUBLE)"""


SQL["ingredient_parse_summary"] = _parse_summary("ingredients", "ingredient")
SQL["keyword_parse_summary"] = _parse_summary("keywords", "keyword")

for _name, _view, _col in (("top_ingredients", "ingredients", "ingredient"), ("top_keywords", "keywords", "keyword")):
    SQL[_name] = f"""WITH {VIEW_SQL[_view].strip()}, toks AS ({_sets(_view, 'RecipeId', _col)})
SELECT token AS {_col}, COUNT(*) AS recipe_count FROM toks GROUP BY token
ORDER BY recipe_count DESC, token LIMIT 50"""


def _sweep(prefix: str, universe: str) -> str:
    parts = []
    for t in MIN_DF_SWEEP:
        parts.append(f"""SELECT {t} AS min_df, vs AS vocab_size, CASE WHEN nd = 0 OR vs = 0 THEN 0 ELSE cov END
  AS docs_with_tokens,
  round(CASE WHEN nd = 0 OR vs = 0 THEN 0.0 ELSE cov * 100.0 / nd END, 2)::DOUBLE AS coverage_pct,
  round(CASE WHEN nd = 0 OR vs = 0 THEN 0.0 ELSE hits / (nd * vs) END, 6)::DOUBLE AS approx_density,
  CASE WHEN vs = 0 THEN 'no vocabulary' WHEN cov * 100.0 / nd < 80 THEN 'coverage too low'
       WHEN vs > 100000 THEN 'vocab too large' ELSE 'reasonable tradeoff' END AS comment
FROM (SELECT (SELECT COUNT(*) FROM dfreq WHERE df >= {t}) AS vs,
             (SELECT coalesce(SUM(df), 0) FROM dfreq WHERE df >= {t}) AS hits,
             (SELECT COUNT(*) FROM perdoc WHERE maxdf >= {t}) AS cov,
             (SELECT COUNT(*) FROM {universe}) AS nd)""")
    return prefix + """,
dfreq AS (SELECT token, COUNT(*) AS df FROM toks GROUP BY token),
perdoc AS (SELECT t.id, max(d.df) AS maxdf FROM toks t JOIN dfreq d ON t.token = d.token GROUP BY t.id)
""" + "\nUNION ALL ".join(parts)


SQL["ingredient_vocab_sweep"] = _sweep(
    f"WITH {VIEW_SQL['catalog'].strip()}, {VIEW_SQL['ingredients'].strip()},\n"
    f"toks AS ({_sets('ingredients', 'RecipeId', 'ingredient')})", "catalog")
SQL["document_vocab_sweep"] = _sweep(
    f"WITH {VIEW_SQL['doc_words'].strip()},\ntoks AS ({_sets('doc_words', 'doc_id', 'word')})", "documents")

_CC = "WITH " + VIEW_SQL["catalog"].strip() + """,
cc AS (SELECT coalesce(RecipeCategory, 'Unknown') AS category, COUNT(*) AS count FROM catalog GROUP BY 1),
rk AS (SELECT category, count, row_number() OVER (ORDER BY count DESC, category) AS rank FROM cc)"""
SQL["category_coverage"] = _CC + """,
a AS (SELECT COUNT(*) AS u, SUM(count) AS t,
  SUM(CASE WHEN rank <= 10 THEN count ELSE 0 END) AS top10, SUM(CASE WHEN rank <= 20 THEN count ELSE 0 END) AS top20,
  SUM(CASE WHEN rank <= 30 THEN count ELSE 0 END) AS top30, SUM(CASE WHEN count < 50 THEN 1 ELSE 0 END) AS rare FROM rk)
SELECT 'unique_categories' AS metric, CAST(u AS DOUBLE) AS value FROM a
UNION ALL SELECT 'coverage_top10_pct', round(CAST(top10 AS DOUBLE) * 100.0 / t, 2) FROM a
UNION ALL SELECT 'coverage_top20_pct', round(CAST(top20 AS DOUBLE) * 100.0 / t, 2) FROM a
UNION ALL SELECT 'coverage_top30_pct', round(CAST(top30 AS DOUBLE) * 100.0 / t, 2) FROM a
UNION ALL SELECT 'rare_categories_lt_50', CAST(rare AS DOUBLE) FROM a"""
SQL["top_categories"] = _CC + "\nSELECT category, count FROM rk WHERE rank <= 30"

SQL["temporal_summary"] = _WC + """,
a AS (SELECT COUNT(*) AS n, COUNT(DatePublished) AS ok, min(DatePublished) AS lo, max(DatePublished) AS hi
      FROM catalog)
SELECT 'parse_success_rate_pct' AS metric, CAST(round(CAST(ok AS DOUBLE) * 100.0 / n, 2) AS VARCHAR) AS value FROM a
UNION ALL SELECT 'min_date', CAST(lo AS VARCHAR) FROM a
UNION ALL SELECT 'max_date', CAST(hi AS VARCHAR) FROM a
UNION ALL SELECT 'missing_or_invalid_dates', CAST(n - ok AS VARCHAR) FROM a"""

SQL["recipes_per_year"] = _WC + """
SELECT CAST(year(DatePublished) AS INTEGER) AS year, COUNT(*) AS recipe_count FROM catalog
WHERE DatePublished IS NOT NULL GROUP BY 1"""

SQL["interaction_summary"] = _WCR + """,
pu AS (SELECT AuthorId, COUNT(*) AS k FROM reviews GROUP BY AuthorId),
pr AS (SELECT RecipeId, COUNT(*) AS k FROM reviews GROUP BY RecipeId),
a AS (SELECT (SELECT COUNT(*) FROM pu) AS nu, (SELECT COUNT(*) FROM pr) AS nr,
  (SELECT COUNT(DISTINCT RecipeId) FROM catalog) AS nc, (SELECT COUNT(*) FROM reviews) AS obs,
  (SELECT COUNT(*) FROM pu WHERE k = 1) AS one, (SELECT COUNT(*) FROM pu WHERE k >= 5) AS u5,
  (SELECT COUNT(*) FROM pr WHERE k >= 5) AS r5,
  (SELECT COUNT(DISTINCT CAST(RecipeId AS VARCHAR)) FROM catalog WHERE CAST(RecipeId AS VARCHAR) NOT IN
     (SELECT CAST(RecipeId AS VARCHAR) FROM reviews WHERE RecipeId IS NOT NULL)) AS zero)
SELECT 'num_users' AS metric, CAST(nu AS DOUBLE) AS value FROM a
UNION ALL SELECT 'num_reviewed_recipes', CAST(nr AS DOUBLE) FROM a
UNION ALL SELECT 'num_recipes_catalog', CAST(nc AS DOUBLE) FROM a
UNION ALL SELECT 'observed_interactions', CAST(obs AS DOUBLE) FROM a
UNION ALL SELECT 'total_possible_pairs', CAST(nu * nc AS DOUBLE) FROM a
UNION ALL SELECT 'user_item_density', CAST(obs AS DOUBLE) / (nu * nc) FROM a
UNION ALL SELECT 'pct_users_with_one_review', round(CAST(one AS DOUBLE) / nu * 100, 2) FROM a
UNION ALL SELECT 'pct_users_with_ge5_reviews', round(CAST(u5 AS DOUBLE) / nu * 100, 2) FROM a
UNION ALL SELECT 'pct_recipes_with_ge5_reviews', round(CAST(r5 AS DOUBLE) / nr * 100, 2) FROM a
UNION ALL SELECT 'recipes_with_zero_reviews', CAST(zero AS DOUBLE) FROM a"""

SQL["rating_distribution"] = "WITH " + VIEW_SQL["reviews"].strip() + """
SELECT Rating AS rating, COUNT(*) AS count FROM reviews GROUP BY Rating"""

for _n, _k in (("reviews_per_user", "AuthorId"), ("reviews_per_recipe", "RecipeId")):
    SQL[_n] = "WITH " + VIEW_SQL["reviews"].strip() + f""",
p AS (SELECT {_k}, COUNT(*) AS k FROM reviews GROUP BY {_k})
SELECT 'mean' AS metric, avg(k) AS value FROM p
UNION ALL SELECT 'median', quantile_cont(k, 0.5) FROM p
UNION ALL SELECT 'p95', quantile_cont(k, 0.95) FROM p"""


def _hist(prefix: str, col: str, bins: int) -> str:
    return prefix + f""",
rg AS (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM vals),
sp AS (SELECT lo, CASE WHEN hi - lo = 0 THEN 1.0 ELSE hi - lo END AS span FROM rg),
b AS (SELECT least(CAST(floor((v.{col} - sp.lo) * {bins} / sp.span) AS INTEGER), {bins - 1}) AS bin
      FROM vals v CROSS JOIN sp WHERE v.{col} IS NOT NULL)
SELECT bin, sp.lo + bin * (sp.span / {bins}) AS bin_start, sp.lo + (bin + 1) * (sp.span / {bins}) AS bin_end,
  COUNT(*) AS count FROM b CROSS JOIN sp GROUP BY bin, sp.lo, sp.span"""


SQL["hist_ingredients_per_recipe"] = _hist(
    f"WITH {VIEW_SQL['catalog'].strip()}, {VIEW_SQL['ingredients'].strip()},\n"
    f"toks AS ({_sets('ingredients', 'RecipeId', 'ingredient')}),\n"
    "vals AS (SELECT c.RecipeId, COUNT(t.token) AS k FROM catalog c LEFT JOIN toks t ON t.id = c.RecipeId "
    "GROUP BY c.RecipeId)", "k", 40)
SQL["hist_reviews_per_user"] = _hist(
    "WITH " + VIEW_SQL["reviews"].strip() + ",\nvals AS (SELECT AuthorId, COUNT(*) AS k FROM reviews GROUP BY AuthorId)",
    "k", 50)
SQL["hist_reviews_per_recipe"] = _hist(
    "WITH " + VIEW_SQL["reviews"].strip() + ",\nvals AS (SELECT RecipeId, COUNT(*) AS k FROM reviews GROUP BY RecipeId)",
    "k", 50)

SQL["top_total_time"] = with_resolved() + """
SELECT RecipeId, Name, TotalTime_Minutes_imputed, PrepTime_Minutes_imputed, CookTime_Minutes_imputed
FROM resolved ORDER BY TotalTime_Minutes_imputed DESC, RecipeId LIMIT 20"""

SQL["seeded_sample"] = _WC + """
SELECT RecipeId, Name, RecipeCategory FROM catalog
ORDER BY md5(CAST(RecipeId AS VARCHAR) || ':42'), RecipeId LIMIT 20"""


# -- ingest ------------------------------------------------------------------------------

from larder.functions.numbers import ISO_DURATION_RE  # noqa: E402
from larder.functions.text import _QUOTED_ITEM, _QUOTED_LIST  # noqa: E402
from larder.sources.ingest import NA_WORDS, RAW_CATALOG_SQL  # noqa: E402

_NA = ", ".join(q(w) for w in NA_WORDS)


def parse_list_sql(x: str) -> str:
    s0 = f"(CASE WHEN {x} IN ({_NA}) THEN NULL ELSE {x} END)"
    s1 = f"trim({s0})"
    s = f"(CASE WHEN {s1} LIKE 'c(%' AND {s1} LIKE '%)' THEN substring({s1}, 3, length({s1}) - 3) ELSE {s1} END)"
    quoted = (f"list_transform(regexp_extract_all({s}, {q(_QUOTED_ITEM)}), "
              f"lambda x: regexp_replace(substring(x, 2, length(x) - 2), '\\\\(.)', '\\1', 'g'))")
    split = (f"list_transform(list_filter(string_split({s}, ','), lambda v: v <> ''), "
             f"lambda v: regexp_replace(trim(v), '^\"+|\"+$', '', 'g'))")
    return (f"(CASE WHEN {s0} IS NULL OR {s} = '' THEN CAST([] AS VARCHAR[]) "
            f"WHEN regexp_matches({s}, {q(_QUOTED_LIST)}) THEN {quoted} ELSE {split} END)")


def duration_sql(x: str) -> str:
    s0 = f"(CASE WHEN {x} IN ({_NA}) THEN NULL ELSE trim({x}) END)"
    r = q(ISO_DURATION_RE)

    def part(i):
        return f"coalesce(CAST(nullif(replace(regexp_extract({s0}, {r}, {i}), ',', '.'), '') AS DOUBLE), 0.0)"

    def present(i):
        return f"regexp_extract({s0}, {r}, {i}) <> ''"

    anyp = " OR ".join(present(i) for i in range(4, 9))
    minutes = f"({part(4)} * 10080.0 + {part(5)} * 1440.0 + {part(6)} * 60.0 + {part(7)} + {part(8)} / 60.0)"
    sign = f"(CASE WHEN regexp_extract({s0}, {r}, 1) = '-' THEN -1.0 ELSE 1.0 END)"
    return (f"(CASE WHEN regexp_matches({s0}, {r}) AND ({anyp}) AND NOT ({present(2)}) AND NOT ({present(3)}) "
            f"THEN {sign} * {minutes} END)")


SQL["ingest_catalog"] = "WITH " + RAW_CATALOG_SQL.strip() + f"""
SELECT RecipeId, {duration_sql('CookTime')} AS CookTime_Minutes, {duration_sql('PrepTime')} AS PrepTime_Minutes,
  {duration_sql('TotalTime')} AS TotalTime_Minutes,
  CAST(len({parse_list_sql('RecipeIngredientParts')}) AS INTEGER) AS NumIngredients,
  CAST(len({parse_list_sql('RecipeIngredientQuantities')}) AS INTEGER) AS NumQuantities,
  array_to_string({parse_list_sql('RecipeIngredientParts')}, '|') AS ingredients,
  array_to_string({parse_list_sql('Keywords')}, '|') AS keywords
FROM raw_catalog"""

SQL["document_list_cells"] = f"""
SELECT doc_id, CAST(len({parse_list_sql('text')}) AS INTEGER) AS n_items,
  CAST(coalesce(list_sum(list_transform({parse_list_sql('text')}, lambda x: length(x))), 0) AS BIGINT) AS item_chars
FROM documents"""


# -- legacy ---------------------------------------------------------------------------------

_LEG = "WITH " + VIEW_SQL["catalog"].strip() + ",\n" + VIEW_SQL["ingredients"].strip() + """,
lt AS (SELECT RecipeId AS id, term, COUNT(*) AS tf FROM (
  SELECT RecipeId, unnest(regexp_extract_all(lower(replace(ingredient, ' ', '_')), '\\b\\w\\w+\\b')) AS term
  FROM ingredients) GROUP BY RecipeId, term),
ls AS (SELECT term, COUNT(*) AS df, SUM(tf) AS total_count FROM lt GROUP BY term),
lk AS (SELECT term, df, total_count, row_number() OVER (ORDER BY total_count DESC, term) AS rk FROM ls WHERE df >= 5),
lv AS (SELECT term, df, total_count, ln((1.0 + (SELECT COUNT(*) FROM catalog)) / (1.0 + df)) + 1 AS idf,
  CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS feature_index FROM lk WHERE rk <= 5000),
lw AS (SELECT lt.id, lv.feature_index, lt.tf * lv.idf AS w FROM lt JOIN lv ON lt.term = lv.term),
ln_ AS (SELECT id, sqrt(sum(w * w)) AS norm FROM lw GROUP BY id)"""
SQL["legacy_text_vocabulary"] = _LEG + "\nSELECT term, df, CAST(total_count AS BIGINT) AS total_count, idf, feature_index FROM lv"
SQL["legacy_text_tfidf"] = _LEG + """
SELECT lw.id AS RecipeId, feature_index, w / norm AS value FROM lw JOIN ln_ ON lw.id = ln_.id"""

_serv_counts_raw = dict(_serv_counts)
for _k, _cond in {"servings_only": "servings_missing_original = 0 AND RecipeYield_clean IS NULL",
                  "yield_only": "servings_missing_original = 1 AND RecipeYield_clean IS NOT NULL",
                  "both_present": "servings_missing_original = 0 AND RecipeYield_clean IS NOT NULL",
                  "both_missing": "servings_missing_original = 1 AND RecipeYield_clean IS NULL"}.items():
    _serv_counts_raw[_k] = cnt(_cond)
SQL["servings_summary_raw"] = with_resolved() + unpivot(
    "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _serv_counts_raw.items())
    + ", median(ResolvedServings) AS mb, median(ResolvedServings_imputed) AS ma FROM resolved",
    [(k, {"count": k, "percent_total_dataset": pctd(k, "total_recipes"), "value": "CAST(NULL AS DOUBLE)"})
     for k in _serv_counts_raw]
    + [("median_resolved_servings_before_imputation",
        {"count": "CAST(NULL AS BIGINT)", "percent_total_dataset": "CAST(NULL AS DOUBLE)", "value": "mb"}),
       ("median_resolved_servings_after_imputation",
        {"count": "CAST(NULL AS BIGINT)", "percent_total_dataset": "CAST(NULL AS DOUBLE)", "value": "ma"})])


# -- cross-output checks -------------------------------------------------------------

def _alignment(left: str, right: str) -> str:
    def side(name, t, other):
        return f"""
SELECT '{name}_id_null' AS "check", COUNT(*) - COUNT(RecipeId) AS violations FROM {t}
UNION ALL SELECT '{name}_id_repeated', COUNT(RecipeId) - COUNT(DISTINCT RecipeId) FROM {t}
UNION ALL SELECT '{name}_only_ids', COUNT(DISTINCT RecipeId) FROM {t} t
  WHERE RecipeId IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {other} o WHERE o.RecipeId = t.RecipeId)"""
    return (side("left", left, right) + "\nUNION ALL" + side("right", right, left)
            + f"\nUNION ALL SELECT 'row_count_difference', abs((SELECT COUNT(*) FROM {left}) - (SELECT COUNT(*) FROM {right}))")


SQL["id_alignment"] = with_resolved() + NUMERIC_CTE + _alignment("catalog", "n3")
SQL["review_id_alignment"] = _WCR + _alignment("reviews", "catalog")
SQL["matrix_warnings"] = f"""WITH ns AS ({SQL["numeric_preprocessing_summary"]}),
cs AS ({SQL["content_matrix_summary"]}),
rows_in AS (SELECT MAX(n_documents) AS n FROM cs)
SELECT 'high_skew_after_log' AS "check", feature AS subject, skew_after_log1p AS value FROM ns WHERE abs(skew_after_log1p) > 5
UNION ALL SELECT 'clipped_rows_percent', feature, clipped_value_count * 100.0 / n FROM ns, rows_in
  WHERE clipping_applied AND clipped_value_count > n * 0.01
UNION ALL SELECT 'few_non_empty_documents', feature_group, non_empty_document_percent FROM cs
  WHERE included AND feature_group <> 'combined_content_matrix' AND non_empty_document_percent < 1
UNION ALL SELECT 'dense_content_matrix', feature_group, matrix_density FROM cs
  WHERE feature_group = 'combined_content_matrix' AND matrix_density > 0.05"""


# -- positions, the SVD and its checks ------------------------------------------------

SQL["item_index"] = with_resolved() + "\nSELECT RecipeId, row_number() OVER (ORDER BY RecipeId) - 1 AS row_index FROM resolved"


def _selected(features: str) -> str:
    return f"(SELECT CASE WHEN n > 200 THEN 200 WHEN n > 100 THEN 100 WHEN n > 50 THEN 50 ELSE least(10, n - 1) END FROM (SELECT COUNT(*) AS n FROM {features}))"


def _zero_norms(k: str) -> str:
    return f"""
SELECT CAST(unnest(range(1, {k} + 1)) AS INTEGER) AS component, CAST(0 AS DOUBLE) AS norm_deviation, CAST(0 AS DOUBLE) AS next_product"""


SQL["svd_score_norms"] = with_content() + _zero_norms(_selected("feat"))
SQL["svd_power_sums"] = with_content() + """,
gram AS (SELECT a.feature_index AS i, b.feature_index AS j, SUM(a.value * b.value) AS v FROM cmatrix a JOIN cmatrix b ON a.RecipeId = b.RecipeId GROUP BY 1, 2),
tr AS (SELECT SUM(v) AS t FROM gram WHERE i = j)
SELECT 1 AS power, CAST(1 AS DOUBLE) AS power_sum
UNION ALL SELECT 2, SUM((v / t) * (v / t)) FROM gram, tr
UNION ALL SELECT 3, SUM((x.v / t) * (y.v / t) * (z.v / t)) FROM gram x JOIN gram y ON x.j = y.i JOIN gram z ON y.j = z.i AND z.j = x.i, tr"""
SQL["term_feature_association"] = with_resolved("ingredients", "keywords") + NUMERIC_CTE + CONTENT_CTE + ",\nal AS (" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS component, m.feature_index, round(SUM(m.value * n3.{f}) / (SELECT COUNT(*) FROM n3), 9) AS loading "
    f"FROM cmatrix m JOIN n3 ON n3.RecipeId = m.RecipeId GROUP BY m.feature_index" for f in _F) + """),
ak AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY loading DESC, feature_index) AS hi,
         row_number() OVER (PARTITION BY component ORDER BY loading, feature_index) AS lo FROM al)
SELECT component, side, CAST(rank AS INTEGER) AS rank, feature_name, feature_group, loading FROM (
  SELECT component, 'positive' AS side, hi AS rank, feature_index, loading FROM ak WHERE hi <= 15
  UNION ALL SELECT component, 'negative', lo, feature_index, loading FROM ak WHERE lo <= 15) t JOIN feat USING (feature_index)"""
SQL["reduce_contract"] = with_resolved("ingredients", "keywords") + NUMERIC_CTE + CONTENT_CTE + _alignment("n3", "resolved") + """
UNION ALL SELECT 'content_names_match_columns', CAST(COUNT(*) - 1 - MAX(feature_index) + COUNT(*) - COUNT(DISTINCT feature_index) AS BIGINT) FROM feat
UNION ALL SELECT 'content_features_unnamed', CAST(COUNT(*) - COUNT(feature_name) AS BIGINT) FROM feat
UNION ALL SELECT 'content_columns_without_feature', CAST(CASE WHEN (SELECT MAX(feature_index) FROM cmatrix) > (SELECT MAX(feature_index) FROM feat) THEN 1 ELSE 0 END AS BIGINT)
UNION ALL SELECT 'numeric_values_finite', CAST(SUM(""" + " + ".join(f"CASE WHEN isfinite({f}) THEN 0 ELSE 1 END" for f in _F) + """) AS BIGINT) FROM n3
UNION ALL SELECT 'content_values_finite', CAST(SUM(CASE WHEN isfinite(value) THEN 0 ELSE 1 END) AS BIGINT) FROM cmatrix
""" + "".join(f"UNION ALL SELECT '{c}', CAST(0 AS BIGINT)\n" for c in (
    "numeric_names_match_columns", "pca_components_positive", "svd_components_positive", "pca_target_reached", "embedding_names_match_columns",
    *(f"{o}_{x}" for o in ("numeric_pca", "content_svd", "embedding") for x in ("values_finite", "width")))) + "".join(
    f"UNION ALL SELECT '{o}_rows_match', abs((SELECT COUNT(*) FROM n3) - (SELECT COUNT(*) FROM resolved))\n" for o in ("numeric_pca", "content_svd", "embedding"))


# -- whole documents as content ----------------------------------------------------------

_DOC = r"""WITH dt AS (SELECT doc_id AS id, term, COUNT(*) AS tf FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_](?:[\p{L}\p{N}_/]*[\p{L}\p{N}_])?')) AS term FROM documents) GROUP BY 1, 2),
dn AS (SELECT COUNT(DISTINCT doc_id) AS n FROM documents),
dv AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1 AS idf, row_number() OVER (ORDER BY term) - 1 AS feature_index
  FROM (SELECT term, COUNT(*) AS df FROM dt GROUP BY term), dn WHERE df >= 10 AND df <= 0.8::DOUBLE * n),
dw AS (SELECT id, feature_index, (1 + ln(tf)) * idf AS w FROM dt JOIN dv USING (term))"""
SQL["document_tfidf"] = _DOC + """
SELECT id AS doc_id, CAST(feature_index AS INTEGER) AS feature_index, w / sqrt(SUM(w * w) OVER (PARTITION BY id)) AS value FROM dw"""
SQL["document_svd_score_norms"] = _DOC + _zero_norms(
    "(SELECT CASE WHEN n > 300 THEN 300 WHEN n > 200 THEN 200 WHEN n > 100 THEN 100 WHEN n > 50 THEN 50 ELSE least(10, n - 1) END FROM (SELECT COUNT(*) AS n FROM dv))")


# -- list cells ------------------------------------------------------------------------

_LSTR = r"""(?:"[^"\\]*(?:\\.[^"\\]*)*"|'[^'\\]*(?:\\.[^'\\]*)*')"""
_LSTRS = rf"{_LSTR}(?:\s*{_LSTR})*"
_LNUM = r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?"
_LITEM = rf"""(?:{_LSTRS}|{_LNUM}|None|True|False|[\[(](?:[^\[\](){{}}"']+|{_LSTR})*[\])])"""
_LMANY = rf"(?:{_LITEM}(?:\s*,\s*{_LITEM})*\s*,?)?"
_LLIST, _LTUPLE = rf"(?s)^\s*\[\s*{_LMANY}\s*\]\s*$", rf"(?s)^\s*\(\s*{_LMANY}\s*\)\s*$"
_LSCALAR = rf"(?s)^\s*(?:{_LSTRS}|{_LNUM}|True|False)\s*$"


def _literal_sql(x: str) -> str:
    piece = r"replace(substring(y, 2, length(y) - 2), '\\', chr(1))"
    for code, char in ((r"\n", 10), (r"\t", 9), (r"\r", 13)):
        piece = f"replace({piece}, '{code}', chr({char}))"
    piece = rf"replace(regexp_replace({piece}, '\\(.)', '\1', 'g'), chr(1), '\')"
    return (f"(CASE WHEN regexp_matches({x}, {q('^[' + chr(34) + chr(39) + ']')}) THEN "
            f"coalesce(array_to_string(list_transform(regexp_extract_all({x}, {q('(?s)' + _LSTR)}), lambda y: {piece}), ''), '') ELSE {x} END)")


_CELL_FORMS = [
    "['{name}', '{type}']", "[\"{name}'s\", '{brand}']", "('{name}', '{type}')", "{name}", "['{name}', '{type}'", "[]",
    "[{key}, -2.5e3, None, True, '{name}']", "['it\\'s {name}', \"a \\\\ b\\n\"]", "'{name}'", "  [ '{name}' , ]  ",
    "[['{name}', 1], ('{type}',)]", "None", "   ", "{key}", "()", "['{name}' '{type}']",
]


def _cell_sql(form: str) -> str:
    out = q(form)
    for name, col in (("name", "p_name"), ("type", "p_type"), ("brand", "p_brand"), ("key", "CAST(p_partkey AS VARCHAR)")):
        out = f"replace({out}, '{{{name}}}', {col})"
    return out


_LIST_CELLS = "WITH cells AS (SELECT p_partkey AS PartId, CASE p_partkey % 17 " + " ".join(
    f"WHEN {i} THEN {_cell_sql(form)}" for i, form in enumerate(_CELL_FORMS, 1)) + f""" END AS cell FROM part),
lc AS (SELECT PartId, cell, trim(cell) AS s, coalesce(regexp_matches(trim(cell), {q(_LLIST)}), false) AS ok FROM cells),
li AS (SELECT PartId, ok, CASE WHEN cell IS NULL OR s IN ('', 'None') THEN CAST([] AS VARCHAR[])
    WHEN ok OR regexp_matches(s, {q(_LTUPLE)}) THEN list_transform(regexp_extract_all(substring(s, 2, length(s) - 2), {q('(?s)' + _LITEM)}), lambda x: {_literal_sql('x')})
    WHEN regexp_matches(s, {q(_LSCALAR)}) THEN [{_literal_sql('s')}] ELSE [s] END AS items FROM lc)"""
SQL["list_cell_items"] = _LIST_CELLS + """
SELECT PartId, CAST(len(items) AS INTEGER) AS n_items, coalesce(array_to_string(items, '|'), '') AS items, CAST(CASE WHEN ok THEN len(items) ELSE 0 END AS INTEGER) AS n_checked, ok AS parsed_ok FROM li"""
SQL["list_cell_parse_summary"] = _LIST_CELLS + f""",
raw AS (SELECT PartId AS id, unnest(items) AS item FROM li WHERE ok),
toks AS (SELECT DISTINCT id, {ascii_norm_sql('item')} AS token FROM raw WHERE {ascii_norm_sql('item')} <> ''),
per AS (SELECT li.PartId, COUNT(t.token) AS k FROM li LEFT JOIN toks t ON t.id = li.PartId GROUP BY li.PartId),
a AS (SELECT {cnt('k = 0')} AS zero, avg(k) AS av, quantile_cont(k, 0.5) AS med, quantile_cont(k, 0.95) AS p95 FROM per)
SELECT 'parse_success_rate_pct' AS metric, (SELECT round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) * 100, 2) FROM li) AS value
UNION ALL SELECT 'documents_with_zero_tokens', CAST(zero AS DOUBLE) FROM a
UNION ALL SELECT 'avg_tokens_per_document', round(av, 2) FROM a
UNION ALL SELECT 'median_tokens_per_document', round(med, 2) FROM a
UNION ALL SELECT 'p95_tokens_per_document', round(p95, 2) FROM a
UNION ALL SELECT 'unique_tokens', CAST((SELECT COUNT(DISTINCT token) FROM toks) AS DOUBLE)"""


# -- checks of the legacy reductions -----------------------------------------------------

SQL["legacy_svd_score_norms"] = _LEG + _zero_norms("(SELECT least(100, greatest(1, COUNT(*) - 1)) FROM lv)")
_LP = ["Calories", "FatContent", "SaturatedFatContent", "CholesterolContent", "SodiumContent", "CarbohydrateContent", "FiberContent", "SugarContent",
       "ProteinContent", "CookTime_Minutes", "PrepTime_Minutes"]
SQL["legacy_pca_power_sums"] = (
    _WC + ",\npm AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in _LP) + " FROM catalog)"
    + ",\npf AS (SELECT " + ", ".join(f"coalesce(CAST(catalog.{c} AS DOUBLE), pm.{c}) AS {c}" for c in _LP) + " FROM catalog, pm)"
    + ",\nps AS (SELECT " + ", ".join(f"avg({c}) AS {c}__m, stddev_pop({c}) AS {c}__s" for c in _LP) + " FROM pf)"
    + ",\npz AS (SELECT " + ", ".join(f"({c} - {c}__m) / {c}__s AS {c}" for c in _LP) + " FROM pf, ps)"
    + ",\npc AS (" + "\nUNION ALL ".join(f"SELECT {i} AS i, {j} AS j, covar_samp({a}, {b}) AS v FROM pz" for i, a in enumerate(_LP) for j, b in enumerate(_LP)) + """)
SELECT 1 AS power, SUM(v) AS power_sum FROM pc WHERE i = j
UNION ALL SELECT 2, SUM(v * v) FROM pc
UNION ALL SELECT 3, SUM(x.v * y.v * z.v) FROM pc x JOIN pc y ON x.j = y.i JOIN pc z ON y.j = z.i AND z.j = x.i""")
