"""Resolution summaries (A10-A16) and the resolved-table contract.

Each summary is **one** aggregate pass over the resolved table (all
conditional counts in a single ``agg``; partial aggregation runs map-side),
then a tiny unpivot of that one row into metric rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.numbers import isclose, percent
from larder.functions.quantiles import exact_quantiles


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def metric_rows(one_row: DataFrame, rows: list[tuple[str, dict[str, Column]]]) -> DataFrame:
    """Unpivot a one-row aggregate into ``(metric, ...)`` rows, in the given order."""
    structs = [F.struct(F.lit(name).alias("metric"), *[c.alias(k) for k, c in cols.items()])
               for name, cols in rows]
    return one_row.select(F.inline(F.array(*structs)))


def category_summary(resolved: DataFrame) -> DataFrame:
    """A10: one row of category missing / present counts and percents."""
    agg = resolved.agg(F.count(F.lit(1)).alias("total"),
                       F.sum("category_missing_original").cast("long").alias("missing"))
    t, m = F.col("total"), F.col("missing")
    return agg.select(
        t.alias("total_recipes"), m.alias("category_missing_count"),
        percent(m, t).alias("category_missing_percent"),
        (t - m).alias("category_present_count"), percent(t - m, t).alias("category_present_percent"))


def servings_summary(resolved: DataFrame, present: str = "cleaned") -> DataFrame:
    """Servings / yield presence, parse and imputation counts, medians.

    ``present="cleaned"`` counts servings as present when the cleaned value
    exists (> 0); ``"raw"`` when the raw value is non-missing (ruling R5).
    """
    serv = (F.col("RecipeServings_clean").isNotNull() if present == "cleaned"
            else F.col("servings_missing_original") == 0)
    yld = F.col("RecipeYield_clean").isNotNull()
    agg = resolved.agg(
        F.count(F.lit(1)).alias("total_recipes"),
        _count_if(serv & ~yld).alias("servings_only"),
        _count_if(~serv & yld).alias("yield_only"),
        _count_if(serv & yld).alias("both_present"),
        _count_if(~serv & ~yld).alias("both_missing"),
        F.sum("servings_from_yield").cast("long").alias("parsed_from_yield"),
        F.sum("servings_missing_after_yield_parse").cast("long").alias("still_missing_after_yield_parse"),
        F.sum("servings_imputed_with_category_median").cast("long").alias("imputed_with_category_median"),
        F.sum("servings_imputed_with_global_median").cast("long").alias("imputed_with_global_median"),
    )
    meds = exact_quantiles(resolved, {"b": F.col("ResolvedServings"), "a": F.col("ResolvedServings_imputed")},
                           [0.5])
    agg = agg.withColumns({"median_before": F.lit(meds["b"][0]).cast("double"),
                           "median_after": F.lit(meds["a"][0]).cast("double")})
    t = F.col("total_recipes")
    null_long, null_dbl = F.lit(None).cast("long"), F.lit(None).cast("double")
    counts = ["total_recipes", "servings_only", "yield_only", "both_present", "both_missing",
              "parsed_from_yield", "still_missing_after_yield_parse",
              "imputed_with_category_median", "imputed_with_global_median"]
    rows = [(m, {"count": F.col(m), "percent_total_dataset": percent(F.col(m), t),
                 "value": null_dbl}) for m in counts]
    rows += [
        ("median_resolved_servings_before_imputation",
         {"count": null_long, "percent_total_dataset": null_dbl, "value": F.col("median_before")}),
        ("median_resolved_servings_after_imputation",
         {"count": null_long, "percent_total_dataset": null_dbl, "value": F.col("median_after")}),
    ]
    return metric_rows(agg, rows)


def yield_unit_counts(resolved: DataFrame) -> DataFrame:
    """Recipes per non-empty yield unit token, most frequent first."""
    return (resolved.where(F.col("yield_unit_token") != "")
            .groupBy("yield_unit_token").agg(F.count(F.lit(1)).alias("recipe_count"))
            .orderBy(F.desc("recipe_count"), "yield_unit_token"))


def time_presence(resolved: DataFrame) -> DataFrame:
    """The 8 presence patterns of (prep, cook, total) plus the total."""
    p = F.col("PrepTime_Minutes_clean").isNotNull()
    c = F.col("CookTime_Minutes_clean").isNotNull()
    t = F.col("TotalTime_Minutes_clean").isNotNull()
    patterns = [
        ("all_three_present", p & c & t),
        ("prep_cook_present_total_missing", p & c & ~t),
        ("prep_total_present_cook_missing", p & ~c & t),
        ("cook_total_present_prep_missing", ~p & c & t),
        ("only_prep_present", p & ~c & ~t),
        ("only_cook_present", ~p & c & ~t),
        ("only_total_present", ~p & ~c & t),
        ("all_three_missing", ~p & ~c & ~t),
    ]
    agg = resolved.agg(F.count(F.lit(1)).alias("total_recipes"),
                       *[_count_if(cond).alias(name) for name, cond in patterns])
    total = F.col("total_recipes")
    names = [n for n, _ in patterns] + ["total_recipes"]
    return metric_rows(agg, [(n, {"count": F.col(n), "percent_total_dataset": percent(F.col(n), total)})
                             for n in names])


def time_consistency(resolved: DataFrame, variant: str = "script") -> DataFrame:
    """Arithmetic consistency of the *original* clean times.

    ``variant="script"``: a mismatch when a part is missing means total < the
    other part, and an empty case gives 0.0 within-case.  ``variant="eda"``:
    a mismatch means "not close" (atol 1e-6) and an empty case gives NULL.
    """
    prep, cook, total = (F.col("PrepTime_Minutes_clean"), F.col("CookTime_Minutes_clean"),
                         F.col("TotalTime_Minutes_clean"))
    pp, cp, tp = prep.isNotNull(), cook.isNotNull(), total.isNotNull()
    atol = 1e-08 if variant == "script" else 1e-06
    close = F.coalesce(isclose(total, prep + cook, atol=atol), F.lit(False))
    all3 = pp & cp & tp
    cook_missing = pp & tp & ~cp
    prep_missing = cp & tp & ~pp
    prep_eq_total = F.coalesce(isclose(prep, total, atol=atol), F.lit(False))
    cook_eq_total = F.coalesce(isclose(cook, total, atol=atol), F.lit(False))
    if variant == "script":
        prep_total_bad = total < prep
        cook_total_bad = total < cook
    else:
        prep_total_bad = ~prep_eq_total
        cook_total_bad = ~cook_eq_total
    metrics = [
        ("all_three_present", all3, "total"),
        ("total_equals_prep_plus_cook", all3 & close, "all_three_present"),
        ("total_mismatch_when_all_present", all3 & ~close, "all_three_present"),
        ("cook_missing_prep_total_present", cook_missing, "total"),
        ("prep_equals_total_when_cook_missing", cook_missing & prep_eq_total,
         "cook_missing_prep_total_present"),
        ("prep_total_mismatch_when_cook_missing", cook_missing & F.coalesce(prep_total_bad, F.lit(False)),
         "cook_missing_prep_total_present"),
        ("prep_missing_cook_total_present", prep_missing, "total"),
        ("cook_equals_total_when_prep_missing", prep_missing & cook_eq_total,
         "prep_missing_cook_total_present"),
        ("cook_total_mismatch_when_prep_missing", prep_missing & F.coalesce(cook_total_bad, F.lit(False)),
         "prep_missing_cook_total_present"),
        ("recoverable_total_missing", pp & cp & ~tp, "total"),
    ]
    agg = resolved.agg(F.count(F.lit(1)).alias("total"),
                       *[_count_if(cond).alias(name) for name, cond, _ in metrics])
    rows = []
    for name, _, rel in metrics:
        within = percent(F.col(name), F.col(rel))
        if variant != "script":
            within = F.when(F.col(rel) == 0, F.lit(None).cast("double")).otherwise(within)
        rows.append((name, {"count": F.col(name),
                            "percent_total_dataset": percent(F.col(name), F.col("total")),
                            "percent_within_relevant_case": within}))
    return metric_rows(agg, rows)


def time_derivation(resolved: DataFrame) -> DataFrame:
    """How many times each derivation rule fired."""
    rules = [("can_derive_cooktime", "cooktime_derived_from_total_prep"),
             ("can_derive_preptime", "preptime_derived_from_total_cook"),
             ("can_derive_totaltime", "totaltime_derived_from_prep_cook")]
    agg = resolved.agg(F.count(F.lit(1)).alias("total"),
                       *[F.sum(c).cast("long").alias(m) for m, c in rules])
    return metric_rows(agg, [(m, {"count": F.col(m),
                                  "percent_total_dataset": percent(F.col(m), F.col("total"))})
                             for m, _ in rules])


def time_imputation(resolved: DataFrame) -> DataFrame:
    """Missing before / after derivation / after imputation, by source."""
    specs = [("CookTime_Minutes", "cooktime"), ("PrepTime_Minutes", "preptime"),
             ("TotalTime_Minutes", "totaltime")]
    aggs = [F.count(F.lit(1)).alias("total")]
    for base, p in specs:
        aggs += [
            _count_if(F.col(f"{base}_clean").isNull()).alias(f"{p}_orig"),
            _count_if(F.col(f"{base}_resolved").isNull()).alias(f"{p}_res"),
            _count_if(F.col(f"{base}_imputed").isNull()).alias(f"{p}_final"),
            F.sum(f"{p}_imputed_with_category_median").cast("long").alias(f"{p}_cat"),
            F.sum(f"{p}_imputed_with_global_median").cast("long").alias(f"{p}_glob"),
        ]
    agg = resolved.agg(*aggs)
    t = F.col("total")
    rows = [(base, {
        "original_missing_count": F.col(f"{p}_orig"),
        "resolved_missing_count": F.col(f"{p}_res"),
        "imputed_with_category_median_count": F.col(f"{p}_cat"),
        "imputed_with_global_median_count": F.col(f"{p}_glob"),
        "final_missing_count": F.col(f"{p}_final"),
        "original_missing_percent": percent(F.col(f"{p}_orig"), t),
        "resolved_missing_percent": percent(F.col(f"{p}_res"), t),
        "final_missing_percent": percent(F.col(f"{p}_final"), t),
    }) for base, p in specs]
    return metric_rows(agg, rows)


FINAL_NON_NULL = ["ResolvedServings_imputed", "CookTime_Minutes_imputed",
                  "PrepTime_Minutes_imputed", "TotalTime_Minutes_imputed"]


def _id_stats(df: DataFrame, id_col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  (F.count_distinct(id_col) + F.max(F.col(id_col).isNull().cast("int"))).alias("ids"))


def resolved_contract(source: DataFrame, resolved: DataFrame, id_col: str = "RecipeId") -> DataFrame:
    """Row count and distinct ids kept; imputed columns non-NULL and >= 0.

    Returns ``(check, violations, severity)``; the time mismatch is a warning.
    """
    src = _id_stats(source, id_col).first()  # one row: the input's size
    aggs = [F.count(F.lit(1)).alias("rows"),
            (F.count_distinct(id_col) + F.max(F.col(id_col).isNull().cast("int"))).alias("ids"),
            F.sum("time_arithmetic_mismatch").cast("long").alias("mismatch")]
    for c in FINAL_NON_NULL:
        aggs.append(_count_if(F.col(c).isNull()).alias(f"{c}__null"))
        aggs.append(_count_if(F.col(c) < 0).alias(f"{c}__neg"))
    both = resolved.agg(*aggs)
    rows = [
        ("row_count_kept", {"violations": F.abs(F.col("rows") - F.lit(src["rows"])),
                            "severity": F.lit("error")}),
        ("distinct_ids_kept", {"violations": F.abs(F.col("ids") - F.lit(src["ids"])),
                               "severity": F.lit("error")}),
    ]
    for c in FINAL_NON_NULL:
        rows.append((f"{c}_non_null", {"violations": F.col(f"{c}__null"), "severity": F.lit("error")}))
        rows.append((f"{c}_non_negative", {"violations": F.col(f"{c}__neg"), "severity": F.lit("error")}))
    rows.append(("time_arithmetic_mismatch", {"violations": F.col("mismatch"), "severity": F.lit("warning")}))
    out = metric_rows(both, rows)
    return out.withColumnRenamed("metric", "check")
