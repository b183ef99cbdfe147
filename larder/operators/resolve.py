"""Missing-value resolution (job 2): category, servings, times, imputation.

Plan shape: the clean / parse / derive steps are one projection (no shuffle).
Imputation needs medians of the *pre-imputation* values: one ``groupBy`` over
the category computes every column's median at once, a left join attaches
them (AQE turns it into a broadcast join when the measured category table is
small, and keeps a shuffle join otherwise), and the global medians arrive as
one driver-side row of literals (one value per imputed column).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.numbers import (
    isclose, non_negative, positive, to_number, with_servings_parse, yield_text,
    yield_unit_from_text,
)
from larder.functions.quantiles import exact_quantiles
from larder.functions.text import blank_missing, category_clean, clean_text
from larder.sources.tables import require_columns

CATEGORY_COL = "RecipeCategory_clean"
TIME_BASES = [("PrepTime_Minutes", "preptime"), ("CookTime_Minutes", "cooktime"),
              ("TotalTime_Minutes", "totaltime")]


@dataclass(frozen=True)
class ImputeSpec:
    value_col: str
    target_col: str
    category_flag: str
    global_flag: str


SERVINGS_SPEC = ImputeSpec("ResolvedServings", "ResolvedServings_imputed",
                           "servings_imputed_with_category_median",
                           "servings_imputed_with_global_median")
TIME_SPECS = [
    ImputeSpec("CookTime_Minutes_resolved", "CookTime_Minutes_imputed",
               "cooktime_imputed_with_category_median", "cooktime_imputed_with_global_median"),
    ImputeSpec("PrepTime_Minutes_resolved", "PrepTime_Minutes_imputed",
               "preptime_imputed_with_category_median", "preptime_imputed_with_global_median"),
    ImputeSpec("TotalTime_Minutes_resolved", "TotalTime_Minutes_imputed",
               "totaltime_imputed_with_category_median", "totaltime_imputed_with_global_median"),
]


def value_dictionary(df: DataFrame, col: str, build, cut=None) -> DataFrame:
    """Per-value results for a repetitive text column, computed once per distinct value.

    ``build`` maps the distinct non-NULL values (one column ``col``) to their
    derived columns.  With ``cut`` (a lineage cut) the dictionary is written;
    the planner then sees its file size and broadcasts it only under
    ``spark.sql.autoBroadcastJoinThreshold`` (a shuffle join above it).
    """
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    dic = build(values)
    return dic if cut is None else cut(dic)


def clean_category(df: DataFrame, source_col: str = "RecipeCategory", cut=None) -> DataFrame:
    """F6 + P6 + P8: ``category_missing_original`` and ``RecipeCategory_clean``.

    P11: without the source column every row is missing (flag 1, NULL).
    With ``cut``, the regex chain runs once per distinct category.
    """
    if source_col not in df.columns:
        return df.withColumns({"category_missing_original": F.lit(1),
                               CATEGORY_COL: F.lit(None).cast("string")})
    src = F.col(source_col)
    if cut is None:
        return df.withColumns({
            "category_missing_original": blank_missing(src).cast("int"),
            CATEGORY_COL: category_clean(src),
        })
    dic = value_dictionary(df, source_col, lambda v: v.select(
        source_col, blank_missing(F.col(source_col)).cast("int").alias("__cat_missing"),
        category_clean(F.col(source_col)).alias("__cat_clean")), cut)
    out = df.join(dic, source_col, "left")
    return out.withColumns({
        "category_missing_original": F.when(src.isNull(), F.lit(1)).otherwise(F.col("__cat_missing")),
        CATEGORY_COL: F.col("__cat_clean"),
    }).drop("__cat_missing", "__cat_clean")


def _parse_yield(df: DataFrame, yield_col: str) -> DataFrame:
    """Yield text -> cleaned text, servings parsed from it, and its unit token."""
    out = df.withColumn("RecipeYield_clean", clean_text(F.col(yield_col)))
    # Staged columns keep each generated expression small (the parse nests
    # regex groups inside number parsing).
    out = out.withColumn("__yield_text", yield_text(F.col("RecipeYield_clean")))
    out = with_servings_parse(out, "__yield_text", "servings_parsed_from_yield")
    return out.withColumn("yield_unit_token", yield_unit_from_text(
        F.col("__yield_text"), F.col("servings_parsed_from_yield"))).drop("__yield_text")


def resolve_servings(df: DataFrame, servings_col: str = "RecipeServings",
                     yield_col: str = "RecipeYield", cut=None) -> DataFrame:
    """F9 + F11 + P4/P5/P8: explicit servings first, then servings parsed from yield.

    With ``cut``, the yield parse runs once per distinct yield text.
    """
    require_columns(df, [servings_col, yield_col], "catalog")
    out = df.withColumns({
        "servings_missing_original": blank_missing(F.col(servings_col)).cast("int"),
        "RecipeServings_clean": positive(to_number(df, servings_col)),
    })
    if cut is None:
        out = _parse_yield(out, yield_col)
    else:
        dic = value_dictionary(df, yield_col, lambda v: _parse_yield(v, yield_col), cut)
        out = out.join(dic, yield_col, "left").withColumn(
            "yield_unit_token", F.coalesce(F.col("yield_unit_token"), F.lit("")))
    use_yield = F.col("RecipeServings_clean").isNull() & F.col("servings_parsed_from_yield").isNotNull()
    return out.withColumns({
        "ResolvedServings": F.coalesce("RecipeServings_clean", "servings_parsed_from_yield"),
        "servings_from_yield": use_yield.cast("int"),
        "servings_missing_after_yield_parse": (
            F.col("RecipeServings_clean").isNull() & F.col("servings_parsed_from_yield").isNull()
        ).cast("int"),
    })


def resolve_times(df: DataFrame) -> DataFrame:
    """F12 + F13: derive one missing time from the other two, in a fixed order.

    cook = total - prep (total >= prep); prep = total - *resolved* cook
    (total >= cook); total = resolved prep + resolved cook.  Consistency flags
    use ``np.isclose`` tolerances and need all three resolved values.
    """
    require_columns(df, [b for b, _ in TIME_BASES], "catalog")
    out = df.withColumns({f"{b}_clean": non_negative(to_number(df, b)) for b, _ in TIME_BASES})
    out = out.withColumns({f"{p}_missing_original": F.col(f"{b}_clean").isNull().cast("int")
                           for b, p in TIME_BASES})
    prep, cook, total = (F.col("PrepTime_Minutes_clean"), F.col("CookTime_Minutes_clean"),
                         F.col("TotalTime_Minutes_clean"))
    derive_cook = cook.isNull() & prep.isNotNull() & total.isNotNull() & (total >= prep)
    out = out.withColumns({
        "CookTime_Minutes_resolved": F.when(derive_cook, total - prep).otherwise(cook),
        "cooktime_derived_from_total_prep": derive_cook.cast("int"),
    })
    cook_r = F.col("CookTime_Minutes_resolved")
    derive_prep = prep.isNull() & cook_r.isNotNull() & total.isNotNull() & (total >= cook_r)
    out = out.withColumns({
        "PrepTime_Minutes_resolved": F.when(derive_prep, total - cook_r).otherwise(prep),
        "preptime_derived_from_total_cook": derive_prep.cast("int"),
    })
    prep_r = F.col("PrepTime_Minutes_resolved")
    derive_total = total.isNull() & prep_r.isNotNull() & cook_r.isNotNull()
    out = out.withColumns({
        "TotalTime_Minutes_resolved": F.when(derive_total, prep_r + cook_r).otherwise(total),
        "totaltime_derived_from_prep_cook": derive_total.cast("int"),
    })
    total_r = F.col("TotalTime_Minutes_resolved")
    all_resolved = prep_r.isNotNull() & cook_r.isNotNull() & total_r.isNotNull()
    ok = F.coalesce(isclose(total_r, prep_r + cook_r), F.lit(False))
    return out.withColumns({
        "time_arithmetic_consistent": (all_resolved & ok).cast("int"),
        "time_arithmetic_mismatch": (all_resolved & ~ok).cast("int"),
    })


def medians(df: DataFrame, group_col: str, value_cols: list[str]) -> DataFrame:
    """(whole, g, c, m): exact medians of each value column, per non-NULL group and of all rows (``whole``).

    c is the number of the value column.  NaN and infinities count as missing.  Values are
    counted once per (group, value); the counts are sorted in ranges with running totals, and a
    group's two middle values are where those pass its middle ranks.  One sort ends on any
    input, and no task sees more than its range of the distinct values.
    """
    from larder.plans.materialize import materialize
    from larder.plans.scans import running

    entries = [F.struct(F.lit(i).alias("c"), F.col(v).cast("double").alias("v")) for i, v in enumerate(value_cols)]
    values = df.select(F.col(group_col).alias("g"), F.inline(F.array(*entries))).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    counts = materialize(values.groupBy("g", "c", "v").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    nobody = F.lit(None).cast(counts.schema["g"].dataType)
    whole = counts.groupBy("c", "v").agg(F.sum("n").alias("n")).select(F.lit(True).alias("whole"), nobody.alias("g"), "c", "v", "n")
    both = whole.union(counts.where(F.col("g").isNotNull()).select(F.lit(False), "g", "c", "v", "n"))
    keys = ["whole", "g", "c"]
    placed = running(both, keys, [F.col("v")], {"upto": (F.sum, "n")}, "value-ranks")
    totals = both.groupBy(*keys).agg(F.sum("n").alias("t")).select(*(F.col(k).alias(f"t_{k}") for k in keys), "t")
    same = (F.col("whole") == F.col("t_whole")) & F.col("g").eqNullSafe(F.col("t_g")) & (F.col("c") == F.col("t_c"))

    def holds(rank):
        return ((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)).cast("int")

    middle = holds(F.floor((F.col("t") - 1) / 2)) + holds(F.floor(F.col("t") / 2))
    found = placed.join(totals, same).withColumn("times", middle).where("times > 0")
    return materialize(found.groupBy(*keys).agg((F.sum(F.col("v") * F.col("times")) / 2).alias("m")), "medians")


def grouped_medians(found: DataFrame, group_col: str, value_cols: list[str], names: dict[str, str]) -> DataFrame:
    """The group medians of ``medians`` as a row per group, a column ``names[v]`` for each value column."""
    return found.where("not whole").groupBy(F.col("g").alias(group_col)).agg(
        *[F.max(F.when(F.col("c") == i, F.col("m"))).alias(names[v]) for i, v in enumerate(value_cols)])


def global_medians(found: DataFrame, value_cols: list[str]) -> dict[str, float]:
    """The medians of whole columns of ``medians``; a column without any value raises an error."""
    of = {r["c"]: r["m"] for r in found.where("whole").collect()}
    for i, v in enumerate(value_cols):
        if of.get(i) is None:
            raise ValueError(f"{v} has no value, so it has no median to fill gaps with")
    return {v: float(of[i]) for i, v in enumerate(value_cols)}


def impute_category_then_global(df: DataFrame, specs: list[ImputeSpec],
                                category_col: str = CATEGORY_COL) -> DataFrame:
    """A1 + J1: fill each value with its category median, else the global median.

    Medians come from the pre-imputation values.  Rows with a NULL category,
    or whose category has no value at all, take the global median.  Each spec
    adds the filled column and two 0/1 flags.
    """
    value_cols = [s.value_col for s in specs]
    require_columns(df, value_cols, "imputation input")
    if category_col not in df.columns:
        df = df.withColumn(category_col, F.lit(None).cast("string"))
    found = medians(df, category_col, value_cols)
    glob = global_medians(found, value_cols)
    med_names = {s.value_col: f"__cat_median_{i}" for i, s in enumerate(specs)}
    out = df.join(grouped_medians(found, category_col, value_cols, med_names), on=category_col, how="left")
    cols = {}
    for s in specs:
        v, m = F.col(s.value_col), F.col(med_names[s.value_col])
        use_cat = v.isNull() & F.col(category_col).isNotNull() & m.isNotNull()
        use_glob = v.isNull() & ~use_cat
        cols[s.target_col] = (F.when(use_cat, m).when(use_glob, F.lit(glob[s.value_col]))
                              .otherwise(v))
        cols[s.category_flag] = use_cat.cast("int")
        cols[s.global_flag] = use_glob.cast("int")
    return out.withColumns(cols).drop(*med_names.values())


def resolve_catalog(df: DataFrame, cut=None) -> DataFrame:
    """Job 2: the resolved table (input columns + 36 new ones).

    ``cut`` (e.g. a reliable checkpoint) is applied to the pre-imputation
    table: the medians pass and the final projection then read it instead of
    re-running every parse, and later filters cannot inline the parse chain.
    """
    require_columns(df, ["RecipeId", "RecipeServings", "RecipeYield",
                         "PrepTime_Minutes", "CookTime_Minutes", "TotalTime_Minutes"], "catalog")
    base = resolve_times(resolve_servings(clean_category(df, cut=cut), cut=cut))
    if cut is not None:
        base = cut(base)
    out = impute_category_then_global(base, [SERVINGS_SPEC, *TIME_SPECS])
    new_cols = [
        "category_missing_original", CATEGORY_COL,
        "servings_missing_original", "RecipeServings_clean", "RecipeYield_clean",
        "servings_parsed_from_yield", "ResolvedServings", "servings_from_yield",
        "servings_missing_after_yield_parse", "ResolvedServings_imputed",
        "servings_imputed_with_category_median", "servings_imputed_with_global_median",
        "yield_unit_token",
        "PrepTime_Minutes_clean", "CookTime_Minutes_clean", "TotalTime_Minutes_clean",
        "preptime_missing_original", "cooktime_missing_original", "totaltime_missing_original",
        "CookTime_Minutes_resolved", "cooktime_derived_from_total_prep",
        "PrepTime_Minutes_resolved", "preptime_derived_from_total_cook",
        "TotalTime_Minutes_resolved", "totaltime_derived_from_prep_cook",
        "time_arithmetic_consistent", "time_arithmetic_mismatch",
    ]
    for s in TIME_SPECS:
        new_cols += [s.target_col, s.category_flag, s.global_flag]
    return out.select(*df.columns, *new_cols)
