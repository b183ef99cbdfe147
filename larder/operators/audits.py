"""Audits (job 3): quality, missingness, numeric profiles, tokens, categories, time, interactions.

Each audit is one or two aggregate passes written as conditional aggregates
in a single ``agg`` (Catalyst will not merge separate actions).  Interaction
audits aggregate reviews per user / per recipe first (map-side partial
counts), then summarize those counts.  Top-k reports keep a deterministic
tie-break; the limit is the feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.numbers import percent, to_number
from larder.functions.quantiles import exact_quantiles
from larder.functions.text import normalize_token_ascii
from larder.operators.numeric import adjusted_skew

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
NUMERIC_CANDIDATES = [
    "Calories", "FatContent", "SaturatedFatContent", "CholesterolContent", "SodiumContent",
    "CarbohydrateContent", "FiberContent", "SugarContent", "ProteinContent", "RecipeServings",
    "NumIngredients", "NumQuantities", "CookTime_Minutes", "PrepTime_Minutes", "TotalTime_Minutes",
]
PROFILE_PERCENTILES = [0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99]
MIN_DF_SWEEP = [2, 5, 10, 25, 50]
# Leakage audit rows: column, layer, allowed for content features, reason.
LEAKAGE_AUDIT = [
    ("AggregatedRating", "outcome-popularity", False, "Derived from user behavior; leakage risk"),
    ("ReviewCount", "outcome-popularity", False, "Popularity metric; leakage risk"),
    ("Rating", "interaction", False, "Outcome signal from reviews; reserve for evaluation"),
    ("RecipeId", "identifier", False, "Identifier only"),
    ("ReviewId", "identifier", False, "Identifier only"),
    ("AuthorId", "identifier", False, "Identifier only"),
    ("RecipeIngredientParts", "text-list", True, "Core content signal"),
    ("RecipeKeywords", "text-list", True, "Tag-like content signal"),
    ("RecipeCategory", "categorical", True, "Content category"),
    ("DatePublished", "temporal", True, "Temporal metadata; use carefully"),
]
# ---------------------------------------------------------------------------


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _metric_table(one: DataFrame, metrics: list[tuple[str, Column]], value_type: str = "double") -> DataFrame:
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), c.cast(value_type).alias("value")) for m, c in metrics])))


def missingness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column its type, non-NULL, NULL, NULL percent and distinct values, most missing first.

    Rows go to long form (column, value as text) and are counted per distinct value, with partial
    counts before the shuffle; the counts of a column then give both its sums.
    """
    cols, dtypes = columns or df.columns, dict(df.dtypes)

    def text(c):
        # 0.0 + x: minus zero is no value of its own
        return (F.lit(0.0) + F.col(c) if dtypes[c] in ("double", "float") else F.col(c)).cast("string")

    entries = F.inline(F.array(*(F.struct(F.lit(i).alias("i"), text(c).alias("value")) for i, c in enumerate(cols))))
    values = df.select(entries).groupBy("i", "value").agg(F.count(F.lit(1)).alias("k"))
    per = values.groupBy("i").agg(F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("k"))), F.lit(0)).alias("non_null_count"),
                                  F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("k"))), F.lit(0)).alias("null_count"), F.count("value").alias("distinct_count"))
    names = df.sparkSession.createDataFrame([(i, c, dtypes[c]) for i, c in enumerate(cols)], "i int, column string, dtype string")
    rows = names.join(per, "i", "left")
    counts = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("non_null_count", "null_count", "distinct_count")}
    return rows.select("column", "dtype", counts["non_null_count"].alias("non_null_count"), counts["null_count"].alias("null_count"),
                       percent(counts["null_count"], counts["non_null_count"] + counts["null_count"]).alias("null_pct"),
                       counts["distinct_count"].alias("distinct_count")).orderBy(F.desc("null_pct"), "column")


def quality_audit(catalog: DataFrame, reviews: DataFrame, id_col: str = "RecipeId",
                  review_id_col: str = "ReviewId", user_col: str = "AuthorId") -> DataFrame:
    """A9 + J2: sizes, unique / duplicate ids, reviewers and orphan review ids."""
    c = catalog.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(id_col).alias("ids")).first()
    r = reviews.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(review_id_col).alias("ids"),
                    F.count_distinct(user_col).alias("users"),
                    F.count_distinct(id_col).alias("recipes")).first()
    orphans = orphan_review_ids(catalog, reviews, id_col).count()
    spark = catalog.sparkSession
    rows = [
        ("recipes_rows", c["rows"]), ("recipes_cols", len(catalog.columns)),
        ("reviews_rows", r["rows"]), ("reviews_cols", len(reviews.columns)),
        ("unique_recipe_ids", c["ids"]), ("duplicate_recipe_ids", c["rows"] - c["ids"]),
        ("unique_review_ids", r["ids"]), ("duplicate_review_ids", r["rows"] - r["ids"]),
        ("unique_reviewers", r["users"]), ("unique_reviewed_recipes", r["recipes"]),
        ("orphan_review_recipe_ids", orphans),
    ]
    return spark.createDataFrame([(m, int(v)) for m, v in rows], "metric string, value long")


def orphan_review_ids(catalog: DataFrame, reviews: DataFrame, id_col: str = "RecipeId") -> DataFrame:
    """J2 + W9: distinct review recipe ids absent from the catalog (compared as text)."""
    rid = reviews.select(F.col(id_col).cast("string").alias("id")).where(F.col("id").isNotNull()).distinct()
    cid = catalog.select(F.col(id_col).cast("string").alias("id"))
    return rid.join(cid, "id", "left_anti")


def unreviewed_recipes(catalog: DataFrame, reviews: DataFrame, id_col: str = "RecipeId") -> DataFrame:
    """J3 + W9: catalog ids with no review (compared as text)."""
    cid = catalog.select(F.col(id_col).cast("string").alias("id")).where(F.col("id").isNotNull()).distinct()
    rid = reviews.select(F.col(id_col).cast("string").alias("id"))
    return cid.join(rid, "id", "left_anti")


def time_order_checks(df: DataFrame) -> DataFrame:
    """Total < prep, total < cook, any negative time (raw minutes)."""
    t, p, c = (to_number(df, "TotalTime_Minutes"), to_number(df, "PrepTime_Minutes"),
               to_number(df, "CookTime_Minutes"))
    one = df.agg(_count_if(t < p).alias("a"), _count_if(t < c).alias("b"),
                 _count_if((t < 0) | (p < 0) | (c < 0)).alias("c"))
    return one.select(F.inline(F.array(
        F.struct(F.lit("total_lt_prep").alias("check"), F.col("a").alias("count")),
        F.struct(F.lit("total_lt_cook").alias("check"), F.col("b").alias("count")),
        F.struct(F.lit("any_negative").alias("check"), F.col("c").alias("count")))))


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A18 + A5: count, missing %, mean, sample std, min, percentiles, max, adjusted skew."""
    cols = [c for c in (columns or NUMERIC_CANDIDATES) if c in df.columns]
    prep = df.select(*[to_number(df, c).alias(f"x{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = F.col(f"x{i}")
        aggs += [F.count(x).alias(f"n_{i}"), F.avg(x).alias(f"mean_{i}"), F.stddev_samp(x).alias(f"std_{i}"),
                 F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"),
                 adjusted_skew(x).alias(f"skew_{i}")]
    one = prep.agg(*aggs).cache()
    first = one.first()
    quant = exact_quantiles(prep, {c: F.col(f"x{i}") for i, c in enumerate(cols)}, PROFILE_PERCENTILES,
                            stats={c: (first[f"n_{i}"], first[f"min_{i}"], first[f"max_{i}"])
                                   for i, c in enumerate(cols)})
    names = ["p1", "p5", "p25", "p50", "p75", "p95", "p99"]
    structs = []
    for i, c in enumerate(cols):
        q = [F.lit(v).cast("double") for v in quant[c]]
        structs.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n_{i}").alias("count"),
            F.round((F.col("__n") - F.col(f"n_{i}")) * 100.0 / F.col("__n"), 2).alias("missing_pct"),
            F.col(f"mean_{i}").alias("mean"), F.col(f"std_{i}").alias("std"),
            F.col(f"min_{i}").alias("min"), *[q[j].alias(nm) for j, nm in enumerate(names)],
            F.col(f"max_{i}").alias("max"), F.col(f"skew_{i}").alias("skewness")))
    return one.select(F.inline(F.array(*structs))).where(F.col("count") > 0)


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A19 + A2: Pearson correlation of every pair after filling each column with its median."""
    cols = [c for c in (columns or NUMERIC_CANDIDATES) if c in df.columns]
    meds = exact_quantiles(df, {c: to_number(df, c) for c in cols}, [0.5])
    filled = df.select(*[F.coalesce(to_number(df, c), F.lit(meds[c][0])).alias(c) for c in cols])
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            aggs.append(F.corr(a, cols[j]).alias(f"r_{i}_{j}"))
            pairs.append((a, cols[j], f"r_{i}_{j}"))
            if i != j:
                pairs.append((cols[j], a, f"r_{i}_{j}"))
    one = filled.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column"), F.lit(b).alias("other"), F.col(r).alias("correlation"))
        for a, b, r in pairs])))


def describe(df: DataFrame, columns: list[str], percentiles: list[float]) -> DataFrame:
    """Count, mean, sample std, min, chosen percentiles, max per numeric column."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    aggs = []
    for i, c in enumerate(numeric):
        aggs += [F.count(c).alias(f"n_{i}"), F.avg(c).alias(f"m_{i}"), F.stddev_samp(c).alias(f"s_{i}"),
                 F.min(c).cast("double").alias(f"lo_{i}"), F.max(c).cast("double").alias(f"hi_{i}")]
    one = df.agg(*aggs)
    quant = exact_quantiles(df, {c: F.col(c) for c in numeric}, percentiles)
    structs = []
    for i, c in enumerate(numeric):
        stats = [("count", F.col(f"n_{i}").cast("double")), ("mean", F.col(f"m_{i}")),
                 ("std", F.col(f"s_{i}")), ("min", F.col(f"lo_{i}"))]
        stats += [(f"{round(p * 100, 6):g}%", F.lit(quant[c][j]).cast("double")) for j, p in enumerate(percentiles)]
        stats.append(("max", F.col(f"hi_{i}")))
        structs += [F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), v.alias("value"))
                    for s, v in stats]
    return one.select(F.inline(F.array(*structs)))


def zero_cook_share(resolved: DataFrame) -> DataFrame:
    """Among derived cook times, how many are exactly zero."""
    d = F.col("cooktime_derived_from_total_prep") == 1
    one = resolved.agg(_count_if(d).alias("derived"),
                       _count_if(d & (F.col("CookTime_Minutes_resolved") == 0)).alias("zero"))
    return one.select(F.col("derived").alias("derived_cooktime_count"),
                      F.col("zero").alias("zero_cooktime_count"),
                      percent(F.col("zero"), F.col("derived")).alias("zero_cooktime_percent"))


def flag_counts(resolved: DataFrame, flags: list[str]) -> DataFrame:
    """Value counts of 0/1 flags, as ``(flag, value, count)``."""
    stacked = resolved.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("value")) for f in flags])).alias("s"))
    return (stacked.groupBy("s.flag", "s.value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("flag", "value"))


# -- token audits (A23-A25, J4, F15) -----------------------------------------------

def audit_token_sets(long_df: DataFrame, id_col: str, raw_col: str) -> DataFrame:
    """F15 + F16: ``(id, token)`` distinct non-empty ASCII-normalized tokens."""
    from larder.operators.content import via_dictionary
    return (via_dictionary(long_df, id_col, raw_col, normalize_token_ascii)
            .where(F.col("token") != "").distinct())


def document_token_sets(docs: DataFrame, id_col: str, words: Column) -> DataFrame:
    """F15 + F16 for an array of words per document: distinct non-empty tokens, normalized inside the document."""
    plain = F.transform(F.array_distinct(words), lambda w: F.when(w.rlike("^[a-z0-9]+$"), w).otherwise(normalize_token_ascii(w)))
    return docs.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(plain)).alias("token")).where(F.col("token") != "")


def list_parse_summary(universe: DataFrame, tokens: DataFrame, id_col: str = "RecipeId", parsed: str | None = None) -> DataFrame:
    """Zero-token documents, mean / median / p95 tokens per document, distinct tokens.

    ``parsed`` names a boolean column of ``universe`` that says whether the cell was a list (F3);
    the percent of such cells then comes first.
    """
    per_doc = tokens.groupBy("id").agg(F.count(F.lit(1)).alias("k"))
    ok = F.col(parsed) if parsed else F.lit(None).cast("boolean")
    counts = (universe.select(F.col(id_col).alias("id"), ok.alias("ok")).join(per_doc, "id", "left")
              .select(F.coalesce("k", F.lit(0)).alias("k"), "ok"))
    one = counts.agg(_count_if(F.col("k") == 0).alias("zero"), F.avg("k").alias("avg"),
                     F.percentile("k", F.lit(0.5)).alias("med"), F.percentile("k", F.lit(0.95)).alias("p95"),
                     (F.avg(F.col("ok").cast("double")) * 100).alias("ok"))
    distinct = tokens.select("token").distinct().count()
    return _metric_table(one, [("parse_success_rate_pct", F.round("ok", 2))] * bool(parsed) + [
        ("documents_with_zero_tokens", F.col("zero")),
        ("avg_tokens_per_document", F.round("avg", 2)),
        ("median_tokens_per_document", F.round("med", 2)),
        ("p95_tokens_per_document", F.round("p95", 2)),
        ("unique_tokens", F.lit(distinct)),
    ])


def top_tokens(tokens: DataFrame, n: int = 50, name: str = "token") -> DataFrame:
    """The ``n`` tokens in the most documents (ties: token order)."""
    return (tokens.groupBy(F.col("token").alias(name)).agg(F.count(F.lit(1)).alias("recipe_count"))
            .orderBy(F.desc("recipe_count"), name).limit(n))


def vocabulary_sweep(universe: DataFrame, tokens: DataFrame, thresholds: list[int] = MIN_DF_SWEEP,
                     id_col: str = "RecipeId") -> DataFrame:
    """A25 + J4: vocabulary size, covered documents, coverage and density per ``min_df``.

    ``tokens`` (id, token) is a written table.  One document-frequency table; a token's class
    is the number of thresholds that its frequency reaches, and a document is covered by
    ``min_df = t`` iff its largest class reaches t's.  Tokens below all thresholds join nothing.
    """
    n_docs = universe.select(id_col).count()
    dfreq = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    reached = sum((F.col("df") >= t).cast("int") for t in thresholds)
    classes = dfreq.where(F.col("df") >= min(thresholds)).select("token", reached.cast("byte").alias("class"))
    per_doc = tokens.join(classes, "token").groupBy("id").agg(F.max("class").alias("class"))
    v = dfreq.agg(*[_count_if(F.col("df") >= t).alias(f"v{t}") for t in thresholds],
                  *[F.sum(F.when(F.col("df") >= t, F.col("df")).otherwise(0)).cast("long").alias(f"h{t}")
                    for t in thresholds]).first()
    rank = {t: sum(t >= x for x in thresholds) for t in thresholds}
    cov = per_doc.agg(*[_count_if(F.col("class") >= rank[t]).alias(f"c{t}") for t in thresholds]).first()
    rows = []
    for t in thresholds:
        vs, hits, covered = int(v[f"v{t}"] or 0), int(v[f"h{t}"] or 0), int(cov[f"c{t}"] or 0)
        if n_docs == 0 or vs == 0:
            covered, pct, dens = 0, 0.0, 0.0
        else:
            pct = covered / n_docs * 100
            dens = hits / (n_docs * vs)
        comment = ("no vocabulary" if vs == 0 else "coverage too low" if pct < 80
                   else "vocab too large" if vs > 100000 else "reasonable tradeoff")
        rows.append((t, vs, covered, pct, dens, comment))
    spark = tokens.sparkSession
    df = spark.createDataFrame(rows, "min_df int, vocab_size long, docs_with_tokens long, coverage_pct double, "
                                     "approx_density double, comment string")
    return df.select("min_df", "vocab_size", "docs_with_tokens", F.round("coverage_pct", 2).alias("coverage_pct"),
                     F.round("approx_density", 6).alias("approx_density"), "comment")


# -- categories, dates, interactions ---------------------------------------------------

def category_counts(df: DataFrame, col: str = "RecipeCategory") -> DataFrame:
    """A26 input: recipes per raw category, NULL counted as ``Unknown``."""
    return (df.groupBy(F.coalesce(F.col(col), F.lit("Unknown")).alias("category"))
            .agg(F.count(F.lit(1)).alias("count")))


def top_categories(df: DataFrame, n: int = 30, col: str = "RecipeCategory") -> DataFrame:
    """The ``n`` largest categories (ties: name), a distributed top-k."""
    return category_counts(df, col).orderBy(F.desc("count"), "category").limit(n)


def category_coverage(df: DataFrame, col: str = "RecipeCategory") -> DataFrame:
    """Distinct categories, top-10/20/30 coverage percent, categories under 50 rows."""
    counts = category_counts(df, col)
    one = counts.agg(F.count(F.lit(1)).alias("u"), F.sum("count").alias("t"),
                     _count_if(F.col("count") < 50).alias("rare"))
    top = [r["count"] for r in top_categories(df, 30, col).collect()]  # at most 30 numbers
    top = sorted(top, reverse=True)
    one = one.withColumns({f"top{k}": F.lit(sum(top[:k])).cast("long") for k in (10, 20, 30)})
    return _metric_table(one, [
        ("unique_categories", F.col("u")),
        ("coverage_top10_pct", F.round(F.col("top10") * 100.0 / F.col("t"), 2)),
        ("coverage_top20_pct", F.round(F.col("top20") * 100.0 / F.col("t"), 2)),
        ("coverage_top30_pct", F.round(F.col("top30") * 100.0 / F.col("t"), 2)),
        ("rare_categories_lt_50", F.col("rare")),
    ])


def parse_dates(c: Column) -> Column:
    """timestamp from text (or a timestamp), junk -> NULL."""
    return F.try_to_timestamp(c.cast("string"))


def temporal_summary(df: DataFrame, col: str = "DatePublished") -> DataFrame:
    """A27 + F23: parse success, first / last date, missing or invalid dates."""
    d = parse_dates(F.col(col))
    one = df.agg(F.count(F.lit(1)).alias("n"), F.count(d).alias("ok"), F.min(d).alias("lo"), F.max(d).alias("hi"))
    return _metric_table(one, [
        ("parse_success_rate_pct", F.round(F.col("ok") * 100.0 / F.col("n"), 2)),
        ("min_date", F.col("lo")), ("max_date", F.col("hi")),
        ("missing_or_invalid_dates", F.col("n") - F.col("ok")),
    ], value_type="string")


def recipes_per_year(df: DataFrame, col: str = "DatePublished") -> DataFrame:
    """Recipes per publication year."""
    d = parse_dates(F.col(col))
    return (df.where(d.isNotNull()).groupBy(F.year(d).alias("year"))
            .agg(F.count(F.lit(1)).alias("recipe_count")).orderBy("year"))


def interaction_summary(catalog: DataFrame, reviews: DataFrame, id_col: str = "RecipeId",
                        user_col: str = "AuthorId") -> DataFrame:
    """Users, reviewed recipes, density and activity shares; each table is read once.

    A review counts for its user and for its recipe; catalog ids meet the recipes' counts as rows
    without reviews.  Ids are compared as text; a NULL user or recipe is a group of its own, a
    NULL catalog id is none.
    """
    sides = F.inline(F.array(F.struct(F.lit("u").alias("kind"), F.col(user_col).cast("string").alias("key"), F.lit(1).alias("review"), F.lit(0).alias("listed")),
                             F.struct(F.lit("r").alias("kind"), F.col(id_col).cast("string").alias("key"), F.lit(1).alias("review"), F.lit(0).alias("listed"))))
    listed = catalog.select(F.lit("r").alias("kind"), F.col(id_col).cast("string").alias("key"), F.lit(0).alias("review"), F.lit(1).alias("listed"))
    per = reviews.select(sides).union(listed).groupBy("kind", "key").agg(F.sum("review").alias("k"), F.max("listed").alias("listed"))
    users, recipes = (F.col("kind") == "u"), (F.col("kind") == "r") & (F.col("k") > 0)
    known = (F.col("kind") == "r") & F.col("key").isNotNull() & (F.col("listed") > 0)
    one = per.agg(_count_if(users).alias("n"), _count_if(users & (F.col("k") == 1)).alias("one"), _count_if(users & (F.col("k") >= 5)).alias("ge5"),
                  F.coalesce(F.sum(F.when(users, F.col("k"))), F.lit(0)).alias("obs"), _count_if(recipes).alias("rn"), _count_if(recipes & (F.col("k") >= 5)).alias("r5"),
                  _count_if(known).alias("catalog"), _count_if(known & (F.col("k") == 0)).alias("zero")).first()
    u, r = {k: one[k] or 0 for k in ("n", "one", "ge5", "obs")}, {"n": one["rn"] or 0, "ge5": one["r5"] or 0}
    n_catalog, zero = one["catalog"] or 0, one["zero"] or 0
    pairs = u["n"] * n_catalog
    rows = [
        ("num_users", u["n"]), ("num_reviewed_recipes", r["n"]), ("num_recipes_catalog", n_catalog),
        ("observed_interactions", u["obs"]), ("total_possible_pairs", pairs),
        ("user_item_density", (u["obs"] / pairs) if pairs else 0.0),
        ("pct_users_with_one_review", round(u["one"] / u["n"] * 100, 2) if u["n"] else 0.0),
        ("pct_users_with_ge5_reviews", round(u["ge5"] / u["n"] * 100, 2) if u["n"] else 0.0),
        ("pct_recipes_with_ge5_reviews", round(r["ge5"] / r["n"] * 100, 2) if r["n"] else 0.0),
        ("recipes_with_zero_reviews", zero),
    ]
    return catalog.sparkSession.createDataFrame([(m, float(v)) for m, v in rows], "metric string, value double")


def rating_distribution(reviews: DataFrame, col: str = "Rating") -> DataFrame:
    """Reviews per rating value."""
    return reviews.groupBy(F.col(col).alias("rating")).agg(F.count(F.lit(1)).alias("count")).orderBy("rating")


def per_entity_counts(reviews: DataFrame, key: str) -> DataFrame:
    return reviews.groupBy(key).agg(F.count(F.lit(1)).alias("k"))


def activity_summary(reviews: DataFrame, key: str) -> DataFrame:
    """Mean, median and p95 of reviews per ``key`` (user or recipe)."""
    one = per_entity_counts(reviews, key).agg(F.avg("k").alias("mean"), F.percentile("k", F.lit(0.5)).alias("median"),
                                              F.percentile("k", F.lit(0.95)).alias("p95"))
    return _metric_table(one, [("mean", F.col("mean")), ("median", F.col("median")), ("p95", F.col("p95"))])


def equal_width_histogram(values: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum falls in the last bin."""
    rng = values.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()
    lo, hi = rng["lo"], rng["hi"]
    if lo is None:
        return values.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    span = (hi - lo) or 1.0
    idx = F.least(F.floor((F.col(col) - F.lit(lo)) * bins / F.lit(span)).cast("int"), F.lit(bins - 1))
    counts = values.where(F.col(col).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select("bin", (F.lit(lo) + F.col("bin") * F.lit(span / bins)).alias("bin_start"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(span / bins)).alias("bin_end"),
                         "count").orderBy("bin")


def top_by(df: DataFrame, order_col: str, n: int, id_col: str, cols: list[str]) -> DataFrame:
    """The ``n`` rows with the largest ``order_col`` (ties: id order)."""
    return df.orderBy(F.desc(order_col), id_col).limit(n).select(id_col, *cols)


def seeded_sample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """``n`` rows in a seeded pseudo-random order: the MD5 of id and seed.

    The id breaks ties.  Reproducible in any SQL engine, at any range of ids.
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(h, id_col).limit(n)


def leakage_audit(df: DataFrame) -> DataFrame:
    """P10: the leakage / exclusion audit, with whether each column is present."""
    spark = df.sparkSession
    rows = [(c, layer, allowed, reason, c in df.columns) for c, layer, allowed, reason in LEAKAGE_AUDIT]
    return spark.createDataFrame(rows, "column string, layer string, allowed_for_content_features boolean, "
                                       "reason string, present boolean")
