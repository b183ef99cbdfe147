"""Legacy one-shot variant (M14, M15): other parameters on the same operators.

M14: 11 raw numeric columns, median fill, population-std scaling (no clip,
no log), full PCA, first 6 scores.  M15: list items with spaces joined by
``_``, the two-or-more-word-character token pattern, raw term counts (no
de-duplication, no sublinear tf), ``min_df = 5``, the 5,000 terms with the
largest corpus count, smooth idf, L2 rows; then a truncated SVD.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.moments import co_moments
from larder.functions.quantiles import exact_quantiles
from larder.functions.text import LEGACY_TOKEN_PATTERN, vectorizer_terms
from larder.operators import reduce as RD
from larder.operators.content import task_partitions

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
LEGACY_NUMERIC_COLS = [
    "Calories", "FatContent", "SaturatedFatContent", "CholesterolContent", "SodiumContent",
    "CarbohydrateContent", "FiberContent", "SugarContent", "ProteinContent", "CookTime_Minutes",
    "PrepTime_Minutes",
]
LEGACY_PCA_SCORES = 6
LEGACY_MIN_DF = 5
LEGACY_MAX_FEATURES = 5000
LEGACY_SVD_COMPONENTS = 100
# ---------------------------------------------------------------------------


def legacy_scaled(df: DataFrame, cols: list[str] = LEGACY_NUMERIC_COLS, id_col: str = "RecipeId") -> DataFrame:
    """M14 input: median-filled, standard-scaled raw columns (population std)."""
    from larder.plans.materialize import materialize

    # written once: the passes of the quantiles and of the fit read it instead of joining the catalog again
    df = materialize(df.select(id_col, *cols), "legacy-input")
    med = exact_quantiles(df, {c: F.col(c) for c in cols}, [0.5])
    filled = df.select(F.col(id_col), *[F.coalesce(F.col(c).cast("double"), F.lit(med[c][0])).alias(c)
                                        for c in cols])
    st = co_moments(filled, cols)
    return filled.select(F.col(id_col), *[
        ((F.col(c) - F.lit(st.mean_of(i))) / F.lit(st.stddev_pop(i) or 1.0)).alias(c) for i, c in enumerate(cols)])


def legacy_terms(long_df: DataFrame, id_col: str, raw_col: str, parts: int | None = None) -> DataFrame:
    """M15 tokens: ``(id, term, tf)`` with raw counts (every list item counts), counted by id in ``parts`` partitions."""
    if parts is not None:
        long_df = long_df.select(id_col, raw_col).repartition(parts, id_col)
    item = F.replace(F.col(raw_col).cast("string"), F.lit(" "), F.lit("_"))
    return (long_df.select(F.col(id_col).alias("id"), F.explode(vectorizer_terms(item, LEGACY_TOKEN_PATTERN))
                           .alias("term"))
            .groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")))


def legacy_vocabulary(terms: DataFrame, n_docs: int, min_df: int = LEGACY_MIN_DF,
                      max_features: int = LEGACY_MAX_FEATURES) -> DataFrame:
    """M15 vocabulary: ``df >= min_df``, then the top terms by corpus count (ties: term)."""
    from larder.plans.partitioning import dense_index

    stats = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_count"))
    kept = stats.where(F.col("df") >= min_df)
    top = kept.orderBy(F.desc("total_count"), "term").limit(max_features)  # distributed top-k
    top = top.select("term", "df", "total_count",
                     (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    return dense_index(top, ["term"], "feature_index").withColumn(
        "feature_index", F.col("feature_index").cast("int"))


def legacy_matrix(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    """M15 matrix: raw tf x smooth idf, L2-normalized per document."""
    j = terms.join(vocab.select("term", "feature_index", "idf"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    # one shuffle by id, in as many partitions as the rows ask for; a partition of the window is one document
    j = j.where(F.col("id").isNotNull()).select("id", "feature_index", "w").repartition(task_partitions(terms, terms.count()), "id")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return j.select("id", "feature_index", (F.col("w") / norm).alias("value"))


def legacy_svd(matrix: DataFrame, n_docs: int, n_features: int, k: int = LEGACY_SVD_COMPONENTS) -> RD.SVDModel:
    k = min(k, max(1, n_features - 1))
    return RD.fit_svd(matrix, n_docs, n_features, k)
