"""Dimensionality reduction (jobs 6-7): numeric PCA, content SVD, embeddings.

PCA: the sample covariance of the scaled matrix is **one** distributed
pass (``functions.moments``, a d x d matrix of each task); its d x d
eigen-decomposition runs on the driver (d = 15).  Scores are a projection.

SVD: the content matrix stays sparse and long, V is a table of a row per
feature (``operators.tall``: block Lanczos over panels of columns, tall-skinny QR as
a tree; a matrix of few features by its Gramian), and scores are made of whole rows
of the matrix, in blocks of components.  Lanczos stops when ``||XᵀXv - λv||`` is small
for all wanted components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions.moments import co_moments
from larder.operators.tall import leading_vectors, row_products

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
PCA_TARGET_VARIANCE = 0.90
SVD_CANDIDATES = [50, 100, 200, 300]
DEFAULT_SELECTED_SVD_COMPONENTS = 200
RANDOM_STATE = 42
PCA_TOP_LOADINGS = 10
SVD_TOP_TERMS = 15
SVD_RECONSTRUCTION_MAX_ROWS = 20_000
SVD_RECONSTRUCTION_MAX_DENSE_ENTRIES = 25_000_000
# ---------------------------------------------------------------------------


def fix_signs(components: np.ndarray) -> np.ndarray:
    """Make the largest-|loading| entry of each component (row) positive (ties: lowest index)."""
    idx = np.argmax(np.abs(components), axis=1)
    signs = np.sign(components[np.arange(components.shape[0]), idx])
    signs[signs == 0] = 1.0
    return components * signs[:, None]


# -- PCA ------------------------------------------------------------------------

def covariance_long(scaled: DataFrame, features: list[str]) -> DataFrame:
    """Sample covariance of every feature pair as ``(feature_i, feature_j, covariance)``."""
    m = co_moments(scaled, features)
    rows = [(a, b, m.covar_samp(i, j)) for i, a in enumerate(features) for j, b in enumerate(features)]
    return scaled.sparkSession.createDataFrame(rows, "feature_i string, feature_j string, covariance double")


@dataclass
class PCAModel:
    features: list[str]
    n: int
    mean: np.ndarray
    eigenvalues: np.ndarray       # descending, sample covariance (ddof = 1)
    components: np.ndarray        # rows = components
    selected_k: int

    @property
    def ratio(self) -> np.ndarray:
        return self.eigenvalues / self.eigenvalues.sum()

    @property
    def cumulative(self) -> np.ndarray:
        return np.cumsum(self.ratio)


def fit_pca(scaled: DataFrame, features: list[str], target: float = PCA_TARGET_VARIANCE) -> PCAModel:
    """M6: full PCA from one covariance aggregate; k = first cumulative ratio >= target."""
    d = len(features)
    m = co_moments(scaled, features)
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = m.covar_samp(i, j)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals = np.clip(vals[order], 0.0, None)
    comps = fix_signs(vecs[:, order].T)
    cum = np.cumsum(vals / vals.sum())
    k = int(np.searchsorted(cum, target - 1e-12) + 1)
    mean = np.array([m.mean_of(i) for i in range(d)])
    return PCAModel(list(features), scaled.count(), mean, vals, comps, min(k, d))


def pca_explained(spark: SparkSession, model: PCAModel) -> DataFrame:
    """M6 + W1: variance, ratio and running ratio per component."""
    rows = [(i + 1, float(v), float(r)) for i, (v, r) in enumerate(zip(model.eigenvalues, model.ratio))]
    df = spark.createDataFrame(rows, "component int, explained_variance double, explained_variance_ratio double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("cumulative_explained_variance_ratio", F.sum("explained_variance_ratio").over(w))


def selected_components(explained: DataFrame, target: float = PCA_TARGET_VARIANCE) -> DataFrame:
    """Smallest k whose running ratio reaches the target, with that ratio."""
    return (explained.where(F.col("cumulative_explained_variance_ratio") >= target - 1e-12)
            .agg(F.min("component").alias("selected_k"))
            .join(explained, F.col("selected_k") == F.col("component"))
            .select("selected_k", F.col("cumulative_explained_variance_ratio").alias("achieved_variance")))


def pca_loadings(spark: SparkSession, model: PCAModel) -> DataFrame:
    """M7: loading of every feature on every component."""
    rows = []
    for c, (vec, r) in enumerate(zip(model.components, model.ratio), start=1):
        for fi, f in enumerate(model.features):
            rows.append((c, fi, f, float(vec[fi]), float(abs(vec[fi])), float(r)))
    return spark.createDataFrame(rows, "component int, feature_index int, feature string, loading double, "
                                       "abs_loading double, explained_variance_ratio double")


def top_loadings(loadings: DataFrame, top: int = PCA_TOP_LOADINGS) -> DataFrame:
    """The ``top`` largest |loading| features per component (ties: feature order)."""
    w = Window.partitionBy("component").orderBy(F.desc("abs_loading"), "feature_index")
    return (loadings.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("component", "rank", "feature", "loading", "abs_loading"))


def pca_reconstruction(spark: SparkSession, model: PCAModel) -> DataFrame:
    """M8: reconstruction MSE / RMSE for k = 1..d, in closed form.

    ``||X - X_k||² = (n - 1) Σ_{i>k} λ_i``, so MSE = (n-1)/n · Σ_{i>k} λ_i / d.
    """
    d, n = len(model.features), model.n
    tail = np.concatenate([np.cumsum(model.eigenvalues[::-1])[::-1][1:], [0.0]])
    rows = []
    for k in range(1, d + 1):
        mse = max(float((n - 1) / n * tail[k - 1] / d), 0.0)
        rows.append((k, float(model.cumulative[k - 1]), mse, float(np.sqrt(mse))))
    return spark.createDataFrame(rows, "n_components int, cumulative_explained_variance_ratio double, "
                                       "reconstruction_mse double, reconstruction_rmse double")


def pca_scores(scaled: DataFrame, model: PCAModel, k: int | None = None, id_col: str = "RecipeId",
               prefix: str = "numeric_pca_") -> DataFrame:
    """M6 scores: centered projection on the first k components (a column projection)."""
    k = k or model.selected_k
    cols = []
    for c in range(k):
        expr = None
        for fi, f in enumerate(model.features):
            term = (F.col(f) - F.lit(float(model.mean[fi]))) * F.lit(float(model.components[c, fi]))
            expr = term if expr is None else expr + term
        cols.append(expr.alias(f"{prefix}{c + 1:03d}"))
    return scaled.select(F.col(id_col), *cols)


# -- truncated SVD of the long sparse content matrix ----------------------------------

def _scaled_sum(vec: str, weight: str, out: str):
    """Σ weight · vec as a JVM vector-sum aggregate (no sign assumption on the weights)."""
    scaled = F.transform(F.col(vec), lambda e: e * F.col(weight))
    return vector_to_array(Summarizer.sum(array_to_vector(scaled))).alias(out)


@dataclass
class SVDModel:
    n_rows: int
    n_features: int
    singular_values_sq: np.ndarray   # λ_j = σ_j², descending
    vectors: DataFrame               # (feature_index, vector): right singular vectors, an entry per component
    mean_projection: np.ndarray      # mean(X) · v_j
    total_variance: float            # Σ_f var(X_f), population
    frob_sq: float                   # ||X||²
    passes: int = 0

    @property
    def k(self) -> int:
        return len(self.singular_values_sq)

    def explained_variance(self, k: int) -> np.ndarray:
        """var(Z_j) = σ_j²/n − (mean(X)·v_j)², population (as the reference reports)."""
        return self.singular_values_sq[:k] / self.n_rows - self.mean_projection[:k] ** 2

    def explained_variance_ratio(self, k: int) -> np.ndarray:
        return self.explained_variance(k) / self.total_variance


def valid_svd_candidates(n_features: int, candidates: list[int] = SVD_CANDIDATES) -> list[int]:
    """M9: the candidates that a matrix of this width allows, or one small rank where none is."""
    if n_features < 2:
        raise ValueError(f"{n_features} feature(s) leave nothing to reduce")
    below = [k for k in candidates if k < n_features]
    return below if below else [min(10, n_features - 1)]


def fit_svd(matrix: DataFrame, n_rows: int, n_features: int, k: int, oversample: int = 10,
            tolerance: float = 1e-8, seed: int = RANDOM_STATE) -> SVDModel:
    """M9 fit: top-k right singular vectors of the long matrix ``(id, feature_index, value)``.

    V stays a table; the driver gets k numbers and single totals.  The residual of every
    component is at most ``tolerance`` times the largest eigenvalue (``operators.tall``).
    """
    from larder.plans.materialize import materialize

    stats = materialize(matrix.groupBy("feature_index").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("s2")), "svd-columns")
    mean = F.col("s") / n_rows
    one = stats.agg(F.sum("s2").alias("sq"), F.sum(F.col("s2") / n_rows - mean * mean).alias("var")).first()
    found = leading_vectors(matrix, n_features, k, oversample, tolerance, seed=seed)
    vectors = found.vectors
    along = vectors.join(stats.select("feature_index", mean.alias("mean")), "feature_index").agg(_scaled_sum("vector", "mean", "m")).first()["m"]
    return SVDModel(n_rows, n_features, found.eigenvalues, vectors, np.array(along), float(one["var"]), float(one["sq"]), found.passes)


def svd_sweep(spark: SparkSession, model: SVDModel, candidates: list[int]) -> DataFrame:
    """Retained energy and exact reconstruction error for each candidate k.

    Reconstruction over **all** rows in closed form,
    ``(||X||² − Σ_{j<=k} σ_j²) / (n f)``, instead of a sampled dense block.
    """
    rows = []
    for k in candidates:
        energy = float(model.explained_variance_ratio(k).sum())
        mse = max((model.frob_sq - float(model.singular_values_sq[:k].sum())) / (model.n_rows * model.n_features), 0.0)
        rows.append((k, energy, mse, float(np.sqrt(mse)), model.n_rows, model.n_features, model.n_rows, k,
                     RANDOM_STATE))
    return spark.createDataFrame(rows, "n_components int, retained_energy double, reconstruction_mse double, "
                                       "reconstruction_rmse double, input_shape_rows long, input_shape_cols long, "
                                       "output_shape_rows long, output_shape_cols int, random_state int")


def svd_explained(spark: SparkSession, model: SVDModel, k: int) -> DataFrame:
    """Explained variance table of the selected SVD (W1 running total)."""
    ev, er = model.explained_variance(k), model.explained_variance_ratio(k)
    df = spark.createDataFrame([(j + 1, float(ev[j]), float(er[j])) for j in range(k)],
                               "component int, explained_variance double, explained_variance_ratio double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("cumulative_explained_variance_ratio", F.sum("explained_variance_ratio").over(w))


def components_long(model: SVDModel, k: int) -> DataFrame:
    """Right singular vectors as ``(component, feature_index, loading)``."""
    return (model.vectors.select("feature_index", F.posexplode(F.slice("vector", 1, k)).alias("c", "loading"))
            .select((F.col("c") + 1).alias("component"), "feature_index", "loading"))


def two_sided_top(loadings: DataFrame, top: int) -> DataFrame:
    """(component, side, feature_index, loading, rank): the ``top`` largest and smallest loadings of each component.

    Ties go to the lower feature_index.  Every task keeps ``top`` rows a side for each component it
    meets, whatever the rows it reads; only these are merged.  NULL loadings are left out.
    """
    kind = loadings.schema["component"].dataType.simpleString()

    def kept(batches):
        import pyarrow as pa

        held = None
        for b in batches:
            now = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            codes = now["component"].combine_chunks().dictionary_encode().indices.to_numpy()
            feature, loading = now["feature_index"].to_numpy(), now["loading"].to_numpy()
            chosen = np.zeros(len(codes), dtype=bool)
            for by in (-loading, loading):
                order = np.lexsort((feature, by, codes))
                first = np.concatenate([[True], codes[order][1:] != codes[order][:-1]])
                place = np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1]
                chosen[order[place < top]] = True
            held = now.filter(pa.array(chosen)).combine_chunks()
        if held is not None:
            yield from held.to_batches()

    rows = loadings.where(F.col("loading").isNotNull() & F.col("component").isNotNull()).select(
        "component", F.col("feature_index").cast("long").alias("feature_index"), F.col("loading").cast("double").alias("loading"))
    few = rows.mapInArrow(kept, f"component {kind}, feature_index long, loading double")
    sides = few.select("*", F.explode(F.array(F.lit("positive"), F.lit("negative"))).alias("side"))
    by = F.when(F.col("side") == "positive", -F.col("loading")).otherwise(F.col("loading"))
    w = Window.partitionBy("component", "side").orderBy(by, "feature_index")
    return sides.select("component", "side", "feature_index", "loading", F.row_number().over(w).alias("rank")).where(F.col("rank") <= top)


def svd_top_terms(loadings: DataFrame, features: DataFrame, top: int = SVD_TOP_TERMS) -> DataFrame:
    """W5 + J8: top positive and top negative terms per component, with names and groups."""
    few = two_sided_top(loadings, top)
    return few.join(features.select("feature_index", "feature_name", "feature_group"), "feature_index").select(
        "component", "side", "rank", "feature_name", "feature_group", "loading", F.abs("loading").alias("abs_loading"))


def projected(matrix: DataFrame, vectors: DataFrame, k: int, columns: int | None = None) -> DataFrame:
    """(id, z): ``X V_k`` as a sparse product, ``columns`` components at a time (``operators.tall``).

    The long matrix is shuffled once, by id; a row of scores is made whole where its entries are.
    """
    return row_products(matrix, vectors, k, columns)


def svd_scores(matrix: DataFrame, ids: DataFrame, model: SVDModel, k: int, id_col: str = "RecipeId") -> DataFrame:
    """``Z = X V_k`` per row (rows without any nonzero get zeros)."""
    z = row_products(matrix, model.vectors, k, ids=ids.select(F.col(id_col).alias("id")))
    return z.select(F.col("id").alias(id_col), F.col("z").alias("content_svd"))


def reconstruction_sample(matrix: DataFrame, ids: DataFrame, model: SVDModel, ks: list[int], id_col: str = "RecipeId",
                          max_rows: int = SVD_RECONSTRUCTION_MAX_ROWS, max_entries: int = SVD_RECONSTRUCTION_MAX_DENSE_ENTRIES) -> DataFrame:
    """Mean squared residual of sampled rows for every k of ``ks``, row by row.

    The sample is min(n, ``max_rows``, ``max_entries`` / features) rows at even distances of the
    positional index of the ids (W2).  A row's residual is ``||x||² − ||x V_k||²``, as V's columns
    are orthonormal.
    """
    from larder.plans.partitioning import dense_index

    n = ids.count()
    size = max(1, min(n, max_rows, max_entries // max(model.n_features, 1)))
    placed = dense_index(ids.select(id_col), [id_col], "row_index")
    step = F.floor((F.col("row_index") + 1) * size / F.lit(n)) - F.floor(F.col("row_index") * size / F.lit(n))
    sample = placed.where(step > 0).select(F.col(id_col).alias("id"))
    norms = matrix.join(sample, "id", "left_semi").groupBy("id").agg(F.sum(F.col("value") * F.col("value")).alias("norm"))
    z = projected(matrix.join(sample, "id", "left_semi"), model.vectors, max(ks))
    kept = F.explode(F.array(*(F.struct(F.lit(k).alias("n_components"), F.aggregate(F.slice("z", 1, k), F.lit(0.0), lambda a, x: a + x * x).alias("kept")) for k in ks))).alias("e")
    rows = norms.join(z, "id").select("norm", kept).groupBy(F.col("e.n_components").alias("n_components")).agg(F.sum(F.greatest(F.col("norm") - F.col("e.kept"), F.lit(0.0))).alias("total"))
    entries = float(size) * model.n_features
    return rows.select("n_components", (F.col("total") / entries).alias("reconstruction_mse_sample"), F.sqrt(F.col("total") / entries).alias("reconstruction_rmse_sample"),
                       F.lit(size).cast("long").alias("sample_rows"))


def combined_embedding(content: DataFrame, numeric: DataFrame, numeric_cols: list[str],
                       id_col: str = "RecipeId") -> DataFrame:
    """J7 + M13: ``[content SVD, numeric PCA]`` per item."""
    num = numeric.select(F.col(id_col), F.array(*[F.col(c) for c in numeric_cols]).alias("numeric_pca"))
    return (content.join(num, id_col, "inner")
            .select(F.col(id_col), F.concat("content_svd", "numeric_pca").alias("embedding")))


def embedded(matrix: DataFrame, ids: DataFrame, model: SVDModel, k: int, numeric: DataFrame, numeric_cols: list[str],
             id_col: str = "RecipeId") -> DataFrame:
    """M12 + J7 + M13: ``combined_embedding`` of ``svd_scores``, with the numeric scores at hand where the
    content scores are made, so that these are not shuffled."""
    num = numeric.select(F.col(id_col).alias("id"), F.array(*[F.col(c) for c in numeric_cols]).alias("extra"))
    z = row_products(matrix, model.vectors, k, ids=ids.select(F.col(id_col).alias("id")), carry=num)
    return z.select(F.col("id").alias(id_col), F.concat("z", "extra").alias("embedding"))


def embedding_feature_names(spark: SparkSession, k_content: int, k_numeric: int) -> DataFrame:
    """J7 names: ``content_svd_001…`` then ``numeric_pca_001…``."""
    rows = [(i, f"content_svd_{i + 1:03d}", "content_svd", "X_content_svd") for i in range(k_content)]
    rows += [(k_content + i, f"numeric_pca_{i + 1:03d}", "numeric_pca", "X_numeric_pca") for i in range(k_numeric)]
    return spark.createDataFrame(rows, "feature_index int, feature_name string, feature_group string, "
                                       "source_representation string")
