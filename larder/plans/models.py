"""Fitted parameters as Parquet tables, written once and read back exactly.

Parquet keeps every bit of a double, so scores of a reloaded model equal the first ones.
The vocabulary is the content feature dictionary (S8) and needs no table of its own.
"""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from larder.operators import reduce as RD
from larder.operators.numeric import NumericModel


def _save(spark: SparkSession, rows: list, schema: str, out_dir: str, name: str) -> None:
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(out_dir, "models", name))


def _load(spark: SparkSession, out_dir: str, name: str, *order: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, "models", name)).orderBy(*order)


def save_numeric(spark: SparkSession, model: NumericModel, out_dir: str) -> None:
    """Median, cap (NULL where a feature is not clipped), mean and population std of each feature."""
    rows = [(i, f, model.medians[f], model.caps[f], model.means[f], model.stds[f]) for i, f in enumerate(model.features)]
    _save(spark, rows, "feature_index int, feature string, median double, cap double, mean double, std double", out_dir, "numeric")


def load_numeric(spark: SparkSession, out_dir: str) -> NumericModel:
    """The model without the counts of its fit (``stats``), which no matrix needs."""
    rows = _load(spark, out_dir, "numeric", "feature_index").collect()
    per = {name: {r["feature"]: r[name] for r in rows} for name in ("median", "cap", "mean", "std")}
    return NumericModel([r["feature"] for r in rows], per["median"], per["cap"], per["mean"], per["std"])


def save_pca(spark: SparkSession, model: RD.PCAModel, out_dir: str) -> None:
    """The means, and one row for each component with its eigenvalue and loadings."""
    _save(spark, [(i, f, float(m)) for i, (f, m) in enumerate(zip(model.features, model.mean))],
          "feature_index int, feature string, mean double", out_dir, "pca_features")
    rows = [(c + 1, float(v), [float(x) for x in vec], c < model.selected_k, model.n)
            for c, (v, vec) in enumerate(zip(model.eigenvalues, model.components))]
    _save(spark, rows, "component int, eigenvalue double, loadings array<double>, selected boolean, n_rows long", out_dir, "pca_components")


def load_pca(spark: SparkSession, out_dir: str) -> RD.PCAModel:
    features = _load(spark, out_dir, "pca_features", "feature_index").collect()
    comps = _load(spark, out_dir, "pca_components", "component").collect()
    return RD.PCAModel([r["feature"] for r in features], comps[0]["n_rows"], np.array([r["mean"] for r in features]),
                       np.array([r["eigenvalue"] for r in comps]), np.array([r["loadings"] for r in comps]),
                       sum(r["selected"] for r in comps))


def save_svd(spark: SparkSession, model: RD.SVDModel, out_dir: str) -> None:
    """V as a table of one row per feature; one row per component with its squared singular value; the totals."""
    model.vectors.write.mode("overwrite").parquet(os.path.join(out_dir, "models", "svd_vectors"))
    rows = [(c + 1, float(v), float(m)) for c, (v, m) in enumerate(zip(model.singular_values_sq, model.mean_projection))]
    _save(spark, rows, "component int, singular_value_sq double, mean_projection double", out_dir, "svd_components")
    one = (model.n_rows, model.n_features, model.total_variance, model.frob_sq, model.passes)
    _save(spark, [one], "n_rows long, n_features int, total_variance double, frob_sq double, passes int", out_dir, "svd_totals")


def load_svd(spark: SparkSession, out_dir: str) -> RD.SVDModel:
    comps = _load(spark, out_dir, "svd_components", "component").collect()
    one = _load(spark, out_dir, "svd_totals", "n_rows").first()
    vectors = spark.read.parquet(os.path.join(out_dir, "models", "svd_vectors"))
    return RD.SVDModel(one["n_rows"], one["n_features"], np.array([r["singular_value_sq"] for r in comps]), vectors,
                       np.array([r["mean_projection"] for r in comps]), one["total_variance"], one["frob_sq"], one["passes"])
