"""The eight table jobs, chained through written Parquet tables.

Each job reads its inputs, runs the operators and writes its outputs under
``out_dir`` (a shared folder on a cluster).  Writing the resolved table and
the matrices is also the lineage cut: a lost executor costs at most the
current job, and later jobs read Parquet (column pruning, pushdown) instead
of replaying upstream plans.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession

from larder.operators import audits as AU
from larder.operators import content as C
from larder.operators import contracts as K
from larder.operators import numeric as N
from larder.operators import reduce as RD
from larder.operators import resolve as R
from larder.operators import summaries as S
from larder.plans import models as M
from larder.plans.materialize import materialize


def _write(df: DataFrame, out_dir: str, name: str) -> str:
    path = os.path.join(out_dir, name)
    df.write.mode("overwrite").parquet(path)
    return path


def _read(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, name))


def run_resolve(spark: SparkSession, catalog: DataFrame, out_dir: str) -> DataFrame:
    """Job 2: resolved table + the seven resolution summaries + contract C1."""
    _write(R.resolve_catalog(catalog, cut=materialize), out_dir, "resolved")
    res = _read(spark, out_dir, "resolved")
    for name, df in [("category_missing_summary", S.category_summary(res)),
                     ("servings_yield_resolution_summary", S.servings_summary(res)),
                     ("yield_unit_token_counts", S.yield_unit_counts(res)),
                     ("time_presence_summary", S.time_presence(res)),
                     ("time_consistency_summary", S.time_consistency(res)),
                     ("time_derivation_summary", S.time_derivation(res)),
                     ("time_imputation_summary", S.time_imputation(res)),
                     ("resolved_contract", S.resolved_contract(catalog, res))]:
        _write(df, out_dir, f"summaries/{name}")
    return res


def _record(spark: SparkSession, values: dict, out_dir: str, name: str) -> None:
    """The record of a step as one JSON file."""
    spark.createDataFrame([(json.dumps(values),)], "config string").write.mode("overwrite").json(os.path.join(out_dir, name))


def run_token_audits(catalog: DataFrame, tokens: dict[str, DataFrame], out_dir: str) -> None:
    """Job 3, tokens: parse counts, top tokens and vocabulary sweeps of the list columns.

    ``tokens`` maps a name to its (id, token) table, which is written once and read by all three.
    """
    ids = catalog.select("RecipeId")
    for name, sets in tokens.items():
        sets = materialize(sets, "tokens")
        for kind, df in [("parse_summary", AU.list_parse_summary(ids, sets)),
                         ("top", AU.top_tokens(sets, 50, name)),
                         ("vocabulary_sweep", AU.vocabulary_sweep(ids, sets))]:
            _write(df, out_dir, f"audits/{name}_{kind}")


def run_audits(catalog: DataFrame, reviews: DataFrame, out_dir: str) -> None:
    """Job 3: catalog and interaction audits."""
    for name, df in [("missingness", AU.missingness(catalog)),
                     ("data_quality_summary", AU.quality_audit(catalog, reviews)),
                     ("time_order_checks", AU.time_order_checks(catalog)),
                     ("numeric_feature_summary", AU.numeric_profile(catalog)),
                     ("numeric_correlation_matrix", AU.correlation_matrix(catalog)),
                     ("category_summary", AU.category_coverage(catalog)),
                     ("temporal_summary", AU.temporal_summary(catalog)),
                     ("recipes_by_year", AU.recipes_per_year(catalog)),
                     ("interaction_summary", AU.interaction_summary(catalog, reviews)),
                     ("rating_distribution", AU.rating_distribution(reviews)),
                     ("leakage_audit", AU.leakage_audit(catalog))]:
        _write(df, out_dir, f"audits/{name}")


def run_numeric(spark: SparkSession, res: DataFrame, out_dir: str) -> tuple[DataFrame, N.NumericModel]:
    """Job 4: log and scaled matrices, summaries, feature names, contract, parameters, record."""
    model = N.fit_numeric(res)
    M.save_numeric(spark, model, out_dir)
    _write(N.log_matrix(res, model), out_dir, "numeric/log")
    _write(N.scaled_matrix(res, model), out_dir, "numeric/scaled")
    scaled = _read(spark, out_dir, "numeric/scaled")
    _write(N.preprocessing_summary(res, model), out_dir, "numeric/preprocessing_summary")
    _write(N.scaled_summary(scaled, model.features), out_dir, "numeric/scaled_summary")
    _write(N.feature_names(spark, model.features), out_dir, "numeric/feature_names")
    n_rows = scaled.count()
    _write(N.numeric_contract(_read(spark, out_dir, "numeric/log"), scaled, model.features, n_rows, names=_read(spark, out_dir, "numeric/feature_names")),
           out_dir, "numeric/contract")
    _record(spark, {"n_items": n_rows, "features": model.features, "clipping_quantiles": N.CLIPPING_QUANTILE_BY_GROUP},
            out_dir, "numeric/pipeline_config")
    return scaled, model


def run_content(spark: SparkSession, res: DataFrame, docs: dict[str, DataFrame], sources: dict[str, str],
                out_dir: str) -> C.ContentModel:
    """Job 5: long sparse matrix, feature dictionary, summaries, contract, record."""
    cm = C.build_content(res.select("RecipeId"), docs, sources, distinct=("ingredients", "keywords"))
    _write(cm.matrix.withColumnRenamed("id", "RecipeId"), out_dir, "content/matrix")
    _write(cm.features, out_dir, "content/features")
    _write(C.matrix_summary(spark, cm), out_dir, "content/summary")
    for g in ("ingredients", "keywords"):
        if g in cm.included:
            _write(C.token_summary(cm, g), out_dir, f"content/top_{g}")
    for g in ("category", "yield"):
        if g in cm.docs:
            _write(C.single_token_counts(cm.docs[g], "token"), out_dir, f"content/{g}_counts")
    _write(C.content_contract(cm), out_dir, "content/contract")
    _record(spark, {"n_items": cm.n_docs, "included": cm.included, "sources": cm.sources,
                    "limits": {g: [p.min_df, p.max_df] for g, p in cm.params.items()}}, out_dir, "content/pipeline_config")
    return cm


def run_reduce(spark: SparkSession, scaled: DataFrame, numeric: N.NumericModel, cm: C.ContentModel,
               out_dir: str) -> dict:
    """Jobs 6-7: PCA, SVD sweep, scores, combined embedding, comparison, metadata."""
    pca = RD.fit_pca(scaled, numeric.features)
    M.save_pca(spark, pca, out_dir)
    _write(RD.pca_explained(spark, pca), out_dir, "reduced/pca_explained")
    loadings = RD.pca_loadings(spark, pca)
    _write(loadings, out_dir, "reduced/pca_loadings")
    _write(RD.top_loadings(loadings), out_dir, "reduced/pca_top_loadings")
    _write(RD.pca_reconstruction(spark, pca), out_dir, "reduced/pca_reconstruction")
    matrix = _read(spark, out_dir, "content/matrix").withColumnRenamed("RecipeId", "id")
    f = cm.features.count()
    cands = RD.valid_svd_candidates(f)
    svd = RD.fit_svd(matrix, cm.n_docs, f, max(cands))
    M.save_svd(spark, svd, out_dir)
    sel = RD.DEFAULT_SELECTED_SVD_COMPONENTS if RD.DEFAULT_SELECTED_SVD_COMPONENTS in cands else max(cands)
    _write(RD.svd_sweep(spark, svd, cands), out_dir, "reduced/svd_sweep")
    _write(RD.reconstruction_sample(matrix, scaled.select("RecipeId"), svd, cands), out_dir, "reduced/svd_reconstruction_sample")
    _write(RD.svd_explained(spark, svd, sel), out_dir, "reduced/svd_explained")
    _write(RD.svd_top_terms(RD.components_long(svd, sel), cm.features), out_dir, "reduced/svd_top_terms")
    _write(RD.svd_scores(matrix, scaled.select("RecipeId"), svd, sel), out_dir, "reduced/svd_scores")
    _write(RD.pca_scores(scaled, pca), out_dir, "reduced/pca_scores")
    _write(RD.pca_scores(scaled, pca, k=2), out_dir, "reduced/pca_scores_2d")
    content = _read(spark, out_dir, "reduced/svd_scores")
    numeric_scores = _read(spark, out_dir, "reduced/pca_scores")
    cols = [c for c in numeric_scores.columns if c != "RecipeId"]
    _write(RD.combined_embedding(content, numeric_scores, cols), out_dir, "reduced/embedding")
    _write(RD.embedding_feature_names(spark, sel, pca.selected_k), out_dir, "reduced/embedding_features")
    meta = {"selected_pca_components": pca.selected_k,
            "achieved_cumulative_variance": float(pca.cumulative[pca.selected_k - 1]),
            "selected_svd_components": sel, "svd_candidates": cands,
            "svd_passes": svd.passes, "content_features": f, "n_items": cm.n_docs}
    _write(K.reduction_warnings(RD.svd_sweep(spark, svd, [sel]), cm.n_docs, sel + pca.selected_k), out_dir, "reduced/warnings")
    _record(spark, meta, out_dir, "reduced/pipeline_config")
    return meta


def run_all(spark: SparkSession, sf_dir: str, out_dir: str) -> dict:
    """All jobs over the driver tables (see ``larder.sources.testdata``).

    The catalog is a join of three tables; it is written once and every audit reads that.
    """
    from larder.plans.queries import CONTENT_SOURCES, content_docs, ingredient_sets, keyword_sets
    from larder.sources import ingest as IG
    from larder.sources import testdata as V

    _write(IG.ingest_catalog(IG.raw_catalog(spark, sf_dir)), out_dir, "ingested")
    catalog, reviews = materialize(V.catalog(spark, sf_dir), "catalog"), V.reviews(spark, sf_dir)
    res = run_resolve(spark, catalog, out_dir)
    run_audits(catalog, reviews, out_dir)
    run_token_audits(catalog, {"ingredients": ingredient_sets(spark, sf_dir), "keywords": keyword_sets(spark, sf_dir)}, out_dir)
    scaled, model = run_numeric(spark, res, out_dir)
    docs = content_docs(spark, sf_dir, res)
    _, removed = C.keyword_documents(V.keywords(spark, sf_dir), "RecipeId", "keyword")
    _write(removed, out_dir, "content/removed_time_keywords")
    cm = run_content(spark, res, docs, CONTENT_SOURCES, out_dir)
    _write(K.id_alignment(res, scaled), out_dir, "content/id_alignment")
    _write(K.matrix_warnings(_read(spark, out_dir, "numeric/preprocessing_summary"), _read(spark, out_dir, "content/summary"), cm.n_docs),
           out_dir, "content/warnings")
    return run_reduce(spark, scaled, model, cm, out_dir)

