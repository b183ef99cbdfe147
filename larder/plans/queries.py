"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's whole tables (through the views in
``larder.sources.testdata``) and runs the library operators on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import resolve as R
from larder.plans.materialize import discard, materialize
from larder.plans.partitioning import dense_index
from larder.sources import testdata as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_STAGES: dict[tuple, object] = {}


def _identity(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of every table in the folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def stage(spark: SparkSession, sf_dir: str, name: str, build):
    """A materialized stage output, built once per session and input folder.

    Later queries read the checkpointed table (as a pipeline step reads the
    previous step's written output) instead of recomputing its lineage.  The key
    holds the sizes and times of the input tables, so changed input is built anew.
    """
    key = (spark.sparkContext.applicationId, sf_dir, _identity(spark, sf_dir), name)
    if key not in _STAGES:
        _STAGES[key] = build()
    return _STAGES[key]


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resolved catalog, checkpointed: every later stage reads it."""
    def build():
        cuts = []

        def cut(df, *name):
            cuts.append(materialize(df, *name))
            return cuts[-1]

        out = materialize(R.resolve_catalog(V.catalog(spark, sf_dir), cut=cut))
        # the parsed tables are read by the resolved one only
        discard(*cuts)
        return out

    return stage(spark, sf_dir, "resolved", build)


SERVINGS_COLS = [
    "servings_missing_original", "RecipeServings_clean", "RecipeYield_clean",
    "servings_parsed_from_yield", "ResolvedServings", "servings_from_yield",
    "servings_missing_after_yield_parse", "ResolvedServings_imputed",
    "servings_imputed_with_category_median", "servings_imputed_with_global_median",
    "yield_unit_token",
]
TIME_COLS = [
    "PrepTime_Minutes_clean", "CookTime_Minutes_clean", "TotalTime_Minutes_clean",
    "preptime_missing_original", "cooktime_missing_original", "totaltime_missing_original",
    "CookTime_Minutes_resolved", "cooktime_derived_from_total_prep",
    "PrepTime_Minutes_resolved", "preptime_derived_from_total_cook",
    "TotalTime_Minutes_resolved", "totaltime_derived_from_prep_cook",
    "time_arithmetic_consistent", "time_arithmetic_mismatch",
    "CookTime_Minutes_imputed", "cooktime_imputed_with_category_median",
    "cooktime_imputed_with_global_median",
    "PrepTime_Minutes_imputed", "preptime_imputed_with_category_median",
    "preptime_imputed_with_global_median",
    "TotalTime_Minutes_imputed", "totaltime_imputed_with_category_median",
    "totaltime_imputed_with_global_median",
]


@query("category_clean")
def q_category_clean(spark, sf_dir):
    """F6 / P6 / P8 over the whole catalog."""
    df = R.clean_category(V.catalog(spark, sf_dir))
    return df.select("RecipeId", "category_missing_original", "RecipeCategory_clean")


@query("servings_resolution")
def q_servings_resolution(spark, sf_dir):
    """Servings from explicit value, yield text, then medians."""
    return resolved(spark, sf_dir).select("RecipeId", "RecipeCategory_clean", *SERVINGS_COLS)


@query("time_resolution")
def q_time_resolution(spark, sf_dir):
    """Derived and imputed prep / cook / total minutes."""
    return resolved(spark, sf_dir).select("RecipeId", *TIME_COLS)


# -- resolution summaries (A10-A16) and contract C1 ---------------------------

from larder.operators import summaries as S  # noqa: E402


@query("category_summary")
def q_category_summary(spark, sf_dir):
    return S.category_summary(resolved(spark, sf_dir))


@query("servings_summary")
def q_servings_summary(spark, sf_dir):
    return S.servings_summary(resolved(spark, sf_dir))


@query("yield_unit_counts")
def q_yield_unit_counts(spark, sf_dir):
    return S.yield_unit_counts(resolved(spark, sf_dir))


@query("time_presence")
def q_time_presence(spark, sf_dir):
    return S.time_presence(resolved(spark, sf_dir))


@query("time_consistency")
def q_time_consistency(spark, sf_dir):
    return S.time_consistency(resolved(spark, sf_dir), variant="script")


@query("time_consistency_eda")
def q_time_consistency_eda(spark, sf_dir):
    return S.time_consistency(resolved(spark, sf_dir), variant="eda")


@query("time_derivation")
def q_time_derivation(spark, sf_dir):
    return S.time_derivation(resolved(spark, sf_dir))


@query("time_imputation")
def q_time_imputation(spark, sf_dir):
    return S.time_imputation(resolved(spark, sf_dir))


@query("resolved_contract")
def q_resolved_contract(spark, sf_dir):
    return S.resolved_contract(V.catalog(spark, sf_dir), resolved(spark, sf_dir))


# -- numeric matrix (M1, M2, A6, A7, C2) -----------------------------------------

from larder.operators import numeric as N  # noqa: E402


def numeric_fit(spark, sf_dir):
    res = resolved(spark, sf_dir)
    return res, stage(spark, sf_dir, "numeric_model", lambda: N.fit_numeric(res))


@query("numeric_log_matrix")
def q_numeric_log_matrix(spark, sf_dir):
    res, model = numeric_fit(spark, sf_dir)
    return N.log_matrix(res, model)


@query("numeric_scaled")
def q_numeric_scaled(spark, sf_dir):
    res, model = numeric_fit(spark, sf_dir)
    return N.scaled_matrix(res, model)


@query("numeric_preprocessing_summary")
def q_numeric_preprocessing_summary(spark, sf_dir):
    res, model = numeric_fit(spark, sf_dir)
    return N.preprocessing_summary(res, model)


@query("numeric_scaled_summary")
def q_numeric_scaled_summary(spark, sf_dir):
    res, model = numeric_fit(spark, sf_dir)
    return N.scaled_summary(N.scaled_matrix(res, model), model.features)


@query("numeric_contract")
def q_numeric_contract(spark, sf_dir):
    res, model = numeric_fit(spark, sf_dir)
    n = res.count()
    return N.numeric_contract(N.log_matrix(res, model), N.scaled_matrix(res, model),
                              model.features, n, names=N.feature_names(spark, model.features))


@query("item_index")
def q_item_index(spark, sf_dir):
    """The position of every item in the order of the ids."""
    return dense_index(resolved(spark, sf_dir).select("RecipeId"), ["RecipeId"], "row_index")


# -- content matrix (F14-F22, M3-M5, A32-A34, C4, J6, W3, P14) --------------------

from larder.operators import content as C  # noqa: E402

CONTENT_SOURCES = {"ingredients": "RecipeIngredientParts", "keywords": "Keywords",
                   "category": "RecipeCategory_clean", "yield": "yield_unit_token"}


def content_docs(spark, sf_dir, res):
    """Token occurrences of every group; ingredients and keywords are made distinct by ``build_content``."""
    return {
        "ingredients": C.ingredient_tokens(V.ingredients(spark, sf_dir), "RecipeId", "ingredient"),
        "keywords": C.keyword_tokens(V.keywords(spark, sf_dir), "RecipeId", "keyword"),
        "category": C.category_documents(res),
        "yield": C.yield_documents(res),
    }


def content_model(spark, sf_dir):
    def build():
        res = resolved(spark, sf_dir)
        return C.build_content(res.select("RecipeId"), content_docs(spark, sf_dir, res), CONTENT_SOURCES, distinct=("ingredients", "keywords"))
    return stage(spark, sf_dir, "content_model", build)


@query("ingredient_documents")
def q_ingredient_documents(spark, sf_dir):
    """Distinct normalized ingredient tokens per recipe (long form)."""
    docs = C.ingredient_documents(V.ingredients(spark, sf_dir), "RecipeId", "ingredient")
    return docs.withColumnRenamed("id", "RecipeId")


@query("keyword_removed_time_tags")
def q_keyword_removed(spark, sf_dir):
    """time-like keyword tags removed from keyword documents, with counts."""
    _, removed = C.keyword_documents(V.keywords(spark, sf_dir), "RecipeId", "keyword")
    return removed


@query("tfidf_weighted")
def q_tfidf_weighted(spark, sf_dir):
    """The stacked weighted TF-IDF matrix in long form."""
    m = content_model(spark, sf_dir)
    return m.matrix.withColumnRenamed("id", "RecipeId")


@query("content_features")
def q_content_features(spark, sf_dir):
    """Numbered feature dictionary with group, weight, df and idf."""
    return content_model(spark, sf_dir).features.drop("term")


@query("token_summary_ingredients")
def q_token_summary_ingredients(spark, sf_dir):
    return C.token_summary(content_model(spark, sf_dir), "ingredients")


@query("token_summary_keywords")
def q_token_summary_keywords(spark, sf_dir):
    return C.token_summary(content_model(spark, sf_dir), "keywords")


@query("category_token_counts")
def q_category_token_counts(spark, sf_dir):
    return C.single_token_counts(C.category_documents(resolved(spark, sf_dir)), "category_token")


@query("yield_token_counts")
def q_yield_token_counts(spark, sf_dir):
    return C.single_token_counts(C.yield_documents(resolved(spark, sf_dir)), "yield_token")


@query("content_matrix_summary")
def q_content_matrix_summary(spark, sf_dir):
    return C.matrix_summary(spark, content_model(spark, sf_dir))


@query("content_contract")
def q_content_contract(spark, sf_dir):
    return C.content_contract(content_model(spark, sf_dir))


# -- reduction and embedding (M6-M13, J7, J8, W1, W4, W5, W7, A35, C5, C6) ---------

from larder.operators import reduce as RD  # noqa: E402


def scaled_numeric(spark, sf_dir):
    res, model = numeric_fit(spark, sf_dir)
    return stage(spark, sf_dir, "scaled", lambda: materialize(N.scaled_matrix(res, model))), model


def pca_model(spark, sf_dir):
    scaled, nmodel = scaled_numeric(spark, sf_dir)
    return scaled, stage(spark, sf_dir, "pca_model", lambda: RD.fit_pca(scaled, nmodel.features))


@query("pca_covariance")
def q_pca_covariance(spark, sf_dir):
    """M6 input: sample covariance of every pair of scaled numeric features."""
    scaled, nmodel = scaled_numeric(spark, sf_dir)
    return RD.covariance_long(scaled, nmodel.features)


@query("pca_explained")
def q_pca_explained(spark, sf_dir):
    _, m = pca_model(spark, sf_dir)
    return RD.pca_explained(spark, m)


@query("pca_selected")
def q_pca_selected(spark, sf_dir):
    _, m = pca_model(spark, sf_dir)
    return RD.selected_components(RD.pca_explained(spark, m))


@query("pca_loadings")
def q_pca_loadings(spark, sf_dir):
    _, m = pca_model(spark, sf_dir)
    return RD.pca_loadings(spark, m)


@query("pca_top_loadings")
def q_pca_top_loadings(spark, sf_dir):
    _, m = pca_model(spark, sf_dir)
    return RD.top_loadings(RD.pca_loadings(spark, m))


@query("pca_reconstruction")
def q_pca_reconstruction(spark, sf_dir):
    _, m = pca_model(spark, sf_dir)
    return RD.pca_reconstruction(spark, m)


@query("pca_power_sums")
def q_pca_power_sums(spark, sf_dir):
    """M6 check: the sums of the eigenvalues' powers are the traces of the covariance's powers."""
    _, m = pca_model(spark, sf_dir)
    eigen = RD.pca_explained(spark, m).select(F.col("explained_variance").alias("v"))
    powers = F.explode(F.array(*(F.struct(F.lit(p).alias("power"), F.pow("v", F.lit(float(p))).alias("x")) for p in (1, 2, 3)))).alias("e")
    return eigen.select(powers).groupBy(F.col("e.power").alias("power")).agg(F.sum("e.x").alias("power_sum"))


@query("pca_covariance_rebuilt")
def q_pca_covariance_rebuilt(spark, sf_dir):
    """M6 / M7 check: the covariance put together again from the eigenvalues and loadings."""
    _, m = pca_model(spark, sf_dir)
    loads = RD.pca_loadings(spark, m).select("component", "feature", "loading")
    eigen = RD.pca_explained(spark, m).select("component", "explained_variance")
    a, b = loads.toDF("component", "feature_i", "x"), loads.toDF("component", "feature_j", "y")
    return (a.join(eigen, "component").join(b, "component").groupBy("feature_i", "feature_j")
            .agg(F.sum(F.col("explained_variance") * F.col("x") * F.col("y")).alias("covariance")))


@query("pca_score_norms")
def q_pca_score_norms(spark, sf_dir):
    """M6 check: the scores on all components keep every recipe's distance to the mean."""
    scaled, m = pca_model(spark, sf_dir)
    scores = RD.pca_scores(scaled, m, k=len(m.features))
    squares = [F.col(c) * F.col(c) for c in scores.columns if c != "RecipeId"]
    return scores.select("RecipeId", sum(squares[1:], squares[0]).alias("squared_distance"))


@query("pca_scores")
def q_pca_scores(spark, sf_dir):
    scaled, m = pca_model(spark, sf_dir)
    return RD.pca_scores(scaled, m)


def content_matrix(spark, sf_dir):
    """The content model with its matrix as a written table."""
    cm = content_model(spark, sf_dir)
    return cm, stage(spark, sf_dir, "content_matrix", lambda: materialize(cm.matrix))


def svd_model(spark, sf_dir):
    def build():
        cm, matrix = content_matrix(spark, sf_dir)
        n_feat = cm.features.count()
        cands = RD.valid_svd_candidates(n_feat)
        model = RD.fit_svd(matrix, cm.n_docs, n_feat, max(cands))
        sel = RD.DEFAULT_SELECTED_SVD_COMPONENTS if RD.DEFAULT_SELECTED_SVD_COMPONENTS in cands else max(cands)
        return cm, matrix, model, cands, sel
    return stage(spark, sf_dir, "svd_model", build)


@query("svd_sweep")
def q_svd_sweep(spark, sf_dir):
    _, _, model, cands, _ = svd_model(spark, sf_dir)
    return RD.svd_sweep(spark, model, cands)


@query("svd_explained")
def q_svd_explained(spark, sf_dir):
    _, _, model, _, sel = svd_model(spark, sf_dir)
    return RD.svd_explained(spark, model, sel)


@query("svd_top_terms")
def q_svd_top_terms(spark, sf_dir):
    cm, _, model, _, sel = svd_model(spark, sf_dir)
    return RD.svd_top_terms(RD.components_long(model, sel), cm.features)


@query("svd_scores")
def q_svd_scores(spark, sf_dir):
    cm, matrix, model, _, sel = svd_model(spark, sf_dir)
    return RD.svd_scores(matrix, resolved(spark, sf_dir).select("RecipeId"), model, sel)


@query("combined_embedding")
def q_combined_embedding(spark, sf_dir):
    """One vector per recipe: content SVD then numeric PCA."""
    cm, matrix, model, _, sel = svd_model(spark, sf_dir)
    scaled, pm = pca_model(spark, sf_dir)
    numeric = RD.pca_scores(scaled, pm)
    cols = [c for c in numeric.columns if c != "RecipeId"]
    return RD.embedded(matrix, scaled.select("RecipeId"), model, sel, numeric, cols)


@query("dimensionality_comparison")
def q_dimensionality_comparison(spark, sf_dir):
    """Shapes, kept variance / energy and reconstruction of every representation."""
    cm, matrix, smodel, cands, sel = svd_model(spark, sf_dir)
    scaled, pm = pca_model(spark, sf_dir)
    n, d, f, k = pm.n, len(pm.features), smodel.n_features, pm.selected_k
    recon = RD.pca_reconstruction(spark, pm).where(F.col("n_components") == k).first()
    sweep = RD.svd_sweep(spark, smodel, [sel]).first()
    rows = [
        ("numeric_scaled", f"({n}, {d})", f"({n}, {d})", d, d, "StandardScaler output", "dense",
         None, None, None, None),
        ("numeric_pca_selected", f"({n}, {d})", f"({n}, {k})", d, k, "PCA", "dense", k,
         float(pm.cumulative[k - 1]), recon["reconstruction_mse"], recon["reconstruction_rmse"]),
        ("content_tfidf", f"({cm.n_docs}, {f})", f"({cm.n_docs}, {f})", f, f, "TF-IDF sparse matrix",
         "sparse", None, None, None, None),
        ("content_svd_selected", f"({cm.n_docs}, {f})", f"({cm.n_docs}, {sel})", f, sel, "TruncatedSVD",
         "dense", sel, sweep["retained_energy"], sweep["reconstruction_mse"], sweep["reconstruction_rmse"]),
        ("combined_recipe_reduced", f"({cm.n_docs}, {sel}) + ({n}, {k})", f"({n}, {sel + k})", f + d, sel + k,
         "Concatenation", "dense", sel + k, None, None, None),
    ]
    return spark.createDataFrame(rows, "representation string, input_shape string, output_shape string, "
                                       "original_dimensions int, reduced_dimensions int, method string, "
                                       "sparse_or_dense string, selected_components int, "
                                       "variance_or_energy_retained double, reconstruction_mse double, "
                                       "reconstruction_rmse double")


def _score_norms(matrix, model, k):
    """Of every component, how far the squares of its scores are from its eigenvalue, and its scores' product with the next."""
    def added(batches):
        import numpy as np
        import pyarrow as pa

        own, following = np.zeros(k), np.zeros(k)
        seen = False
        for b in batches:
            z = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k)
            own += (z * z).sum(axis=0)
            following[:-1] += (z[:, :-1] * z[:, 1:]).sum(axis=0)
            seen = seen or b.num_rows > 0
        if seen:
            yield pa.record_batch([pa.array(np.arange(k, dtype=np.int32)), pa.array(own), pa.array(following)], names=["c", "own", "next"])

    # a row of sums for each task and component
    z = RD.projected(matrix, model.vectors, k).select("z").mapInArrow(added, "c int, own double, next double")
    sums = z.groupBy("c").agg(F.sum("own").alias("own"), F.sum("next").alias("next"))
    of = matrix.sparkSession.createDataFrame([(j, float(v)) for j, v in enumerate(model.singular_values_sq[:k])], "c int, value double")
    top = float(model.singular_values_sq[0])
    return of.join(sums, "c").select((F.col("c") + 1).alias("component"), F.round(F.abs(F.col("own") - F.col("value")) / top, 6).alias("norm_deviation"),
                                     F.round(F.abs("next") / top, 6).alias("next_product"))


@query("svd_score_norms")
def q_svd_score_norms(spark, sf_dir):
    """M12 check: the squares of a component's scores sum to its eigenvalue, and neighbours are orthogonal."""
    _, matrix, model, _, sel = svd_model(spark, sf_dir)
    return _score_norms(matrix, model, sel)


@query("svd_power_sums")
def q_svd_power_sums(spark, sf_dir):
    """M9 check: sums of powers of all eigenvalues, as shares of ``||X||²``, are the traces of the powers of ``XᵀX``."""
    cm, matrix = content_matrix(spark, sf_dir)
    f = cm.features.count()
    whole = RD.fit_svd(matrix, cm.n_docs, f, f)
    shares = whole.singular_values_sq / whole.frob_sq
    return spark.createDataFrame([(p, float((shares ** p).sum())) for p in (1, 2, 3)], "power int, power_sum double")


@query("svd_reconstruction_sample")
def q_svd_reconstruction_sample(spark, sf_dir):
    """Residuals of rows at even distances, for every candidate k."""
    _, matrix, model, cands, _ = svd_model(spark, sf_dir)
    return RD.reconstruction_sample(matrix, resolved(spark, sf_dir).select("RecipeId"), model, cands)


@query("term_feature_association")
def q_term_feature_association(spark, sf_dir):
    """For every numeric feature the terms whose weights go most with it and most against it."""
    cm, matrix = content_matrix(spark, sf_dir)
    scaled, pm = pca_model(spark, sf_dir)
    joined = matrix.join(scaled.withColumnRenamed("RecipeId", "id"), "id")
    sums = joined.groupBy("feature_index").agg(*(F.sum(F.col("value") * F.col(c)).alias(f"s{i}") for i, c in enumerate(pm.features)))
    entries = [F.struct(F.lit(c).alias("component"), F.round(F.col(f"s{i}") / pm.n, 9).alias("loading")) for i, c in enumerate(pm.features)]
    return RD.svd_top_terms(sums.select("feature_index", F.inline(F.array(*entries))), cm.features).drop("abs_loading")


@query("reduce_contract")
def q_reduce_contract(spark, sf_dir):
    """C5 + C6: the checks before the reduction, and those counted while its outputs are written."""
    cm, matrix, model, _, sel = svd_model(spark, sf_dir)
    scaled, pm = pca_model(spark, sf_dir)
    inputs = K.reduction_inputs(scaled, N.feature_names(spark, pm.features), matrix, resolved(spark, sf_dir), cm.features)
    numeric = RD.pca_scores(scaled, pm)
    cols = [c for c in numeric.columns if c != "RecipeId"]
    numeric, seen_pca = K.written_observed(numeric, F.array(*cols), "numeric-pca")
    _, seen_svd = K.written_observed(RD.svd_scores(matrix, scaled.select("RecipeId"), model, sel), F.col("content_svd"), "content-svd")
    _, seen = K.written_observed(RD.embedded(matrix, scaled.select("RecipeId"), model, sel, numeric, cols), F.col("embedding"), "embedding")
    outputs = {"numeric_pca": (seen_pca, pm.selected_k), "content_svd": (seen_svd, sel), "embedding": (seen, sel + pm.selected_k)}
    names = RD.embedding_feature_names(spark, sel, pm.selected_k)
    return inputs.union(K.reduction_outputs(spark, cm.n_docs, outputs, names, pm.selected_k, sel, float(pm.cumulative[pm.selected_k - 1]), RD.PCA_TARGET_VARIANCE))


def document_content(spark, sf_dir):
    def build():
        docs = V.spread(V.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
        return C.text_content(docs, "doc_id", "text")
    return stage(spark, sf_dir, "document_content", build)


@query("document_tfidf")
def q_document_tfidf(spark, sf_dir):
    """M3 / F22 over whole documents: counts beyond one, accents, a vocabulary of the reference's width."""
    _, matrix = document_content(spark, sf_dir)
    return matrix.withColumnRenamed("id", "doc_id")


def document_svd(spark, sf_dir):
    def build():
        features, matrix = document_content(spark, sf_dir)
        f, n = features.count(), V.documents(spark, sf_dir).distinct().count()
        cands = RD.valid_svd_candidates(f)
        return cands, RD.fit_svd(matrix, n, f, max(cands))
    return stage(spark, sf_dir, "document_svd", build)


@query("document_svd_sweep")
def q_document_svd_sweep(spark, sf_dir):
    """M9-M11 over the terms of whole documents, up to k = 300."""
    cands, model = document_svd(spark, sf_dir)
    return RD.svd_sweep(spark, model, cands)


@query("document_svd_score_norms")
def q_document_svd_score_norms(spark, sf_dir):
    """M12 check over the terms of whole documents."""
    cands, model = document_svd(spark, sf_dir)
    return _score_norms(document_content(spark, sf_dir)[1], model, max(cands))


# -- audits (A8, A9, A17-A31, J2-J4, W6, W9, W11, F15, F23) -------------------------

from larder.operators import audits as AU  # noqa: E402

FLAG_COLS = ["servings_from_yield", "cooktime_derived_from_total_prep", "preptime_derived_from_total_cook",
             "totaltime_derived_from_prep_cook", "time_arithmetic_mismatch"]
DESCRIBE_COLS = ["ResolvedServings_imputed", "CookTime_Minutes_imputed", "PrepTime_Minutes_imputed",
                 "TotalTime_Minutes_imputed"]
DESCRIBE_PERCENTILES = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


@query("missingness")
def q_missingness(spark, sf_dir):
    return AU.missingness(V.catalog(spark, sf_dir))


@query("quality_audit")
def q_quality_audit(spark, sf_dir):
    return AU.quality_audit(V.catalog(spark, sf_dir), V.reviews(spark, sf_dir))


@query("orphan_review_ids")
def q_orphan_review_ids(spark, sf_dir):
    return AU.orphan_review_ids(V.catalog(spark, sf_dir), V.reviews(spark, sf_dir))


@query("unreviewed_recipes")
def q_unreviewed_recipes(spark, sf_dir):
    return AU.unreviewed_recipes(V.catalog(spark, sf_dir), V.reviews(spark, sf_dir))


@query("time_order_checks")
def q_time_order_checks(spark, sf_dir):
    return AU.time_order_checks(V.catalog(spark, sf_dir))


@query("numeric_profile")
def q_numeric_profile(spark, sf_dir):
    return AU.numeric_profile(V.catalog(spark, sf_dir))


@query("correlation_matrix")
def q_correlation_matrix(spark, sf_dir):
    return AU.correlation_matrix(V.catalog(spark, sf_dir))


@query("describe_resolved")
def q_describe_resolved(spark, sf_dir):
    return AU.describe(resolved(spark, sf_dir), DESCRIBE_COLS, DESCRIBE_PERCENTILES)


@query("zero_cook_share")
def q_zero_cook_share(spark, sf_dir):
    return AU.zero_cook_share(resolved(spark, sf_dir))


@query("flag_counts")
def q_flag_counts(spark, sf_dir):
    return AU.flag_counts(resolved(spark, sf_dir), FLAG_COLS)


def ingredient_sets(spark, sf_dir):
    return AU.audit_token_sets(V.ingredients(spark, sf_dir), "RecipeId", "ingredient")


def keyword_sets(spark, sf_dir):
    return AU.audit_token_sets(V.keywords(spark, sf_dir), "RecipeId", "keyword")


@query("ingredient_parse_summary")
def q_ingredient_parse_summary(spark, sf_dir):
    return AU.list_parse_summary(V.catalog(spark, sf_dir).select("RecipeId"), ingredient_sets(spark, sf_dir))


@query("keyword_parse_summary")
def q_keyword_parse_summary(spark, sf_dir):
    return AU.list_parse_summary(V.catalog(spark, sf_dir).select("RecipeId"), keyword_sets(spark, sf_dir))


@query("top_ingredients")
def q_top_ingredients(spark, sf_dir):
    return AU.top_tokens(ingredient_sets(spark, sf_dir), 50, "ingredient")


@query("top_keywords")
def q_top_keywords(spark, sf_dir):
    return AU.top_tokens(keyword_sets(spark, sf_dir), 50, "keyword")


@query("ingredient_vocab_sweep")
def q_ingredient_vocab_sweep(spark, sf_dir):
    return AU.vocabulary_sweep(V.catalog(spark, sf_dir).select("RecipeId"), materialize(ingredient_sets(spark, sf_dir), "ingredient-tokens"))


@query("document_vocab_sweep")
def q_document_vocab_sweep(spark, sf_dir):
    """A25 / J4 over every word of every whole document."""
    docs = V.spread(V.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    tokens = materialize(AU.document_token_sets(docs, "doc_id", V.words_of(F.col("text"))), "document-tokens")
    return AU.vocabulary_sweep(V.documents(spark, sf_dir), tokens, id_col="doc_id")


@query("category_coverage")
def q_category_coverage(spark, sf_dir):
    return AU.category_coverage(V.catalog(spark, sf_dir))


@query("top_categories")
def q_top_categories(spark, sf_dir):
    return AU.top_categories(V.catalog(spark, sf_dir), 30)


@query("temporal_summary")
def q_temporal_summary(spark, sf_dir):
    return AU.temporal_summary(V.catalog(spark, sf_dir))


@query("recipes_per_year")
def q_recipes_per_year(spark, sf_dir):
    return AU.recipes_per_year(V.catalog(spark, sf_dir))


@query("interaction_summary")
def q_interaction_summary(spark, sf_dir):
    return AU.interaction_summary(V.catalog(spark, sf_dir), V.reviews(spark, sf_dir))


@query("rating_distribution")
def q_rating_distribution(spark, sf_dir):
    return AU.rating_distribution(V.reviews(spark, sf_dir))


@query("reviews_per_user")
def q_reviews_per_user(spark, sf_dir):
    return AU.activity_summary(V.reviews(spark, sf_dir), "AuthorId")


@query("reviews_per_recipe")
def q_reviews_per_recipe(spark, sf_dir):
    return AU.activity_summary(V.reviews(spark, sf_dir), "RecipeId")


@query("hist_ingredients_per_recipe")
def q_hist_ingredients(spark, sf_dir):
    per = ingredient_sets(spark, sf_dir).groupBy("id").agg(F.count(F.lit(1)).alias("k"))
    counts = (V.catalog(spark, sf_dir).select(F.col("RecipeId").alias("id")).join(per, "id", "left")
              .select(F.coalesce("k", F.lit(0)).alias("k")))
    return AU.equal_width_histogram(counts, "k", 40)


@query("hist_reviews_per_user")
def q_hist_reviews_per_user(spark, sf_dir):
    return AU.equal_width_histogram(AU.per_entity_counts(V.reviews(spark, sf_dir), "AuthorId"), "k", 50)


@query("hist_reviews_per_recipe")
def q_hist_reviews_per_recipe(spark, sf_dir):
    return AU.equal_width_histogram(AU.per_entity_counts(V.reviews(spark, sf_dir), "RecipeId"), "k", 50)


@query("top_total_time")
def q_top_total_time(spark, sf_dir):
    return AU.top_by(resolved(spark, sf_dir), "TotalTime_Minutes_imputed", 20, "RecipeId",
                     ["Name", "TotalTime_Minutes_imputed", "PrepTime_Minutes_imputed", "CookTime_Minutes_imputed"])


@query("seeded_sample")
def q_seeded_sample(spark, sf_dir):
    return AU.seeded_sample(V.catalog(spark, sf_dir), 20, "RecipeId").select("RecipeId", "Name", "RecipeCategory")


# -- ingest (S1, F1-F5, P1) ----------------------------------------------------------

from larder.sources import ingest as IG  # noqa: E402


@query("ingest_catalog")
def q_ingest_catalog(spark, sf_dir):
    """List cells, ISO durations and list sizes from raw text."""
    out = IG.ingest_catalog(IG.raw_catalog(spark, sf_dir))
    return out.select("RecipeId", "CookTime_Minutes", "PrepTime_Minutes", "TotalTime_Minutes",
                      "NumIngredients", "NumQuantities",
                      F.array_join("RecipeIngredientParts", "|").alias("ingredients"),
                      F.array_join("Keywords", "|").alias("keywords"))


@query("list_cell_items")
def q_list_cell_items(spark, sf_dir):
    """Items of list cells by the lenient and by the checked rule."""
    from larder.functions.text import parse_list_checked, parse_list_repr
    cells = V.list_cells(spark, sf_dir).select("PartId", parse_list_repr(F.col("cell")).alias("items"), parse_list_checked(F.col("cell")).alias("checked"))
    return cells.select("PartId", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items"),
                        F.size("checked.items").alias("n_checked"), F.col("checked.ok").alias("parsed_ok"))


@query("list_cell_parse_summary")
def q_list_cell_parse_summary(spark, sf_dir):
    """A23 with the share of cells that are lists."""
    from larder.functions.text import parse_list_checked
    cells = V.list_cells(spark, sf_dir).select("PartId", parse_list_checked(F.col("cell")).alias("checked")).select("PartId", "checked.items", "checked.ok")
    cells = materialize(cells, "list-cells")
    tokens = AU.document_token_sets(cells.where("ok"), "PartId", F.col("items"))
    return AU.list_parse_summary(cells, tokens, "PartId", parsed="ok")


@query("document_list_cells")
def q_document_list_cells(spark, sf_dir):
    """F1 over whole documents: items per text when each is read as a list cell."""
    from larder.functions.text import parse_list
    d = V.spread(V.table(spark, sf_dir, "documents"), "doc_id")
    items = parse_list(F.col("text"))
    return d.select("doc_id", F.size(items).alias("n_items"),
                    F.aggregate(items, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("item_chars"))


# -- legacy one-shot variant (M14, M15) ------------------------------------------------

from larder.operators import legacy as LG  # noqa: E402


def legacy_text(spark, sf_dir):
    def build():
        cat = V.catalog(spark, sf_dir)
        n = cat.count()
        terms = materialize(LG.legacy_terms(V.ingredients(spark, sf_dir), "RecipeId", "ingredient", C.task_partitions(cat, n, C.TASK_ROWS // 4)))
        vocab = materialize(LG.legacy_vocabulary(terms, n))
        return n, terms, vocab
    return stage(spark, sf_dir, "legacy_text", build)


@query("legacy_pca_explained")
def q_legacy_pca_explained(spark, sf_dir):
    """PCA of the 11 raw, median-filled, scaled columns."""
    scaled = LG.legacy_scaled(V.catalog(spark, sf_dir))
    return RD.pca_explained(spark, RD.fit_pca(scaled, LG.LEGACY_NUMERIC_COLS))


@query("legacy_pca_scores")
def q_legacy_pca_scores(spark, sf_dir):
    scaled = LG.legacy_scaled(V.catalog(spark, sf_dir))
    model = RD.fit_pca(scaled, LG.LEGACY_NUMERIC_COLS)
    return RD.pca_scores(scaled, model, k=LG.LEGACY_PCA_SCORES, prefix="pca_")


@query("legacy_text_vocabulary")
def q_legacy_text_vocabulary(spark, sf_dir):
    """min_df 5, top 5,000 terms by corpus count, smooth idf."""
    _, _, vocab = legacy_text(spark, sf_dir)
    return vocab


@query("legacy_text_tfidf")
def q_legacy_text_tfidf(spark, sf_dir):
    _, terms, vocab = legacy_text(spark, sf_dir)
    return LG.legacy_matrix(terms, vocab).withColumnRenamed("id", "RecipeId")


def legacy_svd_model(spark, sf_dir):
    def build():
        n, terms, vocab = legacy_text(spark, sf_dir)
        matrix = materialize(LG.legacy_matrix(terms, vocab))
        return matrix, LG.legacy_svd(matrix, n, vocab.count())
    return stage(spark, sf_dir, "legacy_svd", build)


@query("legacy_text_svd")
def q_legacy_text_svd(spark, sf_dir):
    _, model = legacy_svd_model(spark, sf_dir)
    return RD.svd_explained(spark, model, model.k)


@query("legacy_svd_score_norms")
def q_legacy_svd_score_norms(spark, sf_dir):
    """M15 check: the squares of a component's scores sum to its eigenvalue, and neighbours are orthogonal."""
    matrix, model = legacy_svd_model(spark, sf_dir)
    return _score_norms(matrix, model, model.k)


@query("legacy_pca_power_sums")
def q_legacy_pca_power_sums(spark, sf_dir):
    """M14 check: the sums of the eigenvalues' powers are the traces of the covariance's powers."""
    model = RD.fit_pca(LG.legacy_scaled(V.catalog(spark, sf_dir)), LG.LEGACY_NUMERIC_COLS)
    return spark.createDataFrame([(p, float((model.eigenvalues ** p).sum())) for p in (1, 2, 3)], "power int, power_sum double")


@query("servings_summary_raw")
def q_servings_summary_raw(spark, sf_dir):
    """A11, EDA form (ruling R5): servings count as present when the raw value is non-missing."""
    return S.servings_summary(resolved(spark, sf_dir), present="raw")


# -- cross-output checks (C3, J5, C7) ------------------------------------------------

from larder.operators import contracts as K  # noqa: E402


@query("id_alignment")
def q_id_alignment(spark, sf_dir):
    """The ids of the content input against those of the numeric matrix."""
    res, model = numeric_fit(spark, sf_dir)
    return K.id_alignment(V.catalog(spark, sf_dir), N.scaled_matrix(res, model))


@query("review_id_alignment")
def q_review_id_alignment(spark, sf_dir):
    """J5 on tables that do differ: every review's recipe id against the catalog's."""
    return K.id_alignment(V.reviews(spark, sf_dir), V.catalog(spark, sf_dir))


@query("matrix_warnings")
def q_matrix_warnings(spark, sf_dir):
    """Warnings of the numeric and the content matrix."""
    content = content_model(spark, sf_dir)
    return K.matrix_warnings(q_numeric_preprocessing_summary(spark, sf_dir),
                             C.matrix_summary(spark, content), content.n_docs)


@query("reduction_warnings")
def q_reduction_warnings(spark, sf_dir):
    """Warnings of the reduced outputs."""
    cm, _, model, _, selected = svd_model(spark, sf_dir)
    _, pca = pca_model(spark, sf_dir)
    return K.reduction_warnings(RD.svd_sweep(spark, model, [selected]), cm.n_docs, selected + pca.selected_k)
