"""Content matrix (job 5): token documents -> weighted TF-IDF groups -> long sparse table.

Documents stay in long form ``(id, token)`` from start to end: no document
is ever collected into one row, so a recipe with a huge token list (or a
token present in most documents) is just more rows for the shuffle, with
map-side partial counts.  The matrix is ``(id, feature_index, value)``.

Per group: document frequency per term (one ``groupBy``), the kept
vocabulary (``min_df <= df <= max_df * n``), smooth idf
``ln((1+n)/(1+df)) + 1``, sublinear tf ``1 + ln(tf)``, L2 norm per document
over the kept terms, then the group weight.  Binary groups use value 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import is_time_like, normalize_token, vectorizer_terms

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
GROUP_ORDER = ["ingredients", "keywords", "category", "yield"]
GROUP_WEIGHTS = {"ingredients": 1.0, "keywords": 0.6, "category": 0.4, "yield": 0.2}
FEATURE_PREFIX = {"ingredients": "ingredient__", "keywords": "keyword__", "category": "", "yield": ""}
EXCLUDED_YIELD_TOKENS = ["", "yield__missing", "yield__other"]
YIELD_TOKEN_RE = r"^yield__[a-z0-9_/]+$"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class GroupParams:
    min_df: int
    max_df: float
    tfidf: bool  # False: binary presence, no idf, no norm


DEFAULT_PARAMS = {
    "ingredients": GroupParams(10, 0.80, True),
    "keywords": GroupParams(10, 0.60, True),
    "category": GroupParams(1, 1.0, False),
    "yield": GroupParams(50, 1.0, False),
}


def via_dictionary(long_df: DataFrame, id_col: str, raw_col: str, fn, out: str = "token") -> DataFrame:
    """``(id, out)`` with ``out = fn(raw)`` computed once per distinct raw string.

    Raw strings repeat far more than they vary, so the regex work runs on
    the distinct dictionary (map-side de-duplicated, written once).  The
    written table's measured size decides the join: broadcast under
    ``spark.sql.autoBroadcastJoinThreshold``, a shuffle join (AQE splits hot
    strings) above it.
    """
    from larder.plans.materialize import materialize

    occ = (long_df.select(F.col(id_col).alias("id"), F.col(raw_col).cast("string").alias("__raw"))
           .where(F.col("__raw").isNotNull()))
    # written once: the planner sees its file size and broadcasts it only
    # under spark.sql.autoBroadcastJoinThreshold (else a shuffle join)
    dic = materialize(occ.select("__raw").distinct().select("__raw", fn(F.col("__raw")).alias(out)), "dictionary")
    return occ.join(dic, "__raw", "inner").select("id", out)


def ingredient_tokens(long_df: DataFrame, id_col: str, raw_col: str) -> DataFrame:
    """F14 + F16: non-empty normalized tokens, as often as they occur."""
    return via_dictionary(long_df, id_col, raw_col, normalize_token).where(F.col("token") != "")


def ingredient_documents(long_df: DataFrame, id_col: str, raw_col: str) -> DataFrame:
    """F14 + F16 + F17: distinct non-empty normalized tokens per document."""
    return ingredient_tokens(long_df, id_col, raw_col).distinct()


def keyword_tokens(long_df: DataFrame, id_col: str, raw_col: str) -> DataFrame:
    """keyword tokens without time-like tags, as often as they occur."""
    tok = via_dictionary(long_df, id_col, raw_col, normalize_token)
    return tok.where((F.col("token") != "") & ~is_time_like(F.col("token")))


def keyword_documents(long_df: DataFrame, id_col: str, raw_col: str) -> tuple[DataFrame, DataFrame]:
    """F18 + F19: keyword tokens without time-like tags, and removed-tag counts.

    Removed tags are counted per occurrence, before de-duplication.
    """
    tok = via_dictionary(long_df, id_col, raw_col, normalize_token)
    tok = tok.where(F.col("token") != "")
    time_like = is_time_like(F.col("token"))
    kept = tok.where(~time_like).distinct()
    removed = (tok.where(time_like).groupBy(F.col("token").alias("keyword_token"))
               .agg(F.count(F.lit(1)).alias("removed_count"))
               .orderBy(F.desc("removed_count"), "keyword_token"))
    return kept, removed


def category_documents(df: DataFrame, id_col: str = "RecipeId",
                       category_col: str = "RecipeCategory_clean") -> DataFrame:
    """``category__<token>``; a missing category gives an empty document."""
    if category_col not in df.columns:
        return df.select(F.col(id_col).alias("id"), F.lit("").alias("token")).where(F.lit(False))
    tok = normalize_token(F.col(category_col))
    return (df.where(F.col(category_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.concat(F.lit("category__"), tok).alias("token"))
            .where(tok != ""))


def yield_documents(df: DataFrame, id_col: str = "RecipeId",
                    yield_col: str = "yield_unit_token") -> DataFrame:
    """curated ``yield__`` tokens only; missing / other / malformed dropped."""
    if yield_col not in df.columns:
        return df.select(F.col(id_col).alias("id"), F.lit("").alias("token")).where(F.lit(False))
    tok = F.lower(F.trim(F.col(yield_col)))
    return (df.select(F.col(id_col).alias("id"), tok.alias("token"))
            .where(F.col("token").isNotNull() & ~F.col("token").isin(*EXCLUDED_YIELD_TOKENS)
                   & F.col("token").rlike(YIELD_TOKEN_RE)))


TEXT_PARAMS = GroupParams(10, 0.80, True)
#: Rows of a document table, and whole texts, that one task sorts or counts, about: no task grows with the input.
TASK_ROWS = 500_000
TASK_DOCUMENTS = 2_048


def task_partitions(df: DataFrame, rows: int, each: int | None = None) -> int:
    """The session's number of shuffle partitions, or as many more as ``rows`` ask for."""
    from larder.plans.partitioning import target_partitions

    return max(target_partitions(df), -(-rows // (each or TASK_ROWS)))


def text_content(docs: DataFrame, id_col: str, text_col: str, params: GroupParams = TEXT_PARAMS) -> tuple[DataFrame, DataFrame]:
    """M3 + F22 over whole texts: (features, matrix), both written.

    A document is its text; terms are what the vectorizer finds in it, with their counts, and the
    limits, idf, sublinear counts and norms are those of the other groups.  Repeated ids are one
    document; NULL texts have no terms but count as documents.
    """
    from larder.plans.materialize import materialize
    from larder.plans.partitioning import dense_index

    n_docs = docs.select(id_col).distinct().count()
    # the texts are shuffled and not their words; the counts and the norms then meet where a document is
    parts = task_partitions(docs, n_docs, TASK_DOCUMENTS)
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).repartition(parts, "id")
    terms = materialize(whole.select("id", F.explode(vectorizer_terms(F.col("text"))).alias("term"))
                        .groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")).withColumn("feature_group", F.lit("text")), "text-terms")
    vocab = fit_vocabulary(terms, n_docs, {"text": params})
    features = materialize(dense_index(vocab, ["term"], "feature_index").select(
        F.col("feature_index").cast("int").alias("feature_index"), F.col("term").alias("feature_name"), "feature_group", "term", "df", "idf", F.lit(1.0).alias("group_weight")), "text-features")
    return features, materialize(weighted_matrix(terms, features, {"text": params}, parts), "text-matrix")


def fit_vocabulary(terms: DataFrame, n_docs: int, params: dict[str, GroupParams]) -> DataFrame:
    """M3 fit: ``(feature_group, term, df, idf)`` of the kept terms of every group."""
    dfreq = terms.groupBy("feature_group", "term").agg(F.count(F.lit(1)).alias("df"))
    keep = F.lit(False)
    idf = F.lit(1.0)
    for g, p in params.items():
        in_g = F.col("feature_group") == g
        keep = keep | (in_g & (F.col("df") >= p.min_df) & (F.col("df") <= F.lit(p.max_df * n_docs)))
        if p.tfidf:
            idf = F.when(in_g, F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).otherwise(idf)
    return dfreq.where(keep).withColumn("idf", idf)


def number_features(vocab: DataFrame) -> DataFrame:
    """W3 + P14: dense ``feature_index`` (groups in fixed order, terms sorted) and names.

    Numbered by a distributed sort (no single-task window), so the
    vocabulary may be as large as the data makes it.
    """
    from larder.plans.partitioning import dense_index

    rank = F.create_map(*[x for i, g in enumerate(GROUP_ORDER) for x in (F.lit(g), F.lit(i))])
    prefix = F.create_map(*[x for g in GROUP_ORDER for x in (F.lit(g), F.lit(FEATURE_PREFIX[g]))])
    weight = F.create_map(*[x for g in GROUP_ORDER for x in (F.lit(g), F.lit(GROUP_WEIGHTS[g]))])
    ranked = dense_index(vocab.withColumn("__g", rank[F.col("feature_group")]), ["__g", "term"], "__i")
    return ranked.select(
        F.col("__i").cast("int").alias("feature_index"),
        F.concat(prefix[F.col("feature_group")], F.col("term")).alias("feature_name"),
        "feature_group", "term", "df", "idf",
        weight[F.col("feature_group")].alias("group_weight"))


def weighted_matrix(terms: DataFrame, features: DataFrame, params: dict[str, GroupParams], parts: int | None = None) -> DataFrame:
    """M3 + M5 + J6: ``(id, feature_index, value)`` of all included groups, by id in ``parts`` partitions."""
    joined = terms.join(features.select("feature_group", "term", "feature_index", "idf", "group_weight"),
                        ["feature_group", "term"], "inner")
    # a group's number is shuffled instead of its name
    group = F.lit(len(params)).cast("int")
    for i, g in enumerate(params):
        group = F.when(F.col("feature_group") == g, F.lit(i)).otherwise(group)
    tfidf = F.col("__g").isin(*[i for i, g in enumerate(params) if params[g].tfidf])
    raw = F.when(tfidf, (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf")).otherwise(F.lit(1.0))
    joined = joined.withColumn("__g", group).select("id", "__g", "feature_index", "group_weight", raw.alias("w"))
    joined = joined if parts is None else joined.repartition(parts, "id")
    # L2 norm per (document, group): one exchange on the id; a window partition
    # holds at most one group's vocabulary worth of rows, whatever the skew.
    per_doc = Window.partitionBy("id", "__g")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(per_doc))
    value = F.when(tfidf, F.col("w") / norm).otherwise(F.col("w"))
    return joined.select("id", "feature_index", (value * F.col("group_weight")).alias("value"))


@dataclass
class ContentModel:
    n_docs: int
    features: DataFrame          # feature_index, feature_name, feature_group, term, df, idf, group_weight
    matrix: DataFrame            # id, feature_index, value
    terms: DataFrame             # id, feature_group, term, tf
    present: DataFrame           # the same with a NULL term where a document has tokens but no term
    docs: dict[str, DataFrame]   # group -> (id, token)
    sources: dict[str, str]
    params: dict[str, GroupParams]
    included: list[str]


def build_content(ids: DataFrame, docs: dict[str, DataFrame], sources: dict[str, str],
                  params: dict[str, GroupParams] | None = None, id_col: str = "RecipeId",
                  distinct: tuple[str, ...] = ()) -> ContentModel:
    """M5: documents of every group -> numbered vocabulary and weighted matrix.

    ``ids`` is the document universe (one row per catalog item; empty
    documents count in ``n``).  The groups of ``distinct`` come as token occurrences and are
    made distinct here.  Groups with no term left after pruning are
    skipped (a group with no non-empty document has no term either); all
    groups empty is an error.  Passes: all documents are written once; terms
    come from a distinct-token dictionary over that table; one shuffle by id serves the choice of
    documents, the distinct tokens and the term counts, another the norms.  Both have as many partitions as
    their rows ask for.  The term table (read by the df count, the matrix and the norms) and the small
    vocabulary are written once each.
    """
    from larder.plans.materialize import materialize

    params = dict(params or DEFAULT_PARAMS)
    universe = ids.select(F.col(id_col).alias("id"))
    n_docs = universe.count()
    all_docs = None
    for g in GROUP_ORDER:
        if g in docs:
            d = docs[g].select("id", "token", F.lit(g).alias("feature_group"))
            all_docs = d if all_docs is None else all_docs.unionByName(d)
    all_docs = materialize(all_docs.where(F.col("id").isNotNull()), "docs")
    tokens = token_terms(all_docs)
    parts = task_partitions(all_docs, all_docs.count())
    # from here on rows stay where their id is: neither join nor count shuffles them again
    listed = universe.where(F.col("id").isNotNull()).repartition(parts, "id")
    kept = (all_docs.repartition(parts, "id").join(listed, "id", "left_semi")
            .groupBy("id", "feature_group", "token").agg(F.count(F.lit(1)).alias("n")))
    times = F.when(F.col("feature_group").isin(*distinct), F.lit(1).cast("long")).otherwise(F.col("n"))
    present = materialize(
        kept.join(tokens, "token", "left")
        .select("id", "feature_group", F.explode_outer("terms").alias("term"), times.alias("n"))
        .groupBy("id", "feature_group", "term").agg(F.sum("n").alias("tf")), "terms")
    terms = present.where(F.col("term").isNotNull())
    vocab = fit_vocabulary(terms, n_docs, {g: params[g] for g in docs})
    features = number_features(vocab)  # already a written table (dense_index)
    vsize = {r["feature_group"]: r["n"] for r in
             features.groupBy("feature_group").agg(F.count(F.lit(1)).alias("n")).collect()}
    included = [g for g in GROUP_ORDER if g in docs and vsize.get(g, 0) > 0]
    if not included:
        raise ValueError("every content group is empty: no term passes its document-frequency limits")
    matrix = weighted_matrix(terms.where(F.col("feature_group").isin(*included)), features,
                             {g: params[g] for g in included}, task_partitions(present, present.count()))
    split = {}
    for g in docs:
        of = all_docs.where(F.col("feature_group") == g).select("id", "token").join(universe, "id", "left_semi")
        split[g] = of.distinct() if g in distinct else of
    return ContentModel(n_docs, features, matrix, terms, present, split, dict(sources), params, included)


def token_terms(docs: DataFrame) -> DataFrame:
    """F22 dictionary: ``(token, terms)`` for every distinct token, written (sized for the planner)."""
    from larder.plans.materialize import materialize

    return materialize(docs.select("token").distinct()
                       .select("token", vectorizer_terms(F.col("token")).alias("terms")), "token_terms")


def token_summary(model: ContentModel, group: str) -> DataFrame:
    """Per term of a group: document frequency and total weighted value."""
    f = model.features.where(F.col("feature_group") == group).select("feature_index", "term")
    return (model.matrix.join(f, "feature_index")
            .groupBy(F.col("term").alias("token"))
            .agg(F.sum((F.col("value") > 0).cast("long")).alias("document_frequency"),
                 F.sum("value").alias("total_tfidf_weight"))
            .orderBy(F.desc("document_frequency"), F.desc("total_tfidf_weight"), "token"))


def single_token_counts(docs: DataFrame, token_col: str) -> DataFrame:
    """Documents per token for one-token groups (category, yield)."""
    return (docs.groupBy(F.col("token").alias(token_col))
            .agg(F.count(F.lit(1)).alias("recipe_count"))
            .orderBy(F.desc("recipe_count"), token_col))


def matrix_summary(spark, model: ContentModel) -> DataFrame:
    """One row per group plus the combined matrix row.

    Non-empty documents per group come from one pass over the term table (a document
    without terms has a row there too); nonzeros per group from the entries that the matrix
    gives a value, so that no norm is made for them.
    """
    nonempty = {r["g"]: r["n"] for r in
                model.present.groupBy(F.col("feature_group").alias("g")).agg(F.count_distinct("id").alias("n")).collect()}
    nnz = {r["feature_group"]: r["n"] for r in
           model.terms.where(F.col("feature_group").isin(*model.included))
           .join(model.features.select("feature_group", "term"), ["feature_group", "term"])
           .groupBy("feature_group").agg(F.count(F.lit(1)).alias("n")).collect()}
    vsize = {r["feature_group"]: r["n"] for r in
             model.features.groupBy("feature_group").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = model.n_docs
    rows = []
    for g in GROUP_ORDER:
        if g not in model.docs:
            continue
        inc = g in model.included
        v, z, ne = vsize.get(g, 0), nnz.get(g, 0), nonempty.get(g, 0)
        p = model.params[g]
        rows.append({
            "feature_group": g, "source_column": model.sources.get(g, ""), "included": inc,
            "n_documents": n, "non_empty_documents": ne,
            "non_empty_document_percent": round(ne / n * 100, 4) if n else 0.0,
            "vocab_size": v, "matrix_nonzero_count": z,
            "matrix_density": (z / (n * v)) if (n and v) else 0.0,
            "group_weight": GROUP_WEIGHTS[g], "vectorizer_min_df": float(p.min_df),
            "vectorizer_max_df": float(p.max_df)})
    n_feat = sum(r["vocab_size"] for r in rows if r["included"])
    total_nnz = sum(r["matrix_nonzero_count"] for r in rows if r["included"])
    rows.append({"feature_group": "combined_content_matrix", "source_column": "", "included": True,
                 "n_documents": n, "non_empty_documents": None,
                 "non_empty_document_percent": None, "vocab_size": n_feat,
                 "matrix_nonzero_count": total_nnz,
                 "matrix_density": total_nnz / (n * n_feat) if n and n_feat else 0.0,
                 "group_weight": None, "vectorizer_min_df": None, "vectorizer_max_df": None})
    names = ["feature_group", "source_column", "included", "n_documents", "non_empty_documents",
             "non_empty_document_percent", "vocab_size", "matrix_nonzero_count", "matrix_density",
             "group_weight", "vectorizer_min_df", "vectorizer_max_df"]
    schema = ("feature_group string, source_column string, included boolean, n_documents long, "
              "non_empty_documents long, non_empty_document_percent double, vocab_size long, "
              "matrix_nonzero_count long, matrix_density double, group_weight double, "
              "vectorizer_min_df double, vectorizer_max_df double")
    return spark.createDataFrame([tuple(r[k] for k in names) for r in rows], schema)


def content_contract(model: ContentModel) -> DataFrame:
    """C4: finite values, feature indices contiguous 0..f-1 and all named."""
    f = model.features.agg(F.count(F.lit(1)).alias("n"), F.min("feature_index").alias("lo"),
                           F.max("feature_index").alias("hi"),
                           F.count_distinct("feature_index").alias("d"))
    m = model.matrix.agg(
        F.sum((F.col("value").isNull() | F.isnan("value")
               | (F.abs("value") == math.inf)).cast("long")).alias("nonfinite"),
        F.max("feature_index").alias("mhi"), F.min("feature_index").alias("mlo"))
    fr, mr = f.first(), m.first()
    checks = [
        ("features_contiguous", int(not (fr["lo"] == 0 and fr["hi"] == fr["n"] - 1 and fr["d"] == fr["n"]))),
        ("matrix_values_finite", int(mr["nonfinite"] or 0)),
        ("matrix_indices_named", int(mr["mhi"] is not None and (mr["mhi"] > fr["hi"] or mr["mlo"] < 0))),
    ]
    return model.matrix.sparkSession.createDataFrame(checks, "check string, violations long")
