"""Content matrix: occurrences made distinct on the way, odd ids, and tasks that do not grow with the input."""

import numpy as np

from larder.functions.moments import co_moments
from larder.operators import content as C

PARAMS = {g: C.GroupParams(1, 1.0, g in ("ingredients", "keywords")) for g in C.GROUP_ORDER}


def model(spark, distinct):
    ids = spark.createDataFrame([(i,) for i in [*range(40), 3, None]], "RecipeId long")
    words = ["red bean", "rice", "/", "red oil"]
    rows = [(i % 45, words[(i * i) % 4]) for i in range(200)] + [(None, "rice"), (2, "rice")]
    docs = {"ingredients": spark.createDataFrame(rows, "id long, token string"),
            "category": spark.createDataFrame([(3, "category__a"), (3, "category__a"), (99, "category__b")], "id long, token string")}
    if not distinct:
        docs["ingredients"] = docs["ingredients"].distinct()
    return C.build_content(ids, docs, {}, PARAMS, distinct=distinct)


def test_occurrences_made_distinct_give_the_same_matrix(spark):
    a, b = model(spark, ("ingredients",)), model(spark, ())
    assert a.n_docs == b.n_docs == 42
    for one, other in ((a.matrix, b.matrix), (a.terms, b.terms), (a.docs["ingredients"], b.docs["ingredients"]),
                       (C.matrix_summary(spark, a), C.matrix_summary(spark, b))):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert [r["tf"] for r in a.terms.where("feature_group = 'category'").collect()] == [2]
    summary = {r["feature_group"]: r for r in C.matrix_summary(spark, a).collect()}
    total = sum(summary[g]["matrix_nonzero_count"] for g in ("ingredients", "category"))
    assert summary["combined_content_matrix"]["matrix_nonzero_count"] == total == a.matrix.count()
    # a document whose only token has no term is not empty
    assert summary["ingredients"]["non_empty_documents"] == a.docs["ingredients"].select("id").distinct().count()


def test_partitions_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "TASK_ROWS", 10)
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = model(spark, ("ingredients",))
    assert m.matrix.rdd.getNumPartitions() > few
    assert C.task_partitions(m.matrix, 10 * few + 1) == few + 1


def test_moments_of_columns_with_gaps(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4)) * [1.0, 1e-3, 50.0, 1.0] + [0.0, 1e3, -3.0, 0.0]
    x[rng.random((500, 4)) < 0.2] = np.nan
    x[:, 3] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    m = co_moments(df, df.columns)
    want = df.selectExpr("avg(a)", "stddev_pop(b)", "covar_samp(a, b)", "covar_samp(b, c)", "min(c)", "max(c)", "covar_samp(a, d)", "avg(d)").first()
    got = [m.mean_of(0), m.stddev_pop(1), m.covar_samp(0, 1), m.covar_samp(1, 2), *m.extremes(2)]
    np.testing.assert_allclose(got, want[:6], rtol=1e-7)
    assert m.covar_samp(0, 3) is want[6] is None and m.mean_of(3) is want[7] is None and m.extremes(3) == (None, None)
    empty = co_moments(df.where("false"), df.columns)
    assert empty.mean_of(0) is None and empty.covar_samp(0, 1) is None


def test_clipped_values_of_odd_numbers(spark):
    """Missing, NaN, infinite and invalid values take the median, itself clipped; others the cap at most."""
    from larder.operators import numeric as N

    odd = [None, float("nan"), float("inf"), float("-inf"), -1.0, -0.0, 0.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([(i, x, x) for i, x in enumerate(odd)], "RecipeId long, Calories double, ResolvedServings_imputed double")
    m = N.NumericModel(["Calories", "ResolvedServings_imputed"])
    for cap in (4.0, 7.0, None):
        m.medians, m.caps = {f: 6.0 for f in m.features}, {f: cap for f in m.features}
        got = {r["RecipeId"]: r for r in N.log_matrix(df, m).collect()}
        for i, x in enumerate(odd):
            for f, bad in (("Calories", lambda v: v < 0), ("ResolvedServings_imputed", lambda v: v <= 0)):
                v = 6.0 if x is None or not np.isfinite(x) or bad(x) else x
                np.testing.assert_allclose(got[i][f], np.log1p(v if cap is None else min(v, cap)), rtol=1e-14, atol=0)


def test_task_code_needs_no_library(spark):
    """Functions of tasks are pickled by value, as executors may not have the library."""
    from pyspark import cloudpickle
    from larder.functions import moments

    assert b"apart" in cloudpickle.dumps(moments._merged)
