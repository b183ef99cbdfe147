"""The SVD's kernels, its two sides and what its stages leave on disk."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import reduce as RD
from larder.operators import tall
from larder.plans import queries as Q
from larder.plans.materialize import materialize


def _long(spark, dense):
    rows = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    return spark.createDataFrame(rows, "id long, feature_index int, value double")


def _vectors(model, f):
    rows = {r["feature_index"]: r["vector"] for r in model.vectors.collect()}
    assert sorted(rows) == list(range(f))
    return np.array([rows[i] for i in range(f)])


@pytest.mark.parametrize("share", [0.03, 0.5])
def test_products_of_sparse_and_dense_rows(share):
    rng = np.random.default_rng(2)
    dense = np.where(rng.random((70, 400)) < share, rng.random((70, 400)), 0.0)
    dense[:, 0] = 1.0
    q = rng.standard_normal((400, 9))
    i, j = np.nonzero(dense)
    args = j.astype(np.int32), dense[i, j], np.bincount(i).astype(np.int32)
    np.testing.assert_allclose(tall.row_sums(q, *args), dense @ q, atol=1e-12)
    acc = np.ones((400, 9))
    tall._add_product(acc, q, *args)
    np.testing.assert_allclose(acc, 1.0 + dense.T @ (dense @ q), atol=1e-11)


@pytest.mark.parametrize("rows,features,side", [(90, 400, 90), (400, 300, 300)])
def test_the_basis_is_that_of_the_shorter_side(spark, monkeypatch, rows, features, side):
    """Fewer rows than features: vectors are made from those of the rows, features without an entry have zeros."""
    widths, multiplied = [], tall._multiplied
    monkeypatch.setattr(tall, "_multiplied", lambda state, *rest: widths.append(state.n) or multiplied(state, *rest))
    monkeypatch.setattr(tall, "BLOCK", 16)
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((rows, features)) < 0.1, rng.random((rows, features)), 0.0)
    dense[:, 7] = 0.0
    model = RD.fit_svd(_long(spark, dense), rows, features, 12)
    s = np.linalg.svd(dense, compute_uv=False)
    assert set(widths) == {side}
    np.testing.assert_allclose(model.singular_values_sq, s[:12] ** 2, rtol=1e-9)
    v = _vectors(model, features)
    np.testing.assert_allclose(v.T @ v, np.eye(12), atol=1e-10)
    assert np.linalg.norm(dense.T @ (dense @ v) - v * model.singular_values_sq, axis=0).max() <= 1e-7 * s[0] ** 2
    assert all(c[np.argmax(np.abs(c))] > 0 for c in v.T) and np.abs(v[7]).max() < 1e-7


def test_few_rows_of_low_rank_fall_back_to_the_features(spark, monkeypatch):
    monkeypatch.setattr(tall, "BLOCK", 8)
    rng = np.random.default_rng(6)
    dense = np.round(rng.random((40, 4)) @ rng.random((4, 60)), 6)
    model = RD.fit_svd(_long(spark, dense), 40, 60, 10)
    s = np.linalg.svd(dense, compute_uv=False) ** 2
    np.testing.assert_allclose(model.singular_values_sq, s[:10], atol=1e-8 * s[0])
    v = _vectors(model, 60)
    np.testing.assert_allclose(v.T @ v, np.eye(10), atol=1e-9)


def test_scores_in_blocks_are_exchanged_no_more(spark):
    """Whole rows in every share: with V in parts the matrix is neither copied nor are pieces of scores shuffled."""
    rng = np.random.default_rng(8)
    dense = np.where(rng.random((50, 30)) < 0.3, rng.random((50, 30)), 0.0)
    v = rng.standard_normal((30, 7))
    vectors = spark.createDataFrame([(j, v[j].tolist()) for j in range(30)], "feature_index int, vector array<double>")
    z = tall.row_products(_long(spark, dense), vectors, 7, columns=2)
    plan = z._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan
    for r in z.collect():
        np.testing.assert_allclose(r["z"], dense[r["id"]] @ v, atol=1e-12)


def test_score_norms_are_added_up_before_they_are_rows(spark):
    """A row for each task and component, not one for every score."""
    rng = np.random.default_rng(9)
    dense = np.where(rng.random((200, 40)) < 0.3, rng.random((200, 40)), 0.0)
    matrix = _long(spark, dense)
    model = RD.fit_svd(matrix, 200, 40, 6)
    norms = Q._score_norms(matrix, model, 6)
    assert "posexplode" not in norms._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, norms.collect())) == [(c, 0.0, 0.0) for c in range(1, 7)]
    model.singular_values_sq = model.singular_values_sq * 1.5
    assert norms.count() == 6 and all(r["norm_deviation"] > 0 for r in Q._score_norms(matrix, model, 6).collect())


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().endswith(".data") for i in range(files.size()))


def test_a_written_stage_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    table = materialize(spark.range(10_000).repartition(7, F.col("id") % 50))
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before and table.count() == 10_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
