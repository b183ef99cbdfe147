"""PCA / SVD cross-checked against numpy on small frames (eigen outputs have no SQL twin)."""

import numpy as np
import pytest

from larder.operators import reduce as RD
from larder.operators import tall


@pytest.fixture(scope="module")
def sparse_case(spark):
    rng = np.random.default_rng(7)
    n, f = 300, 24
    dense = np.where(rng.random((n, f)) < 0.2, rng.random((n, f)), 0.0)
    dense[5] = 0.0  # an all-zero row
    rows = [(i, j, float(dense[i, j])) for i in range(n) for j in range(f) if dense[i, j] != 0]
    matrix = spark.createDataFrame(rows, "id long, feature_index int, value double")
    ids = spark.createDataFrame([(i,) for i in range(n)], "RecipeId long")
    return dense, matrix, ids


def vectors_of(model, f):
    rows = {r["feature_index"]: r["vector"] for r in model.vectors.collect()}
    assert sorted(rows) == list(range(f))
    return np.array([rows[i] for i in range(f)])


def test_svd_matches_numpy(sparse_case):
    dense, matrix, ids = sparse_case
    n, f = dense.shape
    k = 6
    model = RD.fit_svd(matrix, n, f, k)
    s = np.linalg.svd(dense, compute_uv=False)
    np.testing.assert_allclose(model.singular_values_sq, s[:k] ** 2, rtol=1e-9)
    v = vectors_of(model, f)
    np.testing.assert_allclose(v.T @ v, np.eye(k), atol=1e-10)
    assert all(c[np.argmax(np.abs(c))] > 0 for c in v.T)
    # retained energy as var(Z)/sum var(X), population
    _, _, vt = np.linalg.svd(dense, full_matrices=False)
    z = dense @ vt[:k].T
    expected = z.var(axis=0).sum() / dense.var(axis=0).sum()
    assert abs(model.explained_variance_ratio(k).sum() - expected) < 1e-9
    # exact reconstruction error over all rows
    sweep = RD.svd_sweep(matrix.sparkSession, model, [k]).first()
    recon = dense @ vt[:k].T @ vt[:k]
    assert abs(sweep["reconstruction_mse"] - np.mean((dense - recon) ** 2)) < 1e-12
    # scores equal X V (up to the sign rule), all-zero rows give zeros
    scores = {r["RecipeId"]: r["content_svd"] for r in RD.svd_scores(matrix, ids, model, k).collect()}
    got = np.array([scores[i] for i in range(n)])
    np.testing.assert_allclose(np.abs(got), np.abs(z), atol=1e-9)
    assert np.all(got[5] == 0.0)


def test_scores_in_blocks_of_components(sparse_case):
    dense, matrix, _ = sparse_case
    model = RD.fit_svd(matrix, *dense.shape, 7)
    z = {r["id"]: r["z"] for r in RD.projected(matrix, model.vectors, 7, columns=3).collect()}
    want = dense @ vectors_of(model, dense.shape[1])
    for i, row in z.items():
        np.testing.assert_allclose(row, want[i], atol=1e-12)
    assert len(z) == int((dense != 0).any(axis=1).sum())


def test_sampled_reconstruction(sparse_case):
    """All rows sampled: the closed form; fewer: the residuals of the rows at even distances."""
    dense, matrix, ids = sparse_case
    n, f = dense.shape
    model = RD.fit_svd(matrix, n, f, 6)
    closed = {r["n_components"]: r["reconstruction_mse"] for r in RD.svd_sweep(matrix.sparkSession, model, [2, 6]).collect()}
    got = {r["n_components"]: r for r in RD.reconstruction_sample(matrix, ids, model, [2, 6]).collect()}
    assert all(abs(got[k]["reconstruction_mse_sample"] - closed[k]) < 1e-12 and got[k]["sample_rows"] == n for k in (2, 6))
    few = RD.reconstruction_sample(matrix, ids, model, [6], max_rows=70).first()
    rows = [i for i in range(n) if (i + 1) * 70 // n > i * 70 // n]
    v = vectors_of(model, f)
    assert len(rows) == few["sample_rows"] == 70
    assert abs(few["reconstruction_mse_sample"] - np.mean((dense[rows] - dense[rows] @ v @ v.T) ** 2)) < 1e-12


def test_many_row_blocks_and_shares(spark, monkeypatch):
    """Small row blocks, fan-in, shares and column chunks: a tree of several levels, restarts, several chunks."""
    for name, value in {"ROWS": 64, "FAN_IN": 3, "BLOCK_NONZEROS": 500, "CHUNK_BYTES": 8 * 400 * 9, "MAX_BLOCKS": 3}.items():
        monkeypatch.setattr(tall, name, value)
    rng = np.random.default_rng(4)
    n, f, k = 300, 400, 8
    dense = np.where(rng.random((n, f)) < 0.05, rng.random((n, f)), 0.0) * (1.0 / np.arange(1, f + 1) ** 0.6)
    rows = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    model = RD.fit_svd(spark.createDataFrame(rows, "id long, feature_index int, value double"), n, f, k)
    s = np.linalg.svd(dense, compute_uv=False)
    np.testing.assert_allclose(np.sqrt(model.singular_values_sq), s[:k], rtol=1e-6)
    v = vectors_of(model, f)
    np.testing.assert_allclose(v.T @ v, np.eye(k), atol=1e-9)
    gram = dense.T @ (dense @ v)
    assert np.linalg.norm(gram - v * model.singular_values_sq, axis=0).max() <= 1e-7 * s[0] ** 2


def test_low_rank_and_all_components(spark):
    """Fewer nonzero singular values than wanted ones, and as many components as features."""
    rng = np.random.default_rng(1)
    dense = np.round(rng.random((60, 3)) @ rng.random((3, 9)), 6)
    dense = dense @ np.diag([1.0] * 8 + [0.0])
    for k in (5, 9):
        rows = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
        model = RD.fit_svd(spark.createDataFrame(rows, "id long, feature_index int, value double"), 60, 9, k)
        s = np.linalg.svd(dense, compute_uv=False) ** 2
        np.testing.assert_allclose(model.singular_values_sq, s[:k], atol=1e-8 * s[0])


def test_two_sided_top(spark):
    rng = np.random.default_rng(3)
    rows = [(c, f, float(rng.integers(-4, 5)) if f != 7 else None) for c in range(5) for f in range(200)]
    rng.shuffle(rows)
    rows = [(int(c), int(f), None if x is None else float(x)) for c, f, x in rows]
    got = {(r.component, r.side, r["rank"]): (r.feature_index, r.loading) for r in RD.two_sided_top(
        spark.createDataFrame(rows, "component int, feature_index int, loading double").repartition(7), 6).collect()}
    want = {}
    for c in range(5):
        mine = [(f, x) for d, f, x in rows if d == c and x is not None]
        for side, sign in (("positive", -1), ("negative", 1)):
            for rank, fx in enumerate(sorted(mine, key=lambda e: (sign * e[1], e[0]))[:6], 1):
                want[c, side, rank] = fx
    assert got == want


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    feats = [f"f{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                               "RecipeId long, " + ", ".join(f"{c} double" for c in feats))
    model = RD.fit_pca(df, feats, target=0.9)
    vals = np.sort(np.linalg.eigvalsh(np.cov(x, rowvar=False)))[::-1]
    np.testing.assert_allclose(model.eigenvalues, vals, rtol=1e-9)
    assert abs(model.cumulative[-1] - 1.0) < 1e-12
    assert model.cumulative[model.selected_k - 1] >= 0.9
    assert model.selected_k == 1 or model.cumulative[model.selected_k - 2] < 0.9
    # reconstruction error falls as k grows, and is 0 at k = d
    recon = [r["reconstruction_mse"] for r in RD.pca_reconstruction(spark, model).orderBy("n_components").collect()]
    assert all(a >= b for a, b in zip(recon, recon[1:])) and recon[-1] < 1e-12
    # closed form equals a direct reconstruction at k = 2
    xc = x - x.mean(axis=0)
    v = model.components[:2]
    direct = np.mean((xc - xc @ v.T @ v) ** 2)
    assert abs(recon[1] - direct) < 1e-9
    # the sign rule: largest |loading| is positive
    for comp in model.components:
        assert comp[np.argmax(np.abs(comp))] > 0


def test_scores_shuffle_the_matrix_and_not_the_scores(spark):
    """Repeated, missing and null ids come as of a left join, and carried rows as of an inner one; one wide exchange only."""
    matrix = spark.createDataFrame([(1, 0, 2.0), (1, 2, 1.0), (2, 1, 3.0), (7, 0, 1.0), (None, 0, 5.0)], "id long, feature_index int, value double")
    vectors = spark.createDataFrame([(j, [1.0 * j, 1.0, -j / 2]) for j in range(3)], "feature_index int, vector array<double>")
    ids = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "RecipeId long")
    model = RD.SVDModel(5, 3, np.ones(3), vectors, np.zeros(3), 1.0, 1.0)
    plain = {1: [2.0, 3.0, -1.0], 2: [3.0, 3.0, -1.5], 3: [0.0] * 3, None: [0.0] * 3}
    for columns in (None, 2):
        z = tall.row_products(matrix, vectors, 3, columns, ids.withColumnRenamed("RecipeId", "id")).collect()
        assert sorted(((r["id"] or 0, r["z"]) for r in z)) == sorted((i or 0, plain[i]) for i in (1, 1, 2, 3, None))
    numeric = spark.createDataFrame([(1, 0.5), (1, 0.25), (3, 4.0), (9, 1.0), (None, 1.0)], "RecipeId long, p double")
    got = RD.embedded(matrix, ids, model, 3, numeric, ["p"])
    want = RD.combined_embedding(RD.svd_scores(matrix, ids, model, 3), numeric, ["p"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 5
    # the scores themselves are never exchanged
    plan = RD.svd_scores(matrix, ids, model, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("ReusedExchange") == 1 and "Join" not in plan


def test_narrow_blocks_take_fewer_columns_on_a_flat_spectrum(spark, monkeypatch):
    """Many wanted components of a slowly falling spectrum: the columns multiplied by XᵀX stay few."""
    monkeypatch.setattr(tall, "BLOCK", 8, raising=False)
    monkeypatch.setattr(tall, "MAX_BLOCKS", 3)
    taken, multiplied = [], tall._multiplied
    monkeypatch.setattr(tall, "_multiplied", lambda state, step, blocks, q, *rest: taken.append(q) or multiplied(state, step, blocks, q, *rest))
    rng = np.random.default_rng(11)
    f, k = 300, 40
    u, v = (np.linalg.qr(rng.standard_normal((f, f)))[0] for _ in range(2))
    dense = u * (1.0 + 2.0 * np.exp(-np.arange(f) / 60.0)) @ v
    rows = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    model = RD.fit_svd(spark.createDataFrame(rows, "id long, feature_index int, value double"), f, f, k)
    s = np.linalg.svd(dense, compute_uv=False)
    np.testing.assert_allclose(model.singular_values_sq, s[:k] ** 2, rtol=1e-8)
    assert sum(taken) < 600


@pytest.mark.parametrize("levels", [(3.0, 2.0, 1.0), (2.0, 2.0, 2.0), (3.0, 1.0, 0.0)])
def test_eigenvalues_more_often_than_a_block_is_wide(spark, monkeypatch, levels):
    """Every copy of a repeated eigenvalue is found, though a block shows only as many as it is wide."""
    monkeypatch.setattr(tall, "BLOCK", 6, raising=False)
    values = np.repeat(levels, 20)
    rows = [(i, i, float(x)) for i, x in enumerate(values)]
    model = RD.fit_svd(spark.createDataFrame(rows, "id long, feature_index int, value double"), 60, 60, 30)
    np.testing.assert_allclose(model.singular_values_sq, np.sort(values ** 2)[::-1][:30], atol=1e-7)
    v = vectors_of(model, 60)
    np.testing.assert_allclose(v.T @ v, np.eye(30), atol=1e-9)
