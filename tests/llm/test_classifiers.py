"""Held-out accuracy on the driver tables, and degenerate inputs."""

import zlib

import numpy as np
import pytest

from larder.llm import boosting, quality, toxicity

SF = "/root/testdata/sf0.01"


def auc(score, label):
    rank = score.rank()
    n1, n0 = (label == 1).sum(), (label == 0).sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize(("run", "column", "folds", "fold"), [(toxicity.toxicity, "toxic", 4, 2), (quality.quality, "quality", 5, 0)])
def test_held_out(spark, run, column, folds, fold):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = run(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % folds == fold for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    seen = got.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert auc(seen.score, seen[column]) > 0.95
    assert (seen.predicted == seen[column]).mean() > 0.9


@pytest.mark.parametrize(("run", "column"), [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_odd_tables(spark, edge_docs, no_docs, run, column):
    kind = "doc_id long, quality int, toxic int, text string"
    labels = spark.createDataFrame([(900, 1, 0, ""), (None, 1, 1, ""), (893, None, None, ""), (865, 0, 1, ""), (865, 0, 1, ""), (816, 1, 0, ""), (809, 0, 1, "")], kind)
    none = spark.createDataFrame([], kind)
    for known in (labels, none, labels.where(f"{column} = 1")):
        rows = run(edge_docs, known).collect()
        assert len(rows) == edge_docs.count()
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in rows)
    assert run(no_docs, labels).count() == 0


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit_trees(x[:2000], y[:2000])
    margins = model.margins(x[2000:])
    assert ((margins > 0) == y[2000:]).mean() > 0.95
    curve = boosting.fit_isotonic(margins, y[2000:])
    p = curve(np.sort(margins))
    assert (np.diff(p) >= 0).all() and abs(curve(margins).mean() - y[2000:].mean()) < 0.02


def test_ranking_prefers_the_better():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((800, quality.N_FEATURES))
    y = (x[:, 3] + 0.3 * rng.standard_normal(800) > -0.8).astype(float)
    model = quality.fit_ranking(x, y)
    raw = model.raw(x)
    assert raw[y == 1].mean() > raw[y == 0].mean() + 1
    assert abs((raw < model.cut).mean() - (y == 0).mean()) < 0.02


def test_stages_keep_columns(spark, edge_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").limit(0)
    kept = toxicity.drop_toxic(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_features_of_a_long_unbroken_text_take_linear_time():
    weights = toxicity._Weights({})
    for text in ("a" * 1_000_000, "A" * 1_000_000 + "b", "a1" * 300_000, "1" * 1_000_000 + "a"):
        assert len(toxicity.features(text, weights)) == toxicity.N_FEATURES
        assert len(quality.features(text)) == quality.N_FEATURES


def test_quality_learns_from_every_labelled_document(spark):
    """Edges, pairs and threshold of all rows, as of the arrays; more rows than a bounded sample would hold are all in a pair."""
    docs = spark.range(0, 400).selectExpr("id as doc_id", "concat(repeat('word ', cast(1 + id % 37 as int)), if(id % 3 = 0, 'AB! #### ', 'plain text. '), cast(id as string)) as text")
    labels = spark.range(0, 400).selectExpr("id as doc_id", "cast(id % 3 > 0 as int) as quality")
    model = quality.fit_quality(docs, labels, min_pairs=2000)
    kept = [r for r in docs.join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    kept.sort(key=lambda r: str(r.doc_id))
    x, y = np.array([quality.features(r.text) for r in kept]), np.array([r.quality for r in kept], dtype=float)
    want = quality.fit_ranking(x, y, min_pairs=2000)
    assert all(np.allclose(a, b) for a, b in zip(model.edges, want.edges, strict=True))
    np.testing.assert_allclose(model.weights, want.weights, atol=1e-3)
    assert abs(model.cut - want.cut) < 1e-3
    for good, bad in ((5, 3), (3, 5), (4, 4), (1, 7)):
        train = spark.createDataFrame([(f"{k:03d}", int(k < good), [float(k)]) for k in range(good + bad)], "id string, label int, x array<double>")
        rows = [(int(r.good[0]), int(r.bad[0]) - good) for r in quality.preference_pairs(train, good, bad, 17).collect()]
        rounds, n = quality.paired(good, bad, 17)
        assert sorted(rows) == sorted((t % good, (t + t // n) % bad) for t in range(rounds * n))
        assert {g for g, _ in rows} == set(range(good)) and {b for _, b in rows} == set(range(bad))


def test_quality_shuffles_no_text(spark, monkeypatch):
    """Features come from one pass over the documents; texts are sorted only for ids that repeat with different ones."""
    asked, rows_of = [], quality.training_rows
    monkeypatch.setattr(quality, "training_rows", lambda docs, *a: asked.append(sorted(r.doc_id for r in docs.collect())) or rows_of(docs, *a))
    rows = [(k, f"text of {k} " + "word " * (k % 7)) for k in range(40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    kind = "doc_id long, text string"
    docs = spark.createDataFrame([*rows, rows[3], rows[3]], kind)
    train = {r.id: r.x for r in quality.training_features(docs, quality.document_features(docs), labels, 5, 0).collect()}
    assert not asked and len(train) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(40))
    other = next(k for k in range(40) if zlib.crc32(str(k).encode()) % 5)
    docs = spark.createDataFrame([*rows, (other, "a smaller text"), (other, None)], kind)
    got = {r.id: r.x for r in quality.training_features(docs, quality.document_features(docs), labels, 5, 0).collect()}
    assert asked == [[other] * 3] and got == {**train, str(other): quality.features("")}
    scored = quality.quality(docs, labels)
    assert scored.count() == 42 and "text" not in scored._jdf.queryExecution().analyzed().toString()
