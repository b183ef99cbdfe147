"""Exact distributed quantiles against numpy (linear interpolation)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions import quantiles as Q


@pytest.mark.parametrize("buckets,final_rows", [(4096, 50_000), (8, 16)])
def test_exact_quantiles_match_numpy(spark, monkeypatch, buckets, final_rows):
    monkeypatch.setattr(Q, "BUCKETS", buckets)
    monkeypatch.setattr(Q, "FINAL_ROWS", final_rows)
    rng = np.random.default_rng(11)
    n = 5000
    heavy = rng.pareto(1.2, n) * 100          # heavy tail
    ints = rng.integers(0, 7, n).astype(float)  # many ties
    const = np.full(n, 3.5)
    rows = [(float(a), float(b), float(c), None if i % 5 == 0 else float(a)) for i, (a, b, c) in
            enumerate(zip(heavy, ints, const))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.95, 0.995, 1.0]
    got = Q.exact_quantiles(df, {k: F.col(k) for k in "abcd"}, probs)
    d = np.array([r[3] for r in rows if r[3] is not None])
    for name, arr in (("a", heavy), ("b", ints), ("c", const), ("d", d)):
        np.testing.assert_allclose(got[name], np.quantile(arr, probs), rtol=1e-12, atol=1e-12)


def test_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert Q.exact_quantiles(df, {"a": F.col("a")}, [0.5]) == {"a": [None]}


def test_medians_of_hot_groups_and_infinities(spark):
    """A hot group over many partitions; infinities, NaN, denormals and NULLs; no value at all."""
    from larder.operators.resolve import global_medians, grouped_medians, medians
    rng = np.random.default_rng(5)
    cats = np.where(rng.random(3000) < 0.6, "hot", rng.choice(["a", "b", "c"], 3000))
    vals = rng.normal(50, 20, 3000)
    rows = [(str(c), float(v) if i % 7 else None) for i, (c, v) in enumerate(zip(cats, vals))]
    odd = [("odd", x) for x in (math.inf, -math.inf, math.nan, None, 5e-324, -0.0, 0.0, 1e308, -1e308)]
    odd += [("none", None), ("none", math.inf), (None, 1.0), (None, math.inf)]
    df = spark.createDataFrame(rows + odd, "g string, v double").repartition(5)
    found = medians(df, "g", ["v"])
    got = {r["g"]: r["m"] for r in grouped_medians(found, "g", ["v"], {"v": "m"}).collect()}
    for g in ("hot", "a", "b", "c"):
        expected = np.median([v for c, v in rows if c == g and v is not None])
        assert abs(got[g] - expected) < 1e-9, g
    assert got["odd"] == 0.0 and None not in got and "none" not in got
    every = [v for _, v in rows + odd if v is not None and math.isfinite(v)]
    assert global_medians(found, ["v"])["v"] == pytest.approx(np.median(every), abs=1e-12)
    with pytest.raises(ValueError, match="no value"):
        global_medians(medians(df.where("g = 'none'"), "g", ["v"]), ["v"])
