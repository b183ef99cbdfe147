"""S1 CSV round trip and the end-to-end job runner on the smallest tables."""

import os
import tempfile

from pyspark.sql import functions as F

from larder.operators import numeric as N
from larder.operators import reduce as RD
from larder.plans import models as M
from larder.plans.jobs import run_all
from larder.sources import ingest as IG

SF = "/root/testdata/sf0.001"


def test_raw_csv_round_trip(spark):
    """Raw text written as quoted CSV and read back ingests exactly like the in-memory text."""
    raw = IG.raw_catalog(spark, SF)
    out = tempfile.mkdtemp(prefix="larder-csv-", dir="/tmp")
    path = os.path.join(out, "recipes")
    # a multi-line cell and an NA word survive the CSV reader
    raw = raw.withColumn("Name", F.concat(F.col("Name"), F.lit("\nline two")))
    raw.write.option("header", True).option("escape", '"').option("quote", '"').csv(path)
    back = IG.read_raw_csv(spark, path, raw.schema)
    cols = ["RecipeId", "CookTime_Minutes", "PrepTime_Minutes", "TotalTime_Minutes", "NumIngredients",
            "NumQuantities"]
    a = sorted(tuple(r) for r in IG.ingest_catalog(raw).select(*cols).collect())
    b = sorted(tuple(r) for r in IG.ingest_catalog(back).select(*cols).collect())
    assert a == b
    assert back.where(F.col("Name").contains("\nline two")).count() == raw.count()


def check_reloaded_models(spark, out, meta):
    """The saved parameters give the same matrices and scores, to the last bit."""
    def read(name):
        return spark.read.parquet(os.path.join(out, name))

    scaled, selected = read("numeric/scaled"), meta["selected_svd_components"]
    numeric = N.scaled_matrix(read("resolved"), M.load_numeric(spark, out))
    assert numeric.exceptAll(scaled).isEmpty() and scaled.exceptAll(numeric).isEmpty()
    pca = RD.pca_scores(scaled, M.load_pca(spark, out))
    assert pca.exceptAll(read("reduced/pca_scores")).isEmpty()
    matrix = read("content/matrix").withColumnRenamed("RecipeId", "id")
    svd = RD.svd_scores(matrix, scaled.select("RecipeId"), M.load_svd(spark, out), selected)
    far = svd.join(read("reduced/svd_scores").withColumnRenamed("content_svd", "was"), "RecipeId").where(
        F.exists(F.zip_with("content_svd", "was", lambda a, b: F.abs(a - b)), lambda d: d > 1e-12))
    assert far.isEmpty() and svd.count() == meta["n_items"]
    assert read("content/id_alignment").where("violations <> 0").isEmpty()
    assert read("numeric/contract").where("violations <> 0").isEmpty()


def test_run_all_jobs(spark):
    out = tempfile.mkdtemp(prefix="larder-jobs-", dir="/tmp")
    meta = run_all(spark, SF, out)
    assert meta["selected_pca_components"] >= 1
    assert meta["achieved_cumulative_variance"] >= 0.9
    emb = spark.read.parquet(os.path.join(out, "reduced/embedding"))
    width = meta["selected_svd_components"] + meta["selected_pca_components"]
    assert emb.count() == meta["n_items"]
    assert emb.where(F.size("embedding") != width).count() == 0
    check_reloaded_models(spark, out, meta)
    resolved = spark.read.parquet(os.path.join(out, "resolved"))
    assert resolved.where(F.col("ResolvedServings_imputed").isNull()).count() == 0
