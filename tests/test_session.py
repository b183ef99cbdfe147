"""Stage folders and samples."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from larder.operators.audits import seeded_sample
from larder.session import checkpoint_dir


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_the_shared_folder(master):
    none = SimpleNamespace(get=lambda *a: None)
    session = SimpleNamespace(conf=none, sparkContext=SimpleNamespace(master=master, getConf=lambda: none))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


def test_sample_has_no_residue_pattern(spark):
    ids = spark.range(0, 100_000_000, 50).withColumnRenamed("id", "RecipeId")
    sample = [r.RecipeId for r in seeded_sample(ids, 200, "RecipeId").collect()]
    assert len({x % 1_000_003 for x in sample}) > 190
    assert 30e6 < sum(sample) / len(sample) < 70e6
    assert sample == [r.RecipeId for r in seeded_sample(ids.orderBy(F.desc("RecipeId")), 200, "RecipeId").collect()]
