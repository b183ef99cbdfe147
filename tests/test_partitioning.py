"""Distributed dense numbering against a local sort."""

import random

from larder.plans.partitioning import dense_index


def test_dense_index_matches_sorted_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abcd"), f"t{rng.randrange(10 ** 6):06d}") for _ in range(3000)]
    rows = list(dict.fromkeys(rows))  # distinct (group, term)
    df = spark.createDataFrame(rows, "g string, term string").repartition(7)
    got = {(r["g"], r["term"]): r["idx"] for r in dense_index(df, ["g", "term"], "idx").collect()}
    expected = {k: i for i, k in enumerate(sorted(rows))}
    assert got == expected


def test_clear_stages_removes_written_tables(spark):
    import os

    from larder.plans.materialize import clear_stages, materialize
    df = materialize(spark.range(10), "probe")
    path = df.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    assert clear_stages(spark) >= 1
    assert not os.path.exists(path)
