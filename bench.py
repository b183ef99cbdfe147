"""Bench: run the headline queries on ``$BENCH_SF_DIR`` and print one JSON line.

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  Times include the model
fits each query performs (medians, caps, eigen-decompositions); stages that
an earlier query wrote are read.  With ``BENCH_COLD=1`` every query also runs
with no stage written ("cold"), which makes single rows comparable.
"""

from __future__ import annotations

import json
import os
import sys
import time

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, _HERE)

HEADLINE = [
    "servings_resolution",
    "time_resolution",
    "numeric_scaled",
    "numeric_preprocessing_summary",
    "tfidf_weighted",
    "svd_sweep",
    "combined_embedding",
    "missingness",
    "interaction_summary",
    "document_vocab_sweep",
    "time_consistency",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from larder.session import get_spark
    from larder.plans.queries import QUERIES

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * int(cpus)))
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    cold = {}
    if os.environ.get("BENCH_COLD"):
        from larder.plans.materialize import clear_stages
        for name in names:
            clear_stages(spark)
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            cold[name] = round(time.perf_counter() - t0, 3)
    sf_text = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    try:
        sf = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf} | ({"cold": cold} if cold else {})))


if __name__ == "__main__":
    main()
