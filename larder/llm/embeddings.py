"""Embedding near-duplicates by Euclidean p-stable hashing.

Unit vectors at cosine ``c`` lie ``sqrt(2 - 2c)`` apart.  A table hashes a vector by
``k`` quantised random projections ``floor((a.v + b) / width)``; vectors that share all ``k``
numbers in one of ``L`` tables are candidates and are compared exactly.  ``k`` follows the
number of vectors (unrelated ones rarely meet), ``L`` the recall asked for at the threshold.

Equal vectors of a label are one class, so copies cost nothing; links are between classes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize, numbered
from larder.llm.components import components


def collision(distance: float, width: float) -> float:
    """The chance that one quantised projection agrees for two points so far apart."""
    t = width / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def tables_for(rows: int, cosine: float, width: float, recall: float) -> tuple[int, int]:
    """(k, L): k lets a vector meet about one unrelated (orthogonal) vector a table; L gives the recall at the threshold."""
    near, far = collision(math.sqrt(2 - 2 * cosine), width), collision(math.sqrt(2), width)
    k = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near**k))


def _buckets(classes: DataFrame, k: int, tables: int, width: float, seed: int) -> DataFrame:
    """(cid, bucket): one row for each class and table; bucket mixes the table, the label, the length and the k numbers."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        made: dict = {}
        for b in batches:
            cids, out = [], []
            for start in range(0, b.num_rows, 1024):
                part = b.slice(start, 1024)
                rows = part.column(1).to_pylist()
                labels = np.array(part.column(2).to_pylist(), dtype=np.int64)
                sizes = np.array([len(r) for r in rows])
                for n in np.unique(sizes):
                    if n not in made:
                        rng = np.random.default_rng([seed, int(n)])
                        made[n] = (rng.standard_normal((n, tables * k)), rng.random(tables * k) * width,
                                   rng.integers(1, 1 << 62, tables * k, dtype=np.int64) * 2 + 1)
                    a, shift, mix = made[n]
                    at = np.flatnonzero(sizes == n)
                    v = np.array([rows[i] for i in at], dtype=float)
                    v /= np.abs(v).max(axis=1, keepdims=True)
                    v /= np.linalg.norm(v, axis=1, keepdims=True)
                    cells = np.floor((v @ a + shift) / width).astype(np.int64)
                    with np.errstate(over="ignore"):
                        mixed = (cells * mix).reshape(len(at), tables, k).sum(axis=2)
                        mixed ^= (labels[at, None] * 1_000_003 + np.arange(tables) * 8191 + n) * 0x9E3779B97F4A7C1
                    cids.append(np.repeat(part.column(0).to_numpy(zero_copy_only=False)[at], tables))
                    out.append(mixed.ravel())
            empty = np.zeros(0, dtype=np.int64)
            yield pa.record_batch([pa.array(np.concatenate(cids) if cids else empty), pa.array(np.concatenate(out) if out else empty)], names=["cid", "bucket"])

    return classes.select("cid", "v", F.xxhash64("label").alias("label")).mapInArrow(run, "cid long, bucket long")


def _usable(v: str):
    """No null or non-finite component, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(v).isNotNull() & finite & F.exists(v, lambda x: x != 0)


def near_vectors(vectors: DataFrame, cosine: float = 0.93, recall: float = 0.9999, width: float = 2.0, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row.

    Vectors of equal, non-null label whose cosine in double precision is at least
    ``cosine`` are linked; null, zero and non-finite vectors, those with a null component
    and those of different length link with nothing.  component_id is the smallest vec_id
    reachable (null ids never win over others).  Rows that repeat a vec_id are vectors of
    their own.  An empty table gives no rows.
    """
    rows = materialize(numbered(vectors, "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")), "vectors")
    usable = F.coalesce(_usable("v"), F.lit(False)) & F.col("label").isNotNull()
    classes = rows.where(usable).groupBy("label", "v").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
    k, tables = tables_for(largest, cosine, width, recall)

    spark = rows.sparkSession
    dealt = classes.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cid")
    index = materialize(_buckets(dealt, k, tables, width, seed), "vector-buckets")
    pairs = (index.withColumnRenamed("cid", "a").join(index.withColumnRenamed("cid", "b"), "bucket")
             .where("a < b").select("a", "b").distinct())
    of = classes.select("cid", "v", "label", "n")
    both = (pairs.join(of.select(F.col("cid").alias("a"), F.col("v").alias("va"), F.col("label").alias("la"), F.col("n").alias("na")), "a")
            .join(of.select(F.col("cid").alias("b"), F.col("v").alias("vb"), F.col("label").alias("lb"), F.col("n").alias("nb")), "b")
            .where("la = lb and size(va) = size(vb)"))

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    value = dot("va", "vb") / (F.sqrt(dot("va", "va")) * F.sqrt(dot("vb", "vb")))
    links = materialize(both.where(value >= cosine).select("a", "b", "na", "nb"), "vector-links")

    ends = links.select(F.col("a").alias("cid"), F.col("nb").alias("m")).unionAll(links.select(F.col("b").alias("cid"), F.col("na").alias("m")))
    degree = ends.groupBy("cid").agg(F.sum("m").alias("others"))
    roots = components(links, "a", "b").withColumnRenamed("node", "cid")
    named = classes.join(degree, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = named.withColumn("n_links", F.coalesce("others", F.lit(0).cast("long")) + F.col("n") - 1)
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    found = named.join(names, "root").select(F.col("label").alias("l"), F.col("v").alias("w"), "n_links", "component")
    linked = rows.where(usable).join(found, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w"))).select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
