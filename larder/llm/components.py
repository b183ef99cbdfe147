"""Connected components of a link table, by alternating large-star and small-star.

Every round is two joins and two aggregates over the links; nothing is collected.  A node
with very many links is only a partial minimum before the shuffle, and the join that sends
the minimum back has one row per node on its other side, so a hot node can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    ``a`` and ``b`` are columns of one ordered type.  Links may repeat, point either way or
    join a node with itself; null ends are ignored.  No links give no rows.  The number of
    rounds follows the logarithm of the component size.
    """
    edges = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
                        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _signature(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "links")
        now = _signature(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
