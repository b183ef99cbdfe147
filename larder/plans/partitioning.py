"""Partitioning helpers.

``spread`` hash-partitions a scan on its key only when the scan is a single
split (a small file with one row group), where every regex of the plan would
run on one core.  A scan of several splits is left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    if df.rdd.getNumPartitions() > 1:
        return df
    n = max(2, 2 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, *keys) if keys else df.repartition(n)


def dense_index(df: DataFrame, order_cols: list, out: str = "index") -> DataFrame:
    """0-based dense row index in ``order_cols`` order, without a single-task sort.

    Range-partition and sort; within a partition the position comes from
    ``monotonically_increasing_id`` (partition id in the high bits, position
    in the low 33); the numbered rows are written once, and the running total of
    the partitions' counts (one row per partition) is joined to them.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from larder.plans.materialize import materialize

    n = target_partitions(df)
    numbered = materialize(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                           .withColumn("__mid", F.monotonically_increasing_id()), "indexed")
    numbered = numbered.withColumn("__part", F.shiftright("__mid", 33))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
              .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    local = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.join(starts, "__part").withColumn(out, F.col("__start") + local).drop("__mid", "__part", "__start")
