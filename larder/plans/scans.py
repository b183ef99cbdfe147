"""Running totals of ordered groups of any size, in two levels.

Rows are dealt by ranges of (keys, order), so a group of any size spreads over partitions.
Totals of each (group, partition) are few; their own running totals give every partition
its start.  No task holds more than its share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.plans.materialize import materialize


def running(rows: DataFrame, keys: list[str], order: list[Column], totals: dict[str, tuple], name: str) -> DataFrame:
    """``rows`` with running totals within each group, the row's own value included.

    ``rows`` is a written table.  ``totals`` maps a new column to (aggregate, column), the
    aggregate one whose values combine by itself (sum, bit_xor).  Null keys are a group.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(rows.repartitionByRange(n, *keys, *order).withColumn("__part", F.spark_partition_id()), name)
    parts = dealt.groupBy(*keys, "__part").agg(*(f(c).alias(f"__{k}") for k, (f, c) in totals.items()))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*(F.col(k).alias(f"__key_{k}") for k in keys), F.col("__part").alias("__at"),
                          *(F.coalesce(f(f"__{k}").over(before), F.lit(0)).alias(f"__{k}") for k, (f, _) in totals.items()))
    same = F.col("__part") == F.col("__at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    within = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.select(*rows.columns, "__part", *(f(c).over(within).alias(k) for k, (f, c) in totals.items())).join(starts, same)
    return out.select(*rows.columns, *((F.col(f"__{k}").bitwiseXOR(F.col(k)) if f is F.bit_xor else F.col(f"__{k}") + F.col(k)).alias(k) for k, (f, _) in totals.items()))
