"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.plans.materialize import discard, materialize

__all__ = ["materialize", "discard", "table", "row_key", "numbered", "upper_to_lower", "text_rows"]

#: Bytes A-Z mapped to a-z; every other byte kept (so UTF-8 stays intact).
upper_to_lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Plan nodes under which the rows of a table keep their order and splits.
_SCAN = {"Project", "Filter", "SubqueryAlias", "View", "Relation", "LogicalRelation", "LogicalRDD", "LocalRelation"}


def _one_scan(df: DataFrame) -> bool:
    todo = [df._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        name = node.nodeName().split(" ")[0]
        if name not in _SCAN and not (name == "Repartition" and not node.shuffle()):  # coalesce() keeps the rows where they are
            return False
        below = node.children()
        todo += [below.apply(i) for i in range(below.size())]
    return True


def row_key(df: DataFrame):
    """A key of each row by scan order, the same in every scan of one written table.

    A plan that is more than a scan (a shuffle, a join, a limit) has no such order, so it raises
    an error: two runs of it would number the rows differently.  Write the table first.

    The splits of a scan follow the cores at hand unless ``spark.sql.files.minPartitionNum``
    is set.  It is set here to the present number where it is unset, so that an executor
    lost (or won) between two scans does not move the splits and with them the keys.
    """
    spark = df.sparkSession
    if not _one_scan(df):
        raise ValueError("rows are numbered in a table as it was written; write this one first")
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def numbered(df: DataFrame, *cols) -> DataFrame:
    """The given columns and a row key ``rid``.

    Extra input columns (whatever their names) are dropped here.  ``rid`` tells repeated
    rows and null ids apart; it is that of ``row_key``.
    """
    return df.select(*cols).withColumn("rid", row_key(df))


def text_rows(batch, *names: str) -> Iterator[tuple]:
    """Rows of an Arrow batch as Python tuples, one slice of rows at a time (bounded copies)."""
    cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for start in range(0, batch.num_rows, 256):
        yield from zip(*(c.slice(start, 256).to_pylist() for c in cols), strict=True)
