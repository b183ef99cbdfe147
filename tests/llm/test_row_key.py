import pytest

from larder.llm.common import numbered, row_key
from larder.llm.simhash import keep_first


def test_row_keys_pin_the_splits_of_later_scans(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.range(0, 5000, 1, 7).selectExpr("id AS doc_id", "repeat('x', 50) AS text").write.parquet(str(tmp_path / "d"))
        docs = spark.read.parquet(str(tmp_path / "d"))
        a = numbered(docs, "doc_id")
        pinned = spark.conf.get("spark.sql.files.minPartitionNum")
        b = docs.withColumn("rid", row_key(docs)).select("doc_id", "rid")
        assert spark.conf.get("spark.sql.files.minPartitionNum") == pinned
        assert a.exceptAll(b).isEmpty() and b.select("rid").distinct().count() == 5000
    finally:
        if before is None:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        else:
            spark.conf.set("spark.sql.files.minPartitionNum", before)


def test_other_plans_are_refused(spark, edge_docs):
    for docs in (edge_docs.repartition(5), edge_docs.orderBy("doc_id"), edge_docs.limit(7), edge_docs.distinct(), edge_docs.union(edge_docs), edge_docs.join(edge_docs.select("doc_id"), "doc_id")):
        with pytest.raises(ValueError, match="write this one first"):
            keep_first(docs)
    assert numbered(edge_docs.where("doc_id > 5").select("doc_id", "text"), "doc_id").count() > 0
