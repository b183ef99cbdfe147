"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of the doc_id as text leaves ``fold``; false for a null id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == fold, F.lit(False))


def known_labels(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """(doc_id, label) outside the held-out fold; null ids and labels are left out, an id labelled twice has its larger label."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna().where(~held_out(folds, fold))
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, max_rows: int | None) -> DataFrame:
    """(doc_id, text, label) of labelled documents outside the held-out fold.

    About ``max_rows`` labels are drawn by a hash of the id (all of them where there are
    fewer), so the drawn ids are a bounded set and are broadcast to the scan; without
    ``max_rows`` all are taken, and the planner chooses the join.  Null ids and
    labels are left out; an id labelled twice has its larger label, a document id that
    repeats counts once.
    """
    known = known_labels(labels, label, folds, fold)
    if max_rows is None:
        rows = docs.select("doc_id", "text").join(known, "doc_id")
        return rows.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("label").alias("label"))
    share = min(1.0, max_rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(label)), F.lit(1_000_000)) < F.lit(share * 1_000_000))
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return rows.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("label").alias("label"))
