"""The corpus pipeline: toxicity, near-duplicates, decontamination, personal data, mixing.

Each stage reads the table its predecessor wrote and calls one operator of ``larder.llm``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import materialize, row_key, table
from larder.llm.decontaminate import drop_contaminated
from larder.llm.mixing import planned
from larder.llm.pii import redacted
from larder.llm.simhash import keep_first
from larder.llm.toxicity import drop_toxic

#: The columns of ``documents``.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels of the documents at hand."""
    return drop_toxic(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, two bits) stays."""
    return keep_first(docs.select(COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more lies in benchmark windows go."""
    return drop_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    clean = docs.select(COLUMNS).withColumn("text", redacted("text"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus in the order (slot, position): a row for each piece of a document that a slot takes.

    ``text`` holds the words [word_from, word_to) with the spaces after them, taken is their
    number and size that of the whole document.  Documents that the mix does not take are absent.
    """
    docs = docs.select(COLUMNS)
    sized, goals, mixed = planned(docs)
    size = sized.select(F.col("rid").alias("__rid"), "size")
    mixed = mixed.select("slot", "position", F.col("rid").alias("__rid"), "word_from", "word_to")
    goals = goals.withColumnRenamed("source", "__source")
    rows = docs.withColumn("__rid", row_key(docs)).join(size, "__rid").join(mixed, "__rid").join(goals, F.col("source").eqNullSafe(F.col("__source")))
    words = F.regexp_extract_all("text", F.lit(r"(?:^[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    taken = F.col("word_to") - F.col("word_from")
    cut = F.array_join(F.slice(words, (F.col("word_from") + 1).cast("int"), taken.cast("int")), "")
    rows = rows.withColumn("text", F.when(taken == F.col("size"), F.col("text")).otherwise(cut))
    return rows.select("slot", "position", "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"),
                       "word_from", "word_to", "size", "source_size", "target", taken.alias("taken"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_duplicates", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
]

#: SQL cannot fit the classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
