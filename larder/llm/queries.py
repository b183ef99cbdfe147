"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import table
from larder.llm.decontaminate import contamination
from larder.llm.embeddings import near_vectors
from larder.llm.mixing import mix
from larder.llm.pages import page_text
from larder.llm.passages import passage_groups
from larder.llm.pii import personal_data
from larder.llm.quality import quality
from larder.llm.simhash import simhash_groups
from larder.llm.spelling import spelling_forms, word_counts
from larder.llm.sql import SQL
from larder.llm.suffixes import remove_repeats
from larder.llm.toxicity import toxicity
from larder.llm.turns import prefix_trie
from larder.llm.warc import archived_pages

__all__ = ["QUERIES", "SQL"]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text(table(spark, sf_dir, "pages"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_groups(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("rid")


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("rid")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(word_counts(table(spark, sf_dir, "documents")))


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_page_text": op2_page_text,
    "op3_personal_data": op3_personal_data,
    "op4_quality": op4_quality,
    "op5_mix": op5_mix,
    "op6_toxicity": op6_toxicity,
    "op7_suffixes": op7_suffixes,
    "op8_embeddings": op8_embeddings,
    "op9_passages": op9_passages,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_turns": op12_turns,
    "op13_warc": op13_warc,
    "pipeline": corpus_pipeline.run,
}
