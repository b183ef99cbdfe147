"""Ingest (job 1): raw catalog / review text -> typed tables.

The raw files are quoted CSV with embedded newlines; pandas' missing-value
words become NULL.  List cells become ``ARRAY<STRING>`` (and stay arrays in
Parquet: no text round trip), ISO-8601 durations become minutes, and list
sizes become counts.  All of it is one projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.numbers import iso_duration_minutes
from larder.functions.text import parse_list
from larder.sources.tables import normalize_column_names

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Cell texts pandas' CSV reader treats as missing by default.
NA_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
            "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
LIST_COLUMNS = ["Images", "Keywords", "RecipeIngredientQuantities", "RecipeIngredientParts",
                "RecipeInstructions"]
DURATION_COLUMNS = ["CookTime", "PrepTime", "TotalTime"]
# ---------------------------------------------------------------------------


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Quoted CSV with embedded newlines; NA words -> NULL in every string column."""
    reader = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
              .option("quote", '"'))
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(*NA_WORDS), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def na_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """The reader's missing-value words -> NULL in the given text columns."""
    return df.withColumns({c: F.when(F.col(c).isin(*NA_WORDS), F.lit(None).cast("string"))
                              .otherwise(F.col(c)) for c in columns if c in df.columns})


def ingest_catalog(raw: DataFrame) -> DataFrame:
    """Lists parsed, durations in minutes, list sizes, normalized names."""
    out = na_to_null(raw, LIST_COLUMNS + DURATION_COLUMNS)
    present = set(raw.columns)
    for c in LIST_COLUMNS:
        if c in present:
            out = out.withColumn(c, parse_list(F.col(c)))
    for c in DURATION_COLUMNS:
        if c in present:
            out = out.withColumn(f"{c}_Minutes", iso_duration_minutes(F.col(c)))
    if "RecipeIngredientParts" in present:
        out = out.withColumn("NumIngredients", F.size("RecipeIngredientParts"))
    if "RecipeIngredientQuantities" in present:
        out = out.withColumn("NumQuantities", F.size("RecipeIngredientQuantities"))
    return normalize_column_names(out)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet output (arrays stay arrays)."""
    df.write.mode(mode).parquet(path)


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-text catalog built per order row (list and duration cells as text)."""
    from larder.plans.partitioning import spread
    from larder.sources.tables import table

    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    c = table(spark, sf_dir, "customer")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    seg, pri = F.col("c_mktsegment"), F.col("o_orderpriority")
    parts = (F.when(k % 29 == 0, F.lit(None).cast("string"))
             .when(k % 23 == 0, F.lit("character(0)"))
             .when(k % 10 == 0, F.concat(F.lit('c("'), F.lower(seg), F.lit('", NA)')))
             .when(k % 7 == 0, F.concat(F.lower(seg), F.lit(", "), F.lower(pri)))
             .otherwise(F.concat(F.lit('c("'), seg, F.lit('", "'), pri, F.lit('")'))))
    quants = F.concat(F.lit('c("'), (k % 5).cast("string"), F.lit('", "'), (ck % 3).cast("string"), F.lit('")'))
    kw = F.when(k % 6 == 0, F.lit("NA")).otherwise(F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"')))
    cook = F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("PT"), (k % 60).cast("string"), F.lit("M")))
    prep = (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 211 == 0, F.lit("-PT5M"))
            .when(k % 19 == 0, F.lit("about 5 min"))
            .when(k % 17 == 0, F.concat(F.lit("PT1H"), (ck % 40).cast("string"), F.lit("M")))
            .otherwise(F.concat(F.lit("PT"), (ck % 40).cast("string"), F.lit("M"))))
    total = (F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 31 == 0, F.lit("P1Y"))
             .when(k % 13 == 0, F.concat(F.lit("P"), (k % 3).cast("string"), F.lit("DT"),
                                         (k % 24).cast("string"), F.lit("H")))
             .otherwise(F.concat(F.lit("PT"), (k % 90).cast("string"), F.lit("M"), (k % 60).cast("string"),
                                 F.lit("S"))))
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        k.alias("RecipeId"), F.col("c_name").alias("Name"), cook.alias("CookTime"), prep.alias("PrepTime"),
        total.alias("TotalTime"), parts.alias("RecipeIngredientParts"),
        quants.alias("RecipeIngredientQuantities"), kw.alias("Keywords"))


RAW_CATALOG_SQL = """
raw_catalog AS (
  SELECT o.o_orderkey AS RecipeId, c.c_name AS Name,
    CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE 'PT' || CAST(o.o_orderkey % 60 AS VARCHAR) || 'M' END AS CookTime,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 211 = 0 THEN '-PT5M'
         WHEN o.o_orderkey % 19 = 0 THEN 'about 5 min'
         WHEN o.o_orderkey % 17 = 0 THEN 'PT1H' || CAST(o.o_custkey % 40 AS VARCHAR) || 'M'
         ELSE 'PT' || CAST(o.o_custkey % 40 AS VARCHAR) || 'M' END AS PrepTime,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 31 = 0 THEN 'P1Y'
         WHEN o.o_orderkey % 13 = 0 THEN 'P' || CAST(o.o_orderkey % 3 AS VARCHAR) || 'DT'
              || CAST(o.o_orderkey % 24 AS VARCHAR) || 'H'
         ELSE 'PT' || CAST(o.o_orderkey % 90 AS VARCHAR) || 'M' || CAST(o.o_orderkey % 60 AS VARCHAR) || 'S'
    END AS TotalTime,
    CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 23 = 0 THEN 'character(0)'
         WHEN o.o_orderkey % 10 = 0 THEN 'c("' || lower(c.c_mktsegment) || '", NA)'
         WHEN o.o_orderkey % 7 = 0 THEN lower(c.c_mktsegment) || ', ' || lower(o.o_orderpriority)
         ELSE 'c("' || c.c_mktsegment || '", "' || o.o_orderpriority || '")' END AS RecipeIngredientParts,
    'c("' || CAST(o.o_orderkey % 5 AS VARCHAR) || '", "' || CAST(o.o_custkey % 3 AS VARCHAR) || '")'
      AS RecipeIngredientQuantities,
    CASE WHEN o.o_orderkey % 6 = 0 THEN 'NA' ELSE '"' || o.o_orderstatus || '"' END AS Keywords
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""
