"""Views over the driver's TPC-H-style tables, shaped like a recipe catalog.

The driver tables hold no NULLs, so missing and invalid values are injected
by arithmetic on keys (no row is dropped; every view covers its whole source
tables).  Nutrition values are built from integer cents so Spark and the
DuckDB oracle see bit-identical doubles.

=============  ===========================================================
view           source
=============  ===========================================================
catalog        orders JOIN customer LEFT JOIN (lineitem per order)
reviews        lineitem (one review per line; part = reviewer)
ingredients    lineitem JOIN part: one raw ingredient (part name) per line
keywords       part type + brand per line, priority + a time tag per order
doc_words      documents: every word of every whole text
=============  ===========================================================

Each builder has a SQL twin in ``VIEW_SQL`` used by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.plans.partitioning import spread  # noqa: F401  (re-exported)
from larder.sources.tables import table


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("long")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipe-shaped catalog: one row per order."""
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    c = table(spark, sf_dir, "customer")
    li = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    lines = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("n_filled"),
        F.sum("l_quantity").alias("qty"),
        F.sum(F.round("l_quantity").cast("long") * _cents(F.col("l_discount"))).alias("qty_disc"),
        (F.max("l_extendedprice") - F.min("l_extendedprice")).alias("price_range"),
        F.sum(_cents(F.col("l_extendedprice")) * _cents(F.col("l_tax"))).alias("price_tax"),
        F.sum(_cents(F.col("l_extendedprice"))).alias("price_cents"),
        F.sum(_cents(F.col("l_tax"))).alias("tax_cents"),
        F.sum(_cents(F.col("l_extendedprice")) * (100 - _cents(F.col("l_discount")))).alias("net_cents"),
    )
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    cat = (
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 89 == 0, F.lit("  "))
        .when(k % 5 == 0, F.concat(F.lit("< "), (15 * (1 + k % 4)).cast("string"), F.lit(" Mins")))
        .otherwise(F.concat(F.col("c_mktsegment"), F.lit("/"), F.col("o_orderpriority")))
    )
    serv = (F.when(k % 3 == 0, F.lit(None)).when(k % 101 == 0, F.lit(0.0))
            .otherwise((1 + ck % 12).cast("double")))
    yield_text = (
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 1, "serves 4-6").when(k % 13 == 2, "12 muffins")
        .when(k % 13 == 3, "1 loaf").when(k % 13 == 4, "2 dozen servings")
        .when(k % 13 == 5, "1 9-inch pie, serves 8").when(k % 13 == 6, "1 1/2 servings")
        .when(k % 13 == 7, " ").when(k % 13 == 8, "3 cups")
        .when(k % 13 == 9, "Serves 2 dozen").when(k % 13 == 10, "10 1/2 cup servings")
        .when(k % 13 == 11, "24 Cookies").otherwise("about enough")
    )
    prep = (F.when(k % 7 == 0, F.lit(None)).when(k % 211 == 0, F.lit(-5.0))
            .otherwise((ck % 40).cast("double")))
    cook = F.when(k % 4 == 0, F.lit(None)).otherwise((k % 60).cast("double"))
    total = (F.when(k % 11 == 0, F.lit(None)).when(k % 103 == 0, F.lit(1.0))
             .otherwise((ck % 40 + k % 60).cast("double")))
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner").join(
        lines, o.o_orderkey == lines.l_orderkey, "left")
    return joined.select(
        k.alias("RecipeId"),
        ck.alias("AuthorId"),
        F.col("c_name").alias("Name"),
        F.col("o_orderdate").alias("DatePublished"),
        cat.alias("RecipeCategory"),
        serv.alias("RecipeServings"),
        yield_text.alias("RecipeYield"),
        prep.alias("PrepTime_Minutes"),
        cook.alias("CookTime_Minutes"),
        total.alias("TotalTime_Minutes"),
        F.col("o_totalprice").alias("Calories"),
        F.col("qty").cast("double").alias("FatContent"),
        (F.col("qty_disc") / 100.0).alias("SaturatedFatContent"),
        F.col("price_range").alias("CholesterolContent"),
        (F.col("price_tax") / 10000.0).alias("SodiumContent"),
        (F.col("price_cents") / F.col("n_lines") / 100.0).alias("CarbohydrateContent"),
        F.col("tax_cents").cast("double").alias("FiberContent"),
        (F.col("net_cents") / 10000.0).alias("SugarContent"),
        F.col("c_acctbal").alias("ProteinContent"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("NumIngredients"),
        F.coalesce(F.col("n_filled"), F.lit(0)).cast("int").alias("NumQuantities"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per line item; every 50th part's reviews point at no recipe."""
    li = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    ok = F.col("l_orderkey")
    return li.select(
        (ok * 8 + F.col("l_linenumber")).alias("ReviewId"),
        F.when(F.col("l_partkey") % 50 == 0, -1 - ok).otherwise(ok).alias("RecipeId"),
        F.col("l_partkey").alias("AuthorId"),
        (F.col("l_linenumber") % 6).cast("int").alias("Rating"),
        F.col("l_shipdate").alias("DateSubmitted"),
    )


def ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form ``(RecipeId, ingredient)``: the part name of every line."""
    li = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    p = table(spark, sf_dir, "part")
    return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.col("l_orderkey").alias("RecipeId"), F.col("p_name").alias("ingredient"))


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form ``(RecipeId, keyword)`` with time-like tags mixed in."""
    li = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    p = table(spark, sf_dir, "part")
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    k = F.col("o_orderkey")
    from_parts = li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.col("l_orderkey").alias("RecipeId"),
        F.explode(F.array(F.col("p_type"), F.col("p_brand"))).alias("keyword"))
    time_tag = (
        F.when(F.col("o_orderstatus") == "F", F.lit("Weeknight"))
        .when(F.col("o_orderstatus") == "O",
              F.concat(F.lit("< "), (15 * (1 + k % 4)).cast("string"), F.lit(" Mins")))
        .otherwise(F.lit("Time-To-Make"))
    )
    from_orders = o.select(k.alias("RecipeId"),
                           F.explode(F.array(F.col("o_orderpriority"), time_tag)).alias("keyword"))
    return from_parts.unionByName(from_orders)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form ``(doc_id, word)``: every word of every whole document."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    return d.select(
        F.col("doc_id"),
        F.explode(words_of(F.col("text"))).alias("word"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id")


def list_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(PartId, cell)``: one list cell per part, as Python would print it, or broken, scalar or missing."""
    p, k = spread(table(spark, sf_dir, "part"), "p_partkey"), F.col("p_partkey")
    forms = [("['{name}', '{type}']", 1), ("[\"{name}'s\", '{brand}']", 2), ("('{name}', '{type}')", 3), ("{name}", 4), ("['{name}', '{type}'", 5), ("[]", 6),
             ("[{key}, -2.5e3, None, True, '{name}']", 7), ("['it\\'s {name}', \"a \\\\ b\\n\"]", 8), ("'{name}'", 9), ("  [ '{name}' , ]  ", 10),
             ("[['{name}', 1], ('{type}',)]", 11), ("None", 12), ("   ", 13), ("{key}", 14), ("()", 15), ("['{name}' '{type}']", 16)]
    cell = F.lit(None).cast("string")
    for text, at in forms:
        made = F.lit(text)
        for name, col in (("name", "p_name"), ("type", "p_type"), ("brand", "p_brand"), ("key", "p_partkey")):
            made = F.replace(made, F.lit("{" + name + "}"), F.col(col).cast("string"))
        cell = F.when(k % 17 == at, made).otherwise(cell)
    return p.select(k.alias("PartId"), cell.alias("cell"))


# ---------------------------------------------------------------------------
# SQL twins for the DuckDB oracle (tables are pre-registered views there).
# ---------------------------------------------------------------------------

_CENTS = "CAST(round({} * 100) AS BIGINT)"

VIEW_SQL = {
    "catalog": f"""
catalog AS (
  WITH li AS (
    SELECT l_orderkey,
      COUNT(*) AS n_lines,
      SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS n_filled,
      SUM(l_quantity) AS qty,
      SUM(CAST(round(l_quantity) AS BIGINT) * {_CENTS.format('l_discount')}) AS qty_disc,
      MAX(l_extendedprice) - MIN(l_extendedprice) AS price_range,
      SUM({_CENTS.format('l_extendedprice')} * {_CENTS.format('l_tax')}) AS price_tax,
      SUM({_CENTS.format('l_extendedprice')}) AS price_cents,
      SUM({_CENTS.format('l_tax')}) AS tax_cents,
      SUM({_CENTS.format('l_extendedprice')} * (100 - {_CENTS.format('l_discount')})) AS net_cents
    FROM lineitem GROUP BY l_orderkey)
  SELECT o.o_orderkey AS RecipeId, o.o_custkey AS AuthorId, c.c_name AS Name,
    o.o_orderdate AS DatePublished,
    CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderkey % 89 = 0 THEN '  '
         WHEN o.o_orderkey % 5 = 0 THEN '< ' || CAST(15 * (1 + o.o_orderkey % 4) AS VARCHAR) || ' Mins'
         ELSE c.c_mktsegment || '/' || o.o_orderpriority END AS RecipeCategory,
    CASE WHEN o.o_orderkey % 3 = 0 THEN NULL WHEN o.o_orderkey % 101 = 0 THEN 0.0
         ELSE CAST(1 + o.o_custkey % 12 AS DOUBLE) END AS RecipeServings,
    CASE o.o_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'serves 4-6' WHEN 2 THEN '12 muffins'
      WHEN 3 THEN '1 loaf' WHEN 4 THEN '2 dozen servings' WHEN 5 THEN '1 9-inch pie, serves 8'
      WHEN 6 THEN '1 1/2 servings' WHEN 7 THEN ' ' WHEN 8 THEN '3 cups' WHEN 9 THEN 'Serves 2 dozen'
      WHEN 10 THEN '10 1/2 cup servings' WHEN 11 THEN '24 Cookies' ELSE 'about enough' END AS RecipeYield,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 211 = 0 THEN -5.0
         ELSE CAST(o.o_custkey % 40 AS DOUBLE) END AS PrepTime_Minutes,
    CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE CAST(o.o_orderkey % 60 AS DOUBLE) END AS CookTime_Minutes,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 103 = 0 THEN 1.0
         ELSE CAST(o.o_custkey % 40 + o.o_orderkey % 60 AS DOUBLE) END AS TotalTime_Minutes,
    o.o_totalprice AS Calories,
    CAST(li.qty AS DOUBLE) AS FatContent,
    li.qty_disc / 100.0 AS SaturatedFatContent,
    li.price_range AS CholesterolContent,
    li.price_tax / 10000.0 AS SodiumContent,
    li.price_cents / li.n_lines / 100.0 AS CarbohydrateContent,
    CAST(li.tax_cents AS DOUBLE) AS FiberContent,
    li.net_cents / 10000.0 AS SugarContent,
    c.c_acctbal AS ProteinContent,
    CAST(COALESCE(li.n_lines, 0) AS INTEGER) AS NumIngredients,
    CAST(COALESCE(li.n_filled, 0) AS INTEGER) AS NumQuantities
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
)""",
    "reviews": """
reviews AS (
  SELECT l_orderkey * 8 + l_linenumber AS ReviewId,
    CASE WHEN l_partkey % 50 = 0 THEN -1 - l_orderkey ELSE l_orderkey END AS RecipeId,
    l_partkey AS AuthorId, CAST(l_linenumber % 6 AS INTEGER) AS Rating, l_shipdate AS DateSubmitted
  FROM lineitem
)""",
    "ingredients": """
ingredients AS (
  SELECT l.l_orderkey AS RecipeId, p.p_name AS ingredient
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)""",
    "keywords": """
keywords AS (
  SELECT l.l_orderkey AS RecipeId, p.p_type AS keyword FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  UNION ALL
  SELECT l.l_orderkey AS RecipeId, p.p_brand AS keyword FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  UNION ALL
  SELECT o_orderkey AS RecipeId, o_orderpriority AS keyword FROM orders
  UNION ALL
  SELECT o_orderkey AS RecipeId,
    CASE WHEN o_orderstatus = 'F' THEN 'Weeknight'
         WHEN o_orderstatus = 'O' THEN '< ' || CAST(15 * (1 + o_orderkey % 4) AS VARCHAR) || ' Mins'
         ELSE 'Time-To-Make' END AS keyword
  FROM orders
)""",
    "doc_words": """
doc_words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS word FROM documents
)""",
}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views in dependency order."""
    return "WITH " + ",\n".join(VIEW_SQL[n].strip() for n in names)
