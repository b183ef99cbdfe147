"""Mixing sources to target weights with a low-discrepancy schedule.

Every source is shuffled into one stream of words and cut into blocks of ``block_words``.
Its target asks for a number of slots, one block each, and the streams start over when a
target is larger than its source.  The slots of all sources are laid out side by side (the
cumulative weights); the points of the van der Corput sequence, each hit once, say which
slot comes next.  Any stretch of the schedule therefore holds each source in nearly its
weight.  The slots of a source are ranked and joined with its blocks by number.

Everything is DataFrame functions.  Running sums are taken in two steps (sums per bucket,
then inside buckets), so a source that holds most of the rows is not one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import materialize, numbered

WEIGHTS = (5, 2, 1)


def sizes(docs: DataFrame, seed: int = 17) -> DataFrame:
    """(rid, doc_id, source, size, place): word counts and the shuffled place of each row.

    Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce("text", F.lit("")))
    place = F.md5(named)
    return numbered(docs, "doc_id", "source", words.alias("size"), place.alias("place"))


def targets(sized: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, target): one row per source.

    The sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words; no target exceeds ``most`` times its source.  With a common
    level L the targets are ``min(L * weight, most * size)``: sources stop in the order of
    size over weight, so L follows from running sums over the sources (a table of one row
    per source; documents are summed before).
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(by_name) - 1) % n + 1)
    per = per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    # the first source that the level leaves below its cap fixes the level of all later ones
    open_level = F.when(level * F.col("weight") < F.col("cap"), level)
    per = per.withColumn("open", open_level).withColumn("level", F.first("open", ignorenulls=True).over(everything))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("level") * F.col("weight"), "cap"))
    return per.select("source", "source_size", target.cast("double").alias("target"))


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def offsets(sized: DataFrame, bucket_rows: int = 2_000) -> DataFrame:
    """``sized`` with ``first``: the words before the row in its source's shuffled stream.

    Rows fall into buckets by the leading digits of their place; sums of whole buckets give
    each bucket's start, a window inside the bucket the rest.  The number of buckets grows
    with the rows.  Rows with the same place (repeated ids) are told apart by size and rid.
    """
    buckets = sized.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / bucket_rows))).first()[0]
    step = -(-(1 << 28) // int(buckets))
    bucket = F.floor(F.conv(F.substring("place", 1, 7), 16, 10).cast("long") / step)
    rows = sized.withColumn("bucket", bucket)
    whole = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select(F.col("source").alias("s"), F.col("bucket").alias("k"), F.coalesce(F.sum("words").over(run), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size", "rid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (rows.join(starts, _same("source", "s") & (F.col("bucket") == F.col("k")))
            .withColumn("first", F.col("start") + F.col("inside")).drop("bucket", "inside", "s", "k", "start"))


def schedule(goals: DataFrame, block_words: int = 4096, chunk: int = 1 << 16) -> DataFrame:
    """(slot, source, block, words): the blocks of the mix in order; slot is the order key.

    A source takes ``round(target)`` words: whole rounds of its stream, then its first
    blocks, the last one cut.  Sources without words or target have no slot.
    """
    spark = goals.sparkSession
    takes = goals.withColumn("take", F.round("target").cast("long")).where("take > 0 and source_size > 0")
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    rest = F.col("take") % F.col("source_size")
    takes = takes.withColumn("blocks", blocks).withColumn(
        "slots", F.floor(F.col("take") / F.col("source_size")).cast("long") * F.col("blocks") + F.ceil(rest / block_words).cast("long"))
    run = Window.orderBy(F.col("source").isNull(), "source")
    takes = materialize(takes.withColumn("hi", F.sum("slots").over(run)).withColumn("lo", F.col("hi") - F.col("slots")), "slots")
    total = takes.agg(F.max("hi")).first()[0] or 0
    bits = max(1, int(total - 1).bit_length()) if total else 1
    points = spark.range(0, 1 << bits if total else 0).withColumnRenamed("id", "slot")
    # the radical inverse in base 2: the slot number's bits, reversed
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("long")
    points = points.withColumn("point", point).where(F.col("point") < total)
    # cells of the line of slots turn the search for a point's source into an equality join
    cell = 1 << max(0, bits - 12)
    cells = takes.select("*", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))).alias("cell"))
    own = points.withColumn("cell", F.floor(F.col("point") / cell)).join(cells, "cell").where("point >= lo and point < hi")
    own = materialize(own.select("slot", "source", "source_size", "take", "blocks", "slots", F.floor(F.col("slot") / chunk).alias("chunk")), "schedule")
    # rank of a slot among its source's: counts of earlier chunks, then inside the chunk
    whole = own.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = own.withColumn("inside", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1)
    ranked = ranked.join(starts, _same("source", "s") & (F.col("chunk") == F.col("c"))).withColumn("rank", F.col("before") + F.col("inside"))
    block = F.col("rank") % F.col("blocks")
    held = F.least(F.lit(block_words), F.col("source_size") - block * block_words)
    cut = F.col("take") % F.col("source_size") - block * block_words
    words = F.when((F.col("rank") == F.col("slots") - 1) & (F.col("take") % F.col("source_size") > 0), F.least(held, cut)).otherwise(held)
    return ranked.select("slot", "source", block.alias("block"), words.cast("long").alias("words"))


def pieces(placed: DataFrame, block_words: int = 4096) -> DataFrame:
    """(rid, doc_id, source, block, from, to, word_from): the part of each row in each block of its stream.

    from and to are places within the block, word_from is the first word within the row.
    """
    last = F.col("first") + F.col("size") - 1
    cut = placed.where("size > 0").select(
        "rid", "doc_id", "source", "first", "size",
        F.explode(F.sequence(F.floor(F.col("first") / block_words), F.floor(last / block_words))).alias("block"))
    base = F.col("block") * block_words
    return cut.select("rid", "doc_id", "source", "block", (F.greatest("first", base) - base).alias("from"),
                      (F.least(F.col("first") + F.col("size"), base + block_words) - base).alias("to"),
                      (F.greatest("first", base) - F.col("first")).alias("word_from"))


def planned(docs: DataFrame, block_words: int = 4096, seed: int = 17) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, targets, mixture): what ``mix`` and ``mixture`` are made of; the first two are written."""
    sized = materialize(sizes(docs, seed), "sizes")
    goals = materialize(targets(sized), "targets")
    parts = pieces(offsets(sized), block_words)
    slots = schedule(goals, block_words).select("slot", F.col("source").alias("s"), F.col("block").alias("k"), "words")
    cut = (parts.join(slots, _same("source", "s") & (F.col("block") == F.col("k"))).where(F.col("from") < F.col("words"))
           .select("slot", F.col("from").alias("position"), "rid", "doc_id", "source", "word_from",
                   (F.col("word_from") + F.least("to", "words") - F.col("from")).alias("word_to")))
    return sized, goals, cut


def mixture(docs: DataFrame, block_words: int = 4096, seed: int = 17) -> DataFrame:
    """(slot, position, rid, doc_id, source, word_from, word_to): the mixed words in the order (slot, position).

    A row is the words [word_from, word_to) of a document in one slot; position is its place
    in the slot's block.  Documents of repeated blocks have several rows, those that the mix
    does not take none, and the last block of a source is cut at its target.
    """
    return planned(docs, block_words, seed)[2]


def mix(docs: DataFrame, block_words: int = 4096, seed: int = 17) -> DataFrame:
    """(rid, doc_id, source, size, source_size, target, taken): one row per input row.

    ``taken`` counts the words of the row in the scheduled blocks, repeats included.  It is
    at most twice the size, and a source's taken words are its target, rounded.  Null
    sources are one source; empty texts take nothing; an empty table gives no rows; the
    same table gives the same mix.
    """
    sized, goals, mixed = planned(docs, block_words, seed)
    taken = mixed.groupBy("rid").agg(F.sum(F.col("word_to") - F.col("word_from")).cast("long").alias("taken"))
    named = goals.withColumnRenamed("source", "s")
    return (sized.join(taken, "rid", "left").join(named, _same("source", "s"))
            .select("rid", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))
