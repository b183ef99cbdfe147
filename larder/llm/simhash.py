"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint of 64 bits has the majority bit of its shingles' XXH64 values.  Two
fingerprints that differ in at most ``d`` bits, cut into ``d // 2 + 1`` segments, have a
segment in which they differ in at most one bit.  Each segment is therefore indexed under
every variant with one bit masked out; fingerprints that share a variant are joined and
their distance verified.

Only distinct fingerprints are indexed, so exact copies cost nothing.  A bucket of two is
read off its minimum and maximum; buckets of up to ``pair_limit`` are joined in pairs.  The
members of larger buckets are linked without pairs: each fingerprint lists the values
within half the distance of it, and two fingerprints are within ``d`` exactly if their
lists meet, so linking all that list a value to the smallest one gives every component.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize, numbered, row_key, text_rows, upper_to_lower
from larder.llm.components import components

BITS = 64


def _fingerprint(raw: bytes, shingle: int) -> int:
    import numpy as np
    import xxhash

    words = raw.translate(upper_to_lower).split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[min(shingle, len(words)) - 1:]
    n, digest = len(last), xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, 65536):
        h = np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts[k:k + 65536], last[k:k + 65536], strict=False)),
                        dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(rid, doc_id, fp): one row per input row; fp holds the 64 bits as a long.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a text of fewer words
    than ``shingle`` is one shingle; null and wordless texts have fingerprint zero.
    """
    def run(batches):
        import pyarrow as pa

        for b in batches:
            fp = [_fingerprint(t or b"", shingle) for (t,) in text_rows(b, "text")]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fp, pa.int64())], names=["rid", "doc_id", "fp"])

    src = numbered(docs, "doc_id", F.col("text").cast("binary").alias("text")).select("rid", "doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"rid long, doc_id {kind}, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment: enough that one of them differs in at most one bit."""
    cuts = max(2, max_bits // 2 + 1)
    edges = [BITS * i // cuts for i in range(cuts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def _part(lo: int, width: int, without: int | None = None):
    """The bits of a segment as a number, one of them masked out."""
    mask = (1 << width) - 1
    if without is not None:
        mask ^= 1 << without
    return F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit(mask))


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp) for each segment and each masked bit of it; key holds the masked bit's number and the rest."""
    keys = [_part(lo, width, bit).bitwiseOR(F.lit((lo + bit) << 32)) for lo, width in _segments(max_bits) for bit in range(width)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _members(fps: DataFrame, buckets: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp) of the given buckets.

    A bucket's members have one of two segment values (its masked bit off or on), so the
    fingerprints are joined by their few segments and not by their many variants.
    """
    cuts = _segments(max_bits)
    parts = F.array(*(F.struct(F.lit(s).alias("segment"), _part(lo, width).alias("value")) for s, (lo, width) in enumerate(cuts)))
    whole = fps.select("fp", F.explode(parts).alias("p")).select("fp", "p.segment", "p.value")
    slot, rest = F.shiftright(F.col("key"), 32).cast("int"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1))
    segment, bit = F.lit(0), slot
    for s, (lo, _) in enumerate(cuts):
        segment, bit = F.when(slot >= lo, s).otherwise(segment), F.when(slot >= lo, slot - lo).otherwise(bit)
    on = rest.bitwiseOR(F.expr("shiftleft(1L, bit)"))
    values = buckets.withColumn("segment", segment).withColumn("bit", bit).select("key", "segment", F.explode(F.array(rest, on)).alias("value"))
    return whole.join(values, ["segment", "value"]).select("key", "fp")


def _near(bits: int) -> list[int]:
    """The masks of at most ``bits`` bits, as signed longs."""
    out = [sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(BITS), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def links(fps: DataFrame, max_bits: int = 2, pair_limit: int = 16) -> DataFrame:
    """(a, b): links between distinct fingerprints that differ in at most ``max_bits`` bits.

    The links span the components of that relation.  Every returned link holds; in crowded
    buckets a component is spanned by stars instead of all its pairs.
    """
    spark = fps.sparkSession
    # an explicit number of tasks: the fingerprints are small, their variants are not (dealt by
    # another hash than the grouping above it, or Spark would drop the step as already done)
    dealt = fps.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    sizes = materialize(variants(dealt, max_bits).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                        .where("n > 1"), "buckets")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    two = sizes.where("n = 2").where(close).select("a", "b")
    some = _members(fps, sizes.where(f"n between 3 and {pair_limit}").select("key"), max_bits)
    some = some.withColumnRenamed("fp", "a").join(some.withColumnRenamed("fp", "b"), "key").where("a < b").where(close).select("a", "b")
    hot = _members(fps, sizes.where(f"n > {pair_limit}").select("key"), max_bits).select("fp").distinct()
    return two.union(some).union(_stars(hot, max_bits)).distinct()


def _stars(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links of crowded fingerprints: a value's listers are within ``max_bits`` of the smallest near one.

    For an odd distance one of the two lists reaches a bit further; only the shorter reach
    may be the centre of a star.
    """
    short, far = max_bits // 2, max_bits - max_bits // 2
    near = len(_near(short))
    masks = F.array(*(F.lit(m) for m in _near(far)))
    listed = fps.select("fp", F.posexplode(masks).alias("i", "m")).select("fp", (F.col("i") < near).alias("short"), F.col("fp").bitwiseXOR(F.col("m")).alias("at"))
    centre = listed.where("short").groupBy("at").agg(F.min("fp").alias("a"))
    return listed.join(centre, "at").select("a", F.col("fp").alias("b")).where("a <> b")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(rid, doc_id, fingerprint, component_id): one row per input row.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked;
    component_id is the smallest doc_id reachable, the row's own included.  Null doc_ids
    never win over others (a component of nulls has a null id).  Repeated rows are linked
    like any copies.  An empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = components(links(fps.select("fp"), max_bits), "a", "b")
    rooted = fps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("rid", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents without near-duplicates: one row of each group stays, the one of the smallest doc_id.

    ``docs`` is a written table (its scan order numbers the rows).  All its columns return.
    Rows with a null doc_id stay only in a group of such rows, one of them.
    """
    groups = simhash_groups(docs, shingle, max_bits)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    kept = groups.groupBy("root").agg(F.min(first).alias("f")).select(F.col("f.rid").alias("__rid"))
    return docs.withColumn("__rid", row_key(docs)).join(kept, "__rid", "left_semi").drop("__rid")
