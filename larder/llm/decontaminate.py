"""Benchmark decontamination as a prefix-filtered containment join.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one
window).  Every window is a set of word shingles.  Containment of the whole window is
asked for, so by the prefix filter one shingle is enough to join on, and the rarest of
the corpus is taken: a document can hold the window only where it holds that shingle.
The shingle's place in the window bounds where the window may start and end (position
and length filter); what is left is compared word by word.

The benchmark is the stated query set.  Its shingles go to the tasks in blocks of at most
``block_tokens``, so what a task holds is bounded whatever the size of the benchmark; each
block is one pass over the documents.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import materialize, numbered, row_key, text_rows

#: Word bytes (digits, letters lower-cased, everything beyond ASCII); other bytes become a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_WORD_BYTES).split()


def _tokens_in(words: list[bytes], wanted: dict[int, set]):
    """(position, token words) of every wanted shingle; wanted holds sets of word tuples by length."""
    for n, tokens in wanted.items():
        if n == 1:
            yield from ((i, (w,)) for i, w in enumerate(words) if (w,) in tokens)
        else:
            yield from ((i, g) for i, g in enumerate(zip(*(words[k:] for k in range(n)), strict=False)) if g in tokens)


def benchmark_windows(benchmark: DataFrame, window: int = 13, shingle: int = 3) -> DataFrame:
    """(win, n, item_id, item_key, words, tokens): distinct windows of each item with their shingles.

    ``win`` is the window's words joined by spaces, ``tokens`` an array of (token, at).
    Items without words have no window.  item_key tells items apart, null ids as one item.
    """
    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, wins, sizes, tokens = [], [], [], []
            for k, (raw,) in enumerate(text_rows(b, "text")):
                words = words_of(raw)
                n = min(window, len(words))
                for i in range(len(words) - n + 1 if n else 0):
                    w, size = words[i:i + n], min(shingle, n)
                    ids.append(k)
                    sizes.append(n)
                    wins.append(b" ".join(w))
                    tokens.append([{"token": b" ".join(w[j:j + size]), "at": j} for j in range(n - size + 1)])
            shape = pa.list_(pa.struct([("token", pa.binary()), ("at", pa.int32())]))
            yield pa.record_batch([b.column(0).take(pa.array(ids, pa.int64())), pa.array(wins, pa.binary()), pa.array(sizes, pa.int32()),
                                   pa.array(tokens, shape)], names=["item_id", "win", "n", "tokens"])

    src = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    kind = src.schema["item_id"].dataType.simpleString()
    return src.mapInArrow(run, f"item_id {kind}, win binary, n int, tokens array<struct<token:binary,at:int>>").dropDuplicates(["item_id", "win"])


def _wanted(rows) -> dict[int, set]:
    out: dict[int, set] = {}
    for r in rows:
        words = tuple(bytes(r[0]).split())
        out.setdefault(len(words), set()).add(words)
    return out


def _blocks(tokens: DataFrame, block_tokens: int):
    """The distinct tokens in blocks of about ``block_tokens``, each broadcast to the tasks in turn."""
    spark, n = tokens.sparkSession, tokens.count()
    parts = max(1, -(-n // block_tokens))
    for p in range(parts if n else 0):
        own = tokens.where(F.pmod(F.xxhash64("token"), F.lit(parts)) == p).select("token").collect()
        yield spark.sparkContext.broadcast(_wanted(own))


def _counts(docs: DataFrame, tokens: DataFrame, block_tokens: int) -> DataFrame:
    """(token, freq): how often each benchmark shingle occurs in all documents (0 is left out)."""
    text, out = docs.select(F.col("text").cast("binary").alias("text")), None
    for wanted in _blocks(tokens, block_tokens):
        def run(batches, wanted=wanted):
            import pyarrow as pa

            for b in batches:
                seen: Counter = Counter()
                for (raw,) in text_rows(b, "text"):
                    seen.update(g for _, g in _tokens_in(words_of(raw), wanted.value))
                yield pa.record_batch([pa.array([b" ".join(g) for g in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

        part = text.mapInArrow(run, "token binary, n long")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return tokens.select("token", F.lit(0).cast("long").alias("freq"))
    return out.groupBy("token").agg(F.sum("n").alias("freq"))


def _candidates(docs: DataFrame, prefix: DataFrame, reach: int, block_tokens: int) -> DataFrame:
    """(rid, doc_id, n_words, found): found holds each prefix token's place and the words around it.

    ``reach`` words on either side cover every window that may hold the token there.
    """
    def scan(wanted):
        def run(batches):
            import pyarrow as pa

            shape = pa.list_(pa.struct([("token", pa.binary()), ("at", pa.int32()), ("first", pa.int32()), ("around", pa.list_(pa.binary()))]))
            for b in batches:
                sizes, found = [], []
                for (raw,) in text_rows(b, "text"):
                    words = words_of(raw)
                    sizes.append(len(words))
                    found.append([{"token": b" ".join(g), "at": i, "first": max(0, i - reach), "around": words[max(0, i - reach):i + len(g) + reach]}
                                  for i, g in (_tokens_in(words, wanted.value) if wanted else ())])
                yield pa.record_batch([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(found, shape)],
                                      names=["rid", "doc_id", "n_words", "found"])
        return run

    src = numbered(docs, "doc_id", F.col("text").cast("binary").alias("text")).select("rid", "doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, n_words long, found array<struct<token:binary,at:int,first:int,around:array<binary>>>"
    out = None
    for wanted in _blocks(prefix, block_tokens):
        part = materialize(src.mapInArrow(scan(wanted), schema), "candidates")
        # the first block brings the row of every document, further ones only what they found
        out = part if out is None else out.unionAll(part.where(F.size("found") > 0).withColumn("n_words", F.lit(None).cast("long")))
    return out if out is not None else materialize(src.mapInArrow(scan(None), schema), "candidates")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 3,
                  block_tokens: int = 200_000) -> DataFrame:
    """(rid, doc_id, n_words, n_hit, n_items, items, contaminated): one row per input row.

    A document word inside any occurrence of a window is hit; a document is contaminated
    if it has a hit and 20 * n_hit >= n_words.  ``items`` are the sorted ids (as strings)
    of the items with occurring windows; repeated benchmark rows of one id are one item,
    items with a null id are counted as one and not listed.  Null and empty texts have no
    words; an empty benchmark, or one without words, gives no hits.
    """
    windows = materialize(benchmark_windows(benchmark, window, shingle), "windows")
    shingles = materialize(windows.select("win", F.explode("tokens").alias("t")).select("win", "t.token", "t.at").distinct(), "shingles")
    freq = materialize(_counts(docs, shingles.select("token").distinct(), block_tokens), "shingle-counts")
    # the rarest shingle of each window that the corpus holds; a window with an absent one occurs nowhere
    ranked = shingles.join(freq, "token", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token", "at")).alias("p"))
    chosen = materialize(ranked.where("p.freq > 0").select("win", "p.token", F.col("p.at").alias("in_window")), "prefixes")
    cands = _candidates(docs, chosen.select("token").distinct(), window - 1, block_tokens)

    places = cands.where(F.size("found") > 0).select("rid", F.explode("found").alias("c")).select("rid", "c.*")
    texts = windows.select("win", "n", "item_id")
    start = F.col("at") - F.col("in_window")
    possible = (places.join(chosen.join(texts.select("win", "n").distinct(), "win"), "token")
                .withColumn("start", start)
                .where((F.col("start") >= F.col("first")) & (F.col("start") - F.col("first") + F.col("n") <= F.size("around"))))
    held = F.slice("around", F.col("start") - F.col("first") + 1, F.col("n"))
    joined = F.aggregate(held, F.lit(None).cast("binary"),
                         lambda acc, w: F.when(acc.isNull(), w).otherwise(F.concat(acc, F.lit(b" "), w)))
    occurs = materialize(possible.where(joined == F.col("win")).select("rid", "start", (F.col("start") + F.col("n")).alias("end"), "win").distinct(), "occurrences")

    order = Window.partitionBy("rid").orderBy("start", "end")
    reached = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached))
    hits = occurs.select("rid", "start", "end").distinct().withColumn("new", covered).groupBy("rid").agg(F.sum("new").cast("long").alias("n_hit"))
    items = (occurs.select("rid", "win").distinct().join(texts.select("win", "item_id"), "win").select("rid", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("rid").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items")))
    base = cands.where("n_words is not null").select("rid", "doc_id", "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (base.join(hits, "rid", "left").join(items, "rid", "left")
            .select("rid", "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` (a written table: its scan order numbers the rows) without contaminated rows; all its columns."""
    bad = contamination(docs, benchmark, **options).where("contaminated").select(F.col("rid").alias("__rid"))
    return docs.withColumn("__rid", row_key(docs)).join(bad, "__rid", "left_anti").drop("__rid")
