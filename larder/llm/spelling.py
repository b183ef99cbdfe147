"""Spelling variants: words one edit apart, found by walking a trie that is a table.

The words make two tries, of their texts and of their reversed texts, whose edges are a
distributed table (node, label, child).  Chains without branches are one edge with a longer
label.  A search state is (word, position, node, edits).  States without an edit lie on the
word's own path; joined with the edges of their node, one that the word does not take spends
the edit, by a replaced or a deleted code point.  States with the edit spent are joined with
the edges level by level until a word ends; an insertion is a deletion seen from the other word.

An edit in the right half of a word leaves its left half as it is, so the search of the first
trie starts at half the length, and an edit in the left half is found in the reversed trie.
There the tries are thin, and the frontier stays small.  Nodes are 64-bit hashes of their
prefixes: a collision merges two nodes, which adds states and loses none, and the words found
are compared as texts in the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize

#: Letters of a run, as a character class.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters handled at a time by a task (a longer word is handled alone).
LETTERS_AT_ONCE = 1 << 20


def word_counts(docs: DataFrame, min_length: int = 7, min_count: int = 2, drop_every: int | None = 31) -> DataFrame:
    """(word, n): the words of all texts with their occurrences, those of ``min_count`` and more.

    Words are maximal runs of ``LETTERS`` with A-Z in lower case.  With ``drop_every`` k, a run
    for which k divides h = crc32("<doc_id>:<run>") loses its code point h % length, which plants
    misspellings (a null doc_id counts as empty).  Runs and words of fewer than ``min_length``
    code points are left out; null texts have no words.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if drop_every:
        runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "word").cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.withColumn("word", F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("word"))).where(F.length("word") >= min_length)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _starts(lengths, side: int):
    """The depth from which a side's trie holds a word: the half that an edit of the other half leaves alone."""
    return lengths // 2 if side == 0 else lengths - lengths // 2


def _prefixes(texts: list[str]):
    """For all prefixes of all texts in order: node, next code point (0 at the end), depth, number of the text."""
    import numpy as np

    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(texts)), lengths + 1)
    first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    depth = np.arange(len(word)) - first[word]
    powers = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    nexts = np.zeros(len(word), dtype=np.int64)
    nexts[depth < lengths[word]] = codes
    terms = np.zeros(len(word), dtype=np.uint64)
    terms[depth > 0] = (codes * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(0xA0761D6478BD642F)) * powers[depth[depth > 0]]
    sums = np.cumsum(terms, dtype=np.uint64)
    node = sums - sums[first][word] + depth.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    node = (node ^ (node >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    node ^= node >> np.uint64(32)
    return node.view(np.int64), nexts, depth, word, lengths


def _groups(words: list[str]):
    """Ranges of words of about ``LETTERS_AT_ONCE`` letters together."""
    lo = size = 0
    for k, w in enumerate(words):
        if k > lo and size + len(w) > LETTERS_AT_ONCE:
            yield lo, k
            lo, size = k, 0
        size += len(w)
    if lo < len(words):
        yield lo, len(words)


def _paths(words: DataFrame) -> DataFrame:
    """(wid, at, node, next): each word's nodes from the start depth on; at is the depth, below zero (-1 - depth) in the reversed trie."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            for lo, hi in _groups(texts):
                for side in (0, 1):
                    node, nexts, depth, word, lengths = _prefixes([t[::-1] if side else t for t in texts[lo:hi]])
                    kept = depth >= _starts(lengths, side)[word]
                    at, node = depth[kept], node[kept]
                    at, node = (-1 - at, node ^ np.int64(0x5851F42D4C957F2D)) if side else (at, node)
                    yield pa.record_batch([pa.array(ids[lo:hi][word[kept]]), pa.array(at.astype(np.int32)), pa.array(node), pa.array(nexts[kept].astype(np.int32))],
                                          names=["wid", "at", "node", "next"])

    return words.select("wid", "word").mapInArrow(run, "wid long, at int, node long, next int")


STEPS = "side int, text string, pos int, to int, node long, child long, whole boolean"


def trie_steps(words: DataFrame) -> DataFrame:
    """(side, text, pos, to, node, child, whole): the edges along each word, from branch to branch.

    ``words`` is a written table (wid, word), the texts distinct.  text is the word, reversed on
    side 1; an edge leads from depth pos to depth to, the next branch or the end.  whole says
    that a word ends at node.  Words without a branch past their start depth have no rows.
    """
    paths = materialize(_paths(words), "trie-paths")
    branches = paths.groupBy("node").agg(F.min("next").alias("lo"), F.max("next").alias("hi")).where("lo <> hi").select("node", (F.col("lo") == 0).alias("whole"))
    along = paths.join(branches, "node").groupBy("wid").agg(F.collect_list(F.struct("at", "whole")).alias("along"))
    rows = along.join(words.select("wid", "word"), "wid").select("word", "along.at", "along.whole")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            words, at, whole = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            for lo, hi in _groups(words):
                for side in (0, 1):
                    texts = [w[::-1] if side else w for w in words[lo:hi]]
                    node, _, _, _, lengths = _prefixes(texts)
                    node = node ^ np.int64(0x5851F42D4C957F2D) if side else node
                    first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
                    out = []
                    for k, text in enumerate(texts):
                        mine = sorted((-1 - a if side else a, e) for a, e in zip(at[lo + k], whole[lo + k], strict=True) if (a < 0) == bool(side))
                        ends = [d for d, _ in mine[1:]] + [len(text)] * bool(mine)
                        out += [(text, d, e, first[k] + d, first[k] + e, w) for (d, w), e in zip(mine, ends, strict=True) if d < e]
                    if out:
                        text, pos, to, here, there, flag = zip(*out, strict=True)
                        yield pa.record_batch([pa.array([side] * len(out), pa.int32()), pa.array(text), pa.array(pos, pa.int32()), pa.array(to, pa.int32()),
                                               pa.array(node[np.array(here)]), pa.array(node[np.array(there)]), pa.array(flag)], names=[f.split()[0] for f in STEPS.split(", ")])

    return materialize(rows.mapInArrow(run, STEPS), "trie-steps")


def _bit(rest):
    """One of 64 bits for the rest of a word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(rest).bitwiseAND(F.lit(63)).cast("int"))


def _goes_on(rest):
    """Whether the words below an edge may hold this rest: one ends there, or the rest's bit is set."""
    return F.when(F.length(rest) == 0, F.col("ends")).otherwise(F.col("rests").bitwiseAND(_bit(rest)) != 0)


def _from(text, at, length=None):
    """The text from an offset (counted from 0) on."""
    return F.substring(text, at + 1, F.length(text) if length is None else length)


def trie_edges(steps: DataFrame) -> DataFrame:
    """(node, label, child, rests, ends): the distinct edges; rests has a bit for every rest of a word below the edge."""
    text, to = F.col("text"), F.col("to")
    label = _from(text, F.col("pos"), to - F.col("pos"))
    rest = _from(text, to)
    rows = steps.select("node", label.alias("label"), "child", F.when(F.length(rest) > 0, _bit(rest)).otherwise(F.lit(0).cast("long")).alias("rest"), (F.length(rest) == 0).alias("end"))
    return materialize(rows.groupBy("node", "label", "child").agg(F.bit_or("rest").alias("rests"), F.max("end").alias("ends")), "trie-edges")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): the pairs of words with exactly one replaced code point (a before b) or one more code point in a.

    ``words`` is a written table (wid, word) of distinct texts that are not null.  Pairs are
    distinct.  The empty text is near to every word of one code point.
    """
    steps = trie_steps(words)
    edges = trie_edges(steps)
    text, pos, label = F.col("text"), F.col("pos"), F.col("label")
    own, size = _from(text, pos, F.lit(1)), F.length(label)
    after, skipped = _from(text, pos + size), _from(text, pos + size + 1)
    put = (F.substring(label, 1, 1) > own) & (_from(label, F.lit(1)) == _from(text, pos + 1, size - 1)) & (pos + size <= F.length(text)) & _goes_on(after)
    cut = (F.substring(label, 1, 1) != own) & (label == _from(text, pos + 1, size)) & _goes_on(skipped)
    head = F.substring(text, F.lit(1), pos)
    ways = F.array_compact(F.array(F.when(put, F.struct(F.concat(head, label, after).alias("other"), (pos + size).alias("at"))),
                                   F.when(cut, F.struct(F.concat(head, label, skipped).alias("other"), (pos + size).alias("at")))))
    spent = (steps.select("side", "text", "pos", F.col("node").alias("here")).join(edges, (F.col("here") == F.col("node")) & (put | cut))
             .select("side", "text", F.explode(ways).alias("w"), F.col("child").alias("node")).select("side", "text", "w.other", "w.at", "node"))
    last = steps.where((F.col("pos") == F.length("text") - 1) & F.col("whole"))
    found = [last.select("side", "text", F.substring(text, F.lit(1), pos).alias("other"))]
    done = F.col("at") == F.length("other")
    frontier = materialize(spent, "trie-frontier")
    while True:
        found.append(frontier.where(done).select("side", "text", "other"))
        going = frontier.where(~done)
        if going.isEmpty():
            break
        other, at = F.col("other"), F.col("at")
        moved = going.withColumnRenamed("node", "here").join(edges, (F.col("here") == F.col("node")) & (_from(other, at, size) == label) & _goes_on(_from(other, at + size)))
        frontier = materialize(moved.select("side", "text", "other", (at + size).alias("at"), F.col("child").alias("node")), "trie-frontier")
    every = reduce(DataFrame.union, found)
    back = lambda c: F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c))
    return every.select(back("text").alias("x"), back("other").alias("y")).select(
        F.when((F.length("x") > F.length("y")) | (F.col("x") < F.col("y")), F.col("x")).otherwise(F.col("y")).alias("a"),
        F.when((F.length("x") > F.length("y")) | (F.col("x") < F.col("y")), F.col("y")).otherwise(F.col("x")).alias("b")).distinct()


def _followed(forms: DataFrame) -> DataFrame:
    """(word, root): the last of each word's forms, by doubling; ``forms`` is (word, form), n grows along it."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("w"), F.col("root").alias("further"))
        moved = materialize(roots.join(onward, F.col("root") == F.col("w"), "left")
                            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        roots = moved.select("word", "root")


def spelling_forms(counts: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of ``counts`` (word, n; words distinct).

    Words are near if one inserted, deleted or replaced code point makes one the other.  A word's
    form is its near word of the largest n (of ties the smallest by code points) if that n is at
    least ``ratio`` times its own; root is the last of the chain of forms, the word itself if it
    has none.  No words give no rows.
    """
    words = materialize(counts.where(F.col("word").isNotNull()).select(F.monotonically_increasing_id().alias("wid"), "word", F.col("n").cast("long").alias("n")), "words")
    pairs = materialize(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    sized = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = sized.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best"))
    strong = -F.col("best.m") >= ratio * F.col("n")
    rows = materialize(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.w")).alias("form"),
        F.when(strong, -F.col("best.m")).alias("form_n")), "word-forms")
    roots = _followed(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
