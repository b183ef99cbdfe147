"""Exact repeated substrings by distributed prefix doubling over sampled suffixes.

All suffixes of a corpus are too many rows, so only suffixes at *anchors* are ranked: the
places of the smallest hash in any ``window`` consecutive grams.  Equal substrings of
``length`` bytes hold the same anchors but for their margins.  The text between anchors is
a phrase; a suffix's first rank names its phrase.  Each round keeps the (position, rank)
pairs whose rank occurs again, pairs them with the rank found ``offset`` phrases on and
names the pairs; the offset doubles until the ranks span what two equal substrings are
sure to share.  Unique ranks are dropped at once, so rounds shrink.

The rest is exact and by whole bytes.  An anchor stands for the ``length``-byte windows in
which it is the smallest place.  Windows are judged in blocks of neighbours, by two
digests: the *union* of a block (repeated: every window of it is) and its *core*, the
bytes that all its windows share (unique: no window of it is repeated).  Blocks that
neither settles are cut into smaller ones, down to single windows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize, numbered, text_rows

_MIX = 0x9E3779B97F4A7C15
_BLOCK = 8


def anchors(raw: bytes, window: int, gram: int, length: int):
    """(places, first, last): the anchors of a text and the windows (their starts) that each stands for.

    A window of ``length`` bytes belongs to the leftmost smallest gram among its first
    ``window`` grams.  The starts of one anchor are neighbours.  Anchors of the text's end,
    where no whole window starts, count too: phrases end at them.  Texts shorter than
    ``length`` have none.
    """
    import numpy as np

    n = len(raw)
    if n < length:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    places, firsts, lasts = [], [], []
    starts, step = n - window - gram + 2, 1 << 18
    # long texts go block by block; a block's windows look ``window`` grams ahead
    for s in range(0, starts, step):
        stop = min(starts, s + step)
        data = np.frombuffer(raw, dtype=np.uint8, count=stop - s + window + gram - 2, offset=s)
        words = np.lib.stride_tricks.sliding_window_view(data, 8)
        words = np.ascontiguousarray(words).view("<u8").ravel()
        grams = stop - s + window - 1
        h = words[:grams] * np.uint64(_MIX)
        h ^= h >> np.uint64(29)
        h += words[gram - 8:gram - 8 + grams]
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # the low bits give way to the place, so the smallest is unique and leftmost on ties
        key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(grams, dtype=np.uint64)
        least, span = key, 1
        while span < window:
            move = min(span, window - span)
            least = np.minimum(least[:-move], least[move:])
            span += move
        at = (least[:stop - s] & np.uint64((1 << 20) - 1)).astype(np.int64) + s
        turn = np.flatnonzero(np.diff(at)) + 1
        places.append(at[np.r_[0, turn]])
        firsts.append(np.r_[0, turn] + s)
        lasts.append(np.r_[turn - 1, stop - s - 1] + s)
    at, first, last = (np.concatenate(x) for x in (places, firsts, lasts))
    if len(places) > 1:  # an anchor on both sides of a block's edge
        new = np.r_[True, at[1:] != at[:-1]]
        return at[new], first[new], last[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
    return at, first, last


def _sizes(length: int) -> tuple[int, int, int]:
    """(window, gram, phrases): two equal substrings share at least this many whole phrases."""
    window, gram = max(2, length * 8 // 25), max(8, min(16, length // 8))
    shared = length - gram - 2 * window + 2
    return window, gram, max(1, -(-shared // window))


def phrases(src: DataFrame, length: int) -> DataFrame:
    """(rid, idx, at, rank): each anchor with the name of the text up to the next one."""
    window, gram, _ = _sizes(length)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            for start in range(0, b.num_rows, 256):
                rids, idx, places, ranks = [], [], [], []
                for rid, raw in text_rows(b.slice(start, 256), "rid", "text"):
                    at, _, _ = anchors(raw or b"", window, gram, length)
                    if not len(at):
                        continue
                    cuts = [*at.tolist(), len(raw)]
                    rids.append(np.full(len(at), rid))
                    idx.append(np.arange(len(at), dtype=np.int32))
                    places.append(at.astype(np.int32))
                    ranks += [digest(raw[s:e]) for s, e in zip(cuts, cuts[1:], strict=False)]
                if rids:
                    yield pa.record_batch([pa.array(np.concatenate(rids)), pa.array(np.concatenate(idx)), pa.array(np.concatenate(places)),
                                           pa.array(np.array(ranks, dtype=np.uint64).view(np.int64))], names=["rid", "idx", "at", "rank"])

    return src.select("rid", "text").mapInArrow(run, "rid long, idx int, at int, rank long")


def double(ranked: DataFrame, spans: int) -> DataFrame:
    """(rid, at): the anchors whose first ``spans`` phrases occur elsewhere too, at least (rounded down to a power of two)."""
    offset = 1
    while True:
        # written first: the join then reads a plain shuffle on both sides, and a hot rank can be split
        again = materialize(ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rank"), "repeated-ranks")
        ranked = materialize(ranked.join(again, "rank", "left_semi").select("rid", "idx", "at", "rank"), "ranked")
        if 2 * offset > spans:
            return ranked.select("rid", "at")
        further = ranked.select("rid", (F.col("idx") - offset).alias("idx"), F.col("rank").alias("next"))
        ranked = materialize(ranked.join(further, ["rid", "idx"]).select("rid", "idx", "at", F.xxhash64("rank", "next").alias("rank")), "ranked")
        offset *= 2


def _blocks(raw: bytes, base: int, at: int, first: int, last: int, size: int, length: int):
    """Blocks of windows [first, last] of the anchor: (first start, last start, core digest, union digest).

    Blocks are aligned to the distance before the anchor, so equal windows fall into equal
    blocks; the core is that of the whole aligned block whatever part of it the anchor has.
    ``raw`` begins at ``base``.
    """
    import xxhash

    lo, hi = at - last, at - first
    for block in range(lo // size, hi // size + 1):
        far, close = min(hi, block * size + size - 1), max(lo, block * size)
        core = raw[at - block * size - base:at - (block * size + size - 1) + length - base] if block else raw[at - base:at - size + 1 + length - base]
        union = raw[at - far - base:at - close + length - base]
        yield at - far, at - close, xxhash.xxh3_64_intdigest(core + b"%d" % block) - (1 << 63), xxhash.xxh3_128_digest(union + b"%d:%d" % (far, close))


_NODE = "rid long, at int, first int, last int, core long, whole binary, done boolean"


def _nodes(rows: list, pa):
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.bool_())
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["rid", "at", "first", "last", "core", "whole", "done"])


def _settle(nodes: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(intervals, open): repeated blocks as byte intervals, and the blocks to cut further.

    ``done`` nodes stand for text that is settled already and only serve as partners.  One
    node of each union goes on, in cores that hold an unsettled union beside another one.
    """
    unions = nodes.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("n"), F.max("done").alias("known"),
                                                 F.min(F.struct("rid", "at", "first", "last")).alias("one"))
    unions = materialize(unions.withColumn("settled", F.col("known") | (F.col("n") > 1)), "unions")
    repeated = nodes.where("not done").join(unions.where("n > 1").select("core", "whole"), ["core", "whole"], "left_semi")
    intervals = materialize(repeated.select("rid", "first", (F.col("last") + length).alias("end")), "intervals")
    mixed = unions.groupBy("core").agg(F.count(F.lit(1)).alias("c"), F.bool_and("settled").alias("all")).where("c > 1 and not all").select("core")
    further = unions.join(mixed, "core", "left_semi").select("one.*", F.col("settled").alias("done"))
    return intervals, materialize(further, "open")


def _level(with_text: DataFrame, size: int, length: int) -> DataFrame:
    """The nodes of ``size`` windows for (text, list of places with their windows)."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for rid, base, raw, todo in text_rows(b, "rid", "base", "text", "todo"):
                for x in todo:
                    rows += [(rid, x["at"], s, e, core, whole, x["done"])
                             for s, e, core, whole in _blocks(raw, base, x["at"], x["first"], x["last"], size, length)]
                if len(rows) > 50_000:
                    yield _nodes(rows, pa)
                    rows = []
            yield _nodes(rows, pa)

    return with_text.select("rid", "base", "text", "todo").mapInArrow(run, _NODE)


def _contexts(texts: DataFrame, open_nodes: DataFrame, length: int) -> DataFrame:
    """(rid, base, text, todo) of open nodes, each with only the bytes around its windows."""
    todo = open_nodes.groupBy("rid").agg(F.collect_list(F.struct("at", "first", "last", "done")).alias("todo"))
    cut = texts.select("rid", "text").join(todo, "rid").select("rid", "text", F.explode("todo").alias("x"))
    # a core may begin a block's width before the first window
    base = F.greatest(F.lit(0), F.col("x.first") - _BLOCK)
    bytes_ = F.expr(f"substring(text, greatest(0, x.first - {_BLOCK}) + 1, x.last + {length + _BLOCK} - greatest(0, x.first - {_BLOCK}))")
    return materialize(cut.select("rid", base.alias("base"), bytes_.alias("text"), F.array("x").alias("todo")), "contexts")


def repeated_intervals(src: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(intervals, texts) of ``src`` (rid, text as binary): bytes [first, end) covered by repeated windows; texts that may hold some."""
    window, gram, spans = _sizes(length)
    kept = double(materialize(phrases(src, length), "phrases"), spans)
    places = kept.groupBy("rid").agg(F.collect_list("at").alias("places"))
    texts = materialize(src.join(places, "rid").select("rid", "text", "places"), "candidates")

    def whole(batches):
        import pyarrow as pa

        for b in batches:
            for part in (b.slice(i, 64) for i in range(0, b.num_rows, 64)):
                rows = []
                for rid, raw, wanted in text_rows(part, "rid", "text", "places"):
                    alive = set(wanted)
                    for at, first, last in zip(*(x.tolist() for x in anchors(raw, window, gram, length)), strict=True):
                        last = min(last, len(raw) - length)
                        if at in alive and first <= last:
                            rows += [(rid, at, s, e, core, union, False) for s, e, core, union in _blocks(raw, 0, at, first, last, window, length)]
                yield _nodes(rows, pa)

    found, open_nodes = _settle(materialize(texts.mapInArrow(whole, _NODE), "nodes"), length)
    near = _contexts(texts, open_nodes, length)
    more, open_nodes = _settle(materialize(_level(near, _BLOCK, length), "nodes"), length)
    around = near.select("rid", "base", "text", F.col("todo")[0]["at"].alias("at"))
    single = open_nodes.join(around, ["rid", "at"]).select("rid", "base", "text", F.array(F.struct("at", "first", "last", "done")).alias("todo"))
    last, _ = _settle(materialize(_level(single, 1, length), "nodes"), length)
    return found.unionAll(more).unionAll(last), texts


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """(rid, doc_id, n_bytes, n_removed, n_spans, kept_sha256): one row per input row.

    Every byte covered by a ``length``-byte string that also starts anywhere else, in any
    row or the same one (overlaps count), is removed; rows are not joined together.  Null
    and short texts lose nothing.  Repeated rows remove each other wholly.  n_spans counts
    maximal removed runs.  An empty table gives no rows.
    """
    src = numbered(docs, "doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    intervals, texts = repeated_intervals(src.select("rid", "text"), length)
    runs = intervals.groupBy("rid").agg(F.collect_list(F.struct("first", "end")).alias("runs"))

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for rid, raw, found in text_rows(b, "rid", "text", "runs"):
                digest, at, removed, spans = hashlib.sha256(), 0, 0, 0
                for s, e in sorted((x["first"], x["end"]) for x in found):
                    if s > at or not spans:
                        digest.update(raw[at:s])
                        spans += 1
                    removed += max(0, e - max(s, at))
                    at = max(at, e)
                digest.update(raw[at:])
                out.append((rid, removed, spans, digest.hexdigest()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["rid", "n_removed", "n_spans", "sha"])

    cutting = texts.select("rid", "text").join(runs, "rid").select("rid", "text", "runs")
    done = cutting.mapInArrow(cut, "rid long, n_removed long, n_spans long, sha string")
    zero = F.lit(0).cast("long")
    base = src.select("rid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    return base.join(done, "rid", "left").select("rid", "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                                                  F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))
