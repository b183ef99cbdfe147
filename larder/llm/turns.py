"""The prefix trie of conversations, with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns, known by its depth and two 64-bit digests of its
turns; its members are the conversations that begin with it.  Chains of nodes with the same
members are one chain of the tree of chains, which has less than two chains per conversation.

Totals over subtrees go up that tree by centroids, so that the number of rounds follows the
logarithm of its size whatever its depth.  A component is cut at the deepest chain that holds at
least half of its weight, the conversations that end in it: every part below the cut and the part
above it have half of the weight at most.  The total below the cut is added to the chains on the
way from it to the component's top, and the parts are cut in turn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import materialize
from larder.llm.scans import joined_sha256
from larder.plans.scans import running

WORD = r"[^\x20\x09-\x0D]+"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, at, a, b, words): the turns by their place in the conversation, from 0.

    Turns are ordered by turn (null first), ties by role and text; null role and text are empty.
    a and b are digests of (role, text), words the number of ``WORD`` in the text.  Rows without
    a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"), F.lit(1).cast("long").alias("one"))
    placed = running(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], {"place": (F.sum, "one")}, "turns")
    return materialize(placed.select("conv", (F.col("place") - 1).alias("at"), F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("turn"), "text", "role").alias("b"),
                                     F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), "turns-placed")


def rebuilt(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (conv, at, a, b, words), and (conv, size) of all of them.

    Conversation c takes the first h turns of conversation c - c % ``family`` (all if it has
    fewer, none if it is absent), then its own after its first h; h = crc32(decimal c) % ``heads``.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    base = sizes.select(F.col("conv").alias("base"), F.col("own").alias("base_size"))
    plan = sizes.select("conv", "own", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base")).join(base, "base", "left")
    plan = materialize(plan.withColumn("lead", F.least("h", F.coalesce("base_size", F.lit(0)))), "rebuild-plan")
    first = turns.where(F.col("at") < heads).withColumnRenamed("conv", "base")
    taken = plan.select("conv", "base", "lead").join(first, "base").where("at < lead").select("conv", "at", "a", "b", "words")
    own = turns.join(plan.select("conv", "h", "lead"), "conv").where("at >= h").select("conv", (F.col("at") - F.col("h") + F.col("lead")).alias("at"), "a", "b", "words")
    return taken.union(own), plan.select("conv", (F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, x, y, px, py, words): every prefix of one turn and more, by the digests of itself and of the next shorter one.

    The digests are exclusive ors of digests of (place, turn), so they need no order to be summed.
    """
    rows = materialize(turns.select("conv", "at", F.xxhash64("at", "a", "b").alias("tx"), F.xxhash64(F.lit("place"), "b", "at", "a").alias("ty"), "words"), "rebuilt-turns")
    found = running(rows, ["conv"], [F.col("at")], {"x": (F.bit_xor, "tx"), "y": (F.bit_xor, "ty")}, "prefix-digests")
    return found.select("conv", (F.col("at") + 1).alias("depth"), "x", "y", F.col("x").bitwiseXOR(F.col("tx")).alias("px"), F.col("y").bitwiseXOR(F.col("ty")).alias("py"), "words")


NODE = ["depth", "x", "y"]


def trie_nodes(paths: DataFrame) -> DataFrame:
    """The distinct prefixes of ``paths`` (rows of ``prefixes``, and a row of depth 0 for each conversation).

    conv is the smallest member, n the number of members, saved = (n - 1) * words; parent_conv
    and parent_n are the parent's, children the number of child nodes.
    """
    nodes = materialize(paths.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.max("px").alias("px"), F.max("py").alias("py"), F.max("words").alias("words")), "trie-nodes")
    parent = nodes.select((F.col("depth") + 1).alias("d"), F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv").alias("parent_conv"), F.col("n").alias("parent_n"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("cd"), F.col("px").alias("cx"), F.col("py").alias("cy")).agg(F.count(F.lit(1)).alias("children"))
    out = nodes.join(parent, (F.col("depth") == F.col("d")) & (F.col("px") == F.col("ux")) & (F.col("py") == F.col("uy")), "left")
    out = out.join(children, (F.col("depth") == F.col("cd")) & (F.col("x") == F.col("cx")) & (F.col("y") == F.col("cy")), "left")
    return materialize(out.select(*NODE, "conv", "n", ((F.col("n") - 1) * F.col("words")).alias("saved"), "parent_conv", "parent_n",
                                  F.coalesce("children", F.lit(0)).alias("children")), "trie-nodes")


def chains(nodes: DataFrame) -> DataFrame:
    """(id, pid, conv, n, top, saved, leaves): runs of nodes with the same members, by their smallest member and their number."""
    starts = F.col("parent_n").isNull() | (F.col("parent_n") != F.col("n"))
    rows = nodes.groupBy("conv", "n").agg(F.min("depth").alias("top"), F.sum("saved").alias("saved"), F.max(F.when(F.col("children") == 0, 1).otherwise(0)).cast("long").alias("leaves"),
                                          F.max(F.when(starts, F.col("parent_conv"))).alias("pc"), F.max(F.when(starts, F.col("parent_n"))).alias("pn"))
    rows = materialize(rows.withColumn("id", F.monotonically_increasing_id()), "chain-ids")
    up = rows.select(F.col("id").alias("pid"), F.col("conv").alias("uc"), F.col("n").alias("un"))
    joined = rows.join(up, (F.col("pc") == F.col("uc")) & (F.col("pn") == F.col("un")), "left")
    return materialize(joined.select("id", "pid", "conv", "n", "top", "saved", "leaves"), "chains")


def passages(paths: DataFrame, nodes: DataFrame, tree: DataFrame) -> DataFrame:
    """(c, id, pid): the chains that each smallest member c of a chain passes, and the chain above each."""
    starts = nodes.where(F.col("parent_n").isNull() | (F.col("parent_n") != F.col("n"))).select(*NODE, F.col("conv").alias("lead"), "n")
    leaders = tree.select("conv").distinct()
    through = paths.join(leaders, "conv", "left_semi").select(F.col("conv").alias("c"), *NODE).join(starts, NODE)
    ids = tree.select("id", "pid", F.col("conv").alias("lead"), "n")
    return materialize(through.join(ids, ["lead", "n"]).select("c", "id", "pid"), "chain-passages")


def rolled_up(tree: DataFrame, through: DataFrame) -> DataFrame:
    """(id, saved, leaves): totals over the subtree of every chain, its own included.

    A round cuts every component once.  With v a chain and g the cut of its component: v lies
    below g if v's smallest member passes g and goes on, and then belongs to the part of the
    chain that follows; v lies on the way from g to the top if g's smallest member passes v.
    """
    nodes = materialize(tree.select("id", "conv", "top", F.col("n").alias("weight"), "saved", "leaves", F.lit(-1).cast("long").alias("part")), "centroid-start")
    onward = through.select(F.col("c").alias("oc"), F.col("pid").alias("of"), F.col("id").alias("follows"))
    passed = through.select(F.col("c").alias("pc"), F.col("id").alias("passed"))
    rounds = []
    while not nodes.isEmpty():
        whole = nodes.groupBy("part").agg(F.max("weight").alias("whole"))
        heavy = nodes.join(whole, "part").where("2 * weight >= whole")
        g = F.max_by(F.struct(F.col("id").alias("g"), F.col("conv").alias("gc"), F.col("top").alias("gt"), F.col("weight").alias("gw")), F.struct("top", "id"))
        cuts = heavy.groupBy("part").agg(g.alias("s")).select("part", "s.*")
        rows = (nodes.join(cuts, "part")
                .join(onward, (F.col("conv") == F.col("oc")) & (F.col("g") == F.col("of")) & (F.col("top") > F.col("gt")), "left")
                .join(passed, (F.col("gc") == F.col("pc")) & (F.col("id") == F.col("passed")) & (F.col("top") < F.col("gt")), "left"))
        where = F.when(F.col("id") == F.col("g"), "cut").when(F.col("follows").isNotNull(), "below").when(F.col("passed").isNotNull(), "above").otherwise("aside")
        rows = materialize(rows.select("id", "conv", "top", "saved", "leaves", F.col("part").alias("was"), where.alias("place"), F.coalesce("follows", "part").alias("part"),
                                       F.when(F.col("passed").isNotNull(), F.col("weight") - F.col("gw")).otherwise(F.col("weight")).alias("weight")), "centroid-round")
        rounds.append(rows)
        nodes = rows.where("place <> 'cut'").select("id", "conv", "top", "weight", "saved", "leaves", "part")
    added = [tree.select("id", "saved", "leaves")]
    for rows in rounds:
        sums = rows.where("place in ('cut', 'below')").groupBy("was").agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
        own = lambda c: F.when(F.col("place") == "cut", F.col(c)).otherwise(F.lit(0))
        added.append(rows.where("place in ('cut', 'above')").join(sums, "was").select("id", (F.col("s") - own("saved")).alias("saved"), (F.col("l") - own("leaves")).alias("leaves")))
    return reduce(DataFrame.union, added).groupBy("id").agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("all_leaves"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (``rebuilt``); all columns but the last are longs.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    conv_id is the smallest member; the root has depth 0 and a null parent; n_leaves and
    saved_tokens are totals over the subtree, the node's own included; ends_sha256 is that of
    the conv_ids that end at the node, ascending, joined by commas.

    Repeated turns count as turns; rows without a conv_id are left out; conversations without
    turns end at the root; further columns are not read.  An empty table has no root, so no rows.
    """
    turns, sizes = rebuilt(ordered_turns(conversations))
    zero = F.lit(0).cast("long")
    paths = materialize(prefixes(turns).join(sizes, "conv").select("*", (F.col("depth") == F.col("size")).alias("last")).drop("size")
                        .unionByName(sizes.select("conv", *(zero.alias(c) for c in (*NODE, "px", "py", "words")), (F.col("size") == 0).alias("last"))), "trie-paths")
    nodes = trie_nodes(paths)
    tree = chains(nodes)
    totals = rolled_up(tree, passages(paths, nodes, tree))
    totals = tree.join(totals, "id").select(F.col("conv").alias("tc"), F.col("n").alias("tn"), "all_saved", "all_leaves")
    ends = joined_sha256(materialize(paths.where("last").select(*NODE, "conv"), "trie-ends"), NODE, "conv")
    rows = running(nodes, ["conv", "n"], [F.col("depth")], {"upto": (F.sum, "saved")}, "chain-sums")
    rows = rows.join(totals, (F.col("conv") == F.col("tc")) & (F.col("n") == F.col("tn"))).join(ends, NODE, "left")
    return rows.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                       F.col("all_leaves").alias("n_leaves"), (F.col("all_saved") - F.col("upto") + F.col("saved")).alias("saved_tokens"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
