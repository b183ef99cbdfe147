"""The prefix trie against a brute-force trie of tuples."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from larder.llm import scans, turns
from larder.plans.scans import running

CONVERSATIONS = "conv_id long, turn long, role string, text string, n long, depth string, x double"


def rebuilt(rows):
    talks = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            talks[c].append((t is not None, t or 0, r or "", x or ""))
    talks = {c: [v[2:] for v in sorted(t)] for c, t in talks.items()}
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = talks.get(base, [])[:h] + own[h:]
    return out


def brute(rows):
    talks = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(talks):
        for d in range(len(talks[c]) + 1):
            members[tuple(talks[c][:d])].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        tokens = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += tokens
            leaves[p[:d]] += p not in children
    ends = defaultdict(list)
    for c in sorted(talks):
        ends[tuple(talks[c])].append(str(c))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(ends[p]).encode()).hexdigest()) for p, m in members.items())


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def talk(rng, c, size, words="a b", roles=("user", "bot")):
    return [(c, t, roles[t % 2], rng.choice(words.split())) for t in range(size)]


def shapes(name):
    rng = random.Random(name)
    if name == "bushy":
        rows = [r for c in range(-30, 90) for r in talk(rng, c, rng.randint(1, 7), "a b c")]
    elif name == "spine":  # one long conversation that others leave at every depth
        rows = [(c, t, "u", "w " * (t % 3) if t < 3 * c or c == 0 else f"x{c}") for c in range(0, 800, 20) for t in range(min(3 * c // 20 + 2, 120))]
    elif name == "copies":
        rows = [(c, t, "u", f"t{t} w") for c in range(150) for t in range(5)]
    else:  # odd rows
        rows = [(1, None, None, None), (1, None, "u", ""), (1, 1, "u", "b"), (1, 1, "u", "b"), (1, 1, "u", "a"), (None, 0, "u", "x"), (3, 0, "u", "x"), (23, 5, "u", "x"),
                (25, 0, None, "long " * 50_000), (20, 0, "u", ""), (20, 1, "u", "hello"), (21, 0, "", "z"), (-3, 0, "u", "q"), (-41, 0, "u", "y")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("name", ["bushy", "spine", "copies", "odd"])
def test_shapes(spark, name, tmp_path):
    rows = shapes(name)
    spark.createDataFrame([(*r, 1, "d", 0.5) for r in rows], CONVERSATIONS).repartition(3).write.parquet(str(tmp_path / "t"))
    want = brute(rows)
    out = turns.prefix_trie(spark.read.parquet(str(tmp_path / "t")))
    assert found(out) == want
    assert dict(out.dtypes) == {c: "bigint" for c in out.columns[:-1]} | {"ends_sha256": "string"}


def test_empty(spark, tmp_path):
    spark.createDataFrame([], CONVERSATIONS).write.parquet(str(tmp_path / "t"))
    assert turns.prefix_trie(spark.read.parquet(str(tmp_path / "t"))).count() == 0


def test_rounds_follow_the_logarithm(spark, monkeypatch):
    """A path of chains: as many as a tree of that depth has, in few rounds."""
    n = 300
    tree = spark.createDataFrame([(k, k - 1 if k else None, 0, n - k, k, 1, int(k == n - 1)) for k in range(n)], "id long, pid long, conv long, n long, top long, saved long, leaves long")
    through = tree.select(F.col("conv").alias("c"), "id", "pid")
    rounds, write = [], turns.materialize
    monkeypatch.setattr(turns, "materialize", lambda df, name: rounds.append(name) or write(df, name))
    got = {r.id: (r.all_saved, r.all_leaves) for r in turns.rolled_up(tree, through).collect()}
    assert got == {k: (n - k, 1) for k in range(n)}
    assert len(rounds) <= 12


def test_running_and_digests(spark, tmp_path):
    """One group of most rows, over many partitions."""
    rng = random.Random(1)
    rows = [(rng.choice(("hot", "hot", "hot", "a", None)), k, rng.randint(-5, 5)) for k in range(3000)]
    spark.createDataFrame(rows, "g string, k long, v long").repartition(5).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    sums, want = Counter(), {}
    for g, k, v in rows:
        sums[g] += v
        want[k] = (g, v, sums[g])
    got = {r.k: (r.g, r.v, r.s) for r in running(table, ["g"], [F.col("k")], {"s": (F.sum, "v")}, "t").collect()}
    assert got == want
    whole = {g: ",".join(str(k) for x, k, _ in rows if x == g) for g in ("hot", "a")}
    got = {r.g: r.sha256 for r in scans.joined_sha256(table.where("g is not null"), ["g"], "k", at_once=7).collect()}
    assert got == {g: hashlib.sha256(t.encode()).hexdigest() for g, t in whole.items()}
