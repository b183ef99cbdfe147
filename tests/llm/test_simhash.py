"""SimHash groups against all pairs of brute-force fingerprints."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import simhash


def fingerprint(text, n=3):
    words = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, d):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= d:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_edge_documents(edge_docs):
    rows = edge_docs.select("doc_id", "text").collect()
    prints = [fingerprint(r.text) for r in rows]
    roots = groups(prints, 2)
    least = {}
    for r, root in zip(rows, roots, strict=True):
        if r.doc_id is not None:
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), format(p, "016x"), least.get(root)) for r, p, root in zip(rows, prints, roots, strict=True))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.simhash_groups(edge_docs).collect())
    assert got == want


def test_keep_first_keeps_one_row_of_each_group(edge_docs):
    kept = simhash.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = edge_docs.select("doc_id", "text").collect()
    assert kept.count() == len(set(groups([fingerprint(r.text) for r in rows], 2)))


def test_empty(no_docs):
    assert simhash.simhash_groups(no_docs).count() == 0
    assert simhash.keep_first(no_docs).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_span_the_relation(spark, bits):
    """Crowded balls of fingerprints (hot buckets), chains and far values."""
    rng = random.Random(bits)
    values = {rng.getrandbits(64) for _ in range(60)}
    centre = rng.getrandbits(64)
    values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150 if bits < 3 else 40)}
    at = rng.getrandbits(64)
    for step in range(20):
        at ^= 1 << (3 * step)
        values.add(at)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    limit = 4 if bits < 3 else 16
    found = simhash.links(fps, bits, pair_limit=limit).collect()
    index = {v: k for k, v in enumerate(values)}
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        assert ((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= bits
        parent[find(index[r.a])] = find(index[r.b])
    want = groups([v & ((1 << 64) - 1) for v in values], bits)
    pairs = {(find(i), want[i]) for i in range(len(values))}
    assert len(pairs) == len({p for p, _ in pairs}) == len({w for _, w in pairs})


def test_variants_are_one_shuffle(spark):
    fps = spark.range(100).select(F.col("id").alias("fp"))
    assert simhash.variants(fps, 2).count() == 6400
