import random

from larder.llm.components import components


def test_against_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5200)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {n: find(n) for n in parent}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
