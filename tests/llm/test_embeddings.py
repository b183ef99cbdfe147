import math
import random

from larder.llm.embeddings import near_vectors, tables_for


def make(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, rid string, n int")


def brute(rows):
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    near = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            (a, la), (b, lb) = rows[i][1:], rows[j][1:]
            if la == lb and usable(a, la) and usable(b, lb) and len(a) == len(b):
                dot = sum(x * y for x, y in zip(a, b, strict=True))
                if dot / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b)) >= 0.93:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((str(rows[i][0]), len(near[i]), component, rows[i][0] == component))
    return sorted(out, key=str)


def test_clusters_and_odd_vectors(spark):
    rng = random.Random(2)
    rows, k = [], 0
    for _ in range(25):
        centre = [rng.gauss(0, 1) for _ in range(16)]
        for _ in range(rng.randint(1, 12)):
            spread, scale = rng.choice([0, 0.02, 0.1, 0.2]), rng.choice([1, 1, 40])
            rows.append((500 - k, [float(round(scale * (c + rng.gauss(0, spread)) * 64) / 64) for c in centre], rng.choice([1, 1, 2, None])))
            k += 1
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [float("nan")] + [1.0] * 15, 1), (1004, [float("inf")] + [1.0] * 15, 1),
             (1005, [None] + [1.0] * 15, 1), (1006, [1.0, 2.0], 1), (1007, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, [3.0, -1.0], 1), (1006, [1.0, 2.0], 1)]
    got = sorted(((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in near_vectors(make(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert near_vectors(make(spark, [])).count() == 0


def test_tables_follow_the_rows():
    assert tables_for(100, 0.93, 2.0, 0.999)[0] < tables_for(10**6, 0.93, 2.0, 0.999)[0]
