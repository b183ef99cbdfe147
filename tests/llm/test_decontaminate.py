import random
import re

from larder.llm.decontaminate import contamination, drop_contaminated
from tests.llm.conftest import prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i:i + n]))):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((str(doc), len(w), len(hit), len(found), ",".join(sorted(str(f) for f in found if f is not None)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def benchmark(spark):
    rng = random.Random(8)
    return [(k, prose(rng, rng.randint(1, 40))) for k in range(12)] + [(3, prose(rng, 20)), (None, prose(rng, 15)), (50, None), (51, "..."), (52, "x y"), (10, "single")]


def check(spark, docs, items, **options):
    bench = spark.createDataFrame([(i, t, "z", 1) for i, t in items], "item_id long, text string, doc_id string, n int")
    got = contamination(docs, bench, **options).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], items)
    return got


def test_planted(spark, make_docs, edge_texts):
    items = benchmark(spark)
    rng = random.Random(4)
    rows = [(k, t, "s") for k, t in enumerate(edge_texts)]
    for k, (_, text) in enumerate(items):
        rows.append((100 + k, f"{prose(rng, 30)} {(text or '').upper()}! {prose(rng, 400 * (k % 2))}", None))
        rows.append((200 + k, f"{prose(rng, 5)}\n{' '.join((text or '').split()[:-1])} {prose(rng, 5)}", "s"))
    long_item = items[0][1] + " " + items[1][1]
    rows += [(300, long_item * 3, "s"), (301, "X  y", "s"), (301, "X  y", "s"), (None, "single", "s")]
    docs = make_docs(rows)
    got = check(spark, docs, items)
    assert sum(r[-1] for r in got) > 10
    assert check(spark, docs, items, block_tokens=7) == got


def test_nothing_to_compare(spark, no_docs, edge_docs):
    items = benchmark(spark)
    assert check(spark, no_docs, items) == []
    assert not any(r[-1] for r in check(spark, edge_docs, []))
    assert not any(r[-1] for r in check(spark, edge_docs, [(1, ""), (2, None)]))


def test_drop_keeps_clean_documents(spark, make_docs):
    rng = random.Random(5)
    text = prose(rng, 30)
    docs = make_docs([(1, text, "a"), (2, prose(rng, 50), "a"), (3, f"{prose(rng, 1000)} {text}", "a"), (None, None, None)])
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"]
