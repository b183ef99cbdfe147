"""Spelling variants against brute force over all pairs of words."""

import random
import zlib
from collections import Counter

import pytest
import regex

from larder.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in regex.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def brute(words, ratio=10):
    form, out = {}, []
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
        out.append((w, len(others)))
    rows = []
    for w, k in out:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, words[w], k, None if form[w] is None else words[form[w]]))
    return sorted(rows)


def found(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    """Few letters, so that words have many near ones, runs of equal letters and words inside words; also long ones."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé" if seed == 1 else "abcdefÿ") for _ in range(rng.randint(1 if seed == 1 else 7, 9))): rng.choice((1, 2, 30, 500, 9000)) for _ in range(500)}
    long = "".join(rng.choice("abcz") for _ in range(3000))
    for k in (0, 1, 1499, 1500, 1501, 2999):
        words[long[:k] + long[k + 1:]] = 2
        words[long[:k] + "é" + long[k + 1:]] = 3
    words |= {long: 40, "a" * 3000: 50, "a" * 2999: 3, "a" * 2998: 1, "b" + "a" * 2999: 1}
    df = spark.createDataFrame(list(words.items()), "word string, n int").repartition(3)
    assert found(spelling.spelling_forms(df)) == brute(words)


def test_documents(edge_docs, make_docs, edge_texts):
    got = spelling.spelling_forms(spelling.word_counts(edge_docs))
    assert found(got) == brute(counts([(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]))
    rng = random.Random(9)
    base = ["wonderful", "wonderfull", "wonderfully", "Éternellement", "ÉTERNELLEMENT", "straßenbahn", "strasenbahn", "unbroken" * 300]
    rows = [(k, " ".join(rng.choices(base, (90, 4, 2, 60, 30, 50, 3, 9), k=60)) + " x1y2z漢字wonderful", "s") for k in range(80)] + [(None, " ".join(base), None)] * 2
    docs = make_docs(rows)
    want = brute(counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert found(spelling.spelling_forms(spelling.word_counts(docs))) == want
    assert any(r[1] for r in want) and any(r[4] for r in want)


def test_empty(no_docs):
    out = spelling.spelling_forms(spelling.word_counts(no_docs))
    assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
