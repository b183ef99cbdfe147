from collections import Counter

import pytest

from larder.llm import mixing


def targets(sizes, share=1.5, most=2.0):
    """Reshare by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / max(1e-12, sum(weight[s] for s in free)) if free else 0
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return {**capped, **{s: level * weight[s] for s in free}}
        capped.update((s, most * sizes[s]) for s in over)


def check(docs, **options):
    rows = mixing.mix(docs, **options).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    want = targets(sizes) if sizes else {}
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
    assert all(taken[s] == pytest.approx(want[s], abs=0.51) for s in sizes)
    return sorted((str(r.doc_id), r["size"], r.taken) for r in rows)


def test_edge_documents(edge_docs):
    first = check(edge_docs, block_words=64)
    assert first == check(edge_docs, block_words=64)
    check(edge_docs)


def test_hot_source_and_tiny_sources(make_docs):
    rows = [(k, "w " * (k % 50), "hot") for k in range(400)] + [(1000 + k, "v " * k, f"s{k}") for k in range(25)] + [(1, "x", None)]
    check(make_docs(rows), block_words=16)


def test_no_words(make_docs, no_docs):
    assert check(make_docs([(1, "", "a"), (2, None, None)])) == [("1", 0, 0), ("2", 0, 0)]
    assert check(no_docs) == []


def test_schedule_keeps_weights_on_every_stretch(spark):
    goals = spark.createDataFrame([("a", 40_000, 50_000.0), ("b", 30_000, 25_000.0), ("c", 90_000, 25_000.0), (None, 10, 1.0), ("z", 0, 0.0)],
                                  "source string, source_size long, target double")
    slots = sorted((r.slot, r.source, r.block, r.words) for r in mixing.schedule(goals, block_words=100, chunk=32).collect())
    assert Counter(s for _, s, _, _ in slots) == {"a": 500, "b": 250, "c": 250, None: 1}
    for at in range(0, 900, 100):
        part = Counter(s for _, s, _, _ in slots[at:at + 100])
        assert abs(part["a"] - 50) <= 4 and abs(part["b"] - 25) <= 4
    blocks = [b for _, s, b, _ in slots if s == "a"]
    assert blocks == [*range(400), *range(100)]


@pytest.mark.parametrize("block_words", [16, 4096])
def test_mixture_is_the_schedule_with_its_words(make_docs, block_words):
    rows = [(k, "w " * (k % 50), "hot") for k in range(200)] + [(1000 + k, "v " * k, f"s{k}") for k in range(12)] + [(1, "x", None)]
    docs = make_docs(rows)
    sized, goals, mixed = mixing.planned(docs, block_words)
    got = sorted(mixed.collect(), key=lambda r: (r.slot, r.position))
    slots = {r.slot: r for r in mixing.schedule(goals, block_words).collect()}
    placed = {r.rid: r for r in mixing.offsets(sized).collect()}
    filled = Counter()
    for r in got:
        # the pieces of a slot are its block's words, one after another
        slot, row = slots[r.slot], placed[r.rid]
        assert r.position == filled[r.slot] and r.source == slot.source == row.source and r.doc_id == row.doc_id
        assert row["first"] + r.word_from == slot.block * block_words + r.position and 0 <= r.word_from < r.word_to <= row["size"]
        filled[r.slot] += r.word_to - r.word_from
    assert filled == {k: s.words for k, s in slots.items()}
    taken = Counter()
    for r in got:
        taken[r.rid] += r.word_to - r.word_from
    assert {r.rid: r.taken for r in mixing.mix(docs, block_words).collect() if r.taken} == taken


def test_native(edge_docs):
    plan = mixing.mix(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
