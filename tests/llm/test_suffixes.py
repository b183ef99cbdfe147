import hashlib
from collections import Counter

import numpy as np
import pytest

from larder.llm.suffixes import anchors, remove_repeats


def brute(texts, length):
    windows = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), dtype=bool)
        for s in range(len(t) - length + 1):
            if windows[t[s:s + length]] > 1:
                hit[s:s + length] = True
        kept = np.frombuffer(t, dtype=np.uint8)[~hit].tobytes() if t else b""
        out.append((len(t), int(hit.sum()), int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [400, 60])
def test_against_all_windows(edge_docs, length):
    rows = [(str(r.doc_id), (r.text or "").encode()) for r in edge_docs.select("doc_id", "text").collect()]
    want = sorted((d, *x) for (d, _), x in zip(rows, brute([t for _, t in rows], length), strict=True))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(edge_docs, length).collect())
    assert got == want


def test_boundaries(make_docs):
    """Repeats of exactly the length, one byte less, overlapping themselves, at text ends, of many bytes a character."""
    unit = "".join(chr(200 + (k * k + 3 * k) % 400) for k in range(600))
    rows = [unit[:200], "x" + unit[:200], unit[:199] + "q", unit[1:200] + "r", "y" + unit[300:520] + "z", unit[300:520], "ab" * 300, "é" * 700, "abc" * 40]
    docs = make_docs([(k, t, "s") for k, t in enumerate(rows)])
    for length in (400, 399, 401, 90):
        want = [(k, *x) for k, x in enumerate(brute([t.encode() for t in rows], length))]
        got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs, length).collect())
        assert got == want, length


def test_empty(no_docs):
    assert remove_repeats(no_docs).count() == 0


def test_anchor_blocks_meet():
    raw = np.random.default_rng(1).integers(97, 123, 600_000, dtype=np.uint8).tobytes()
    at, first, last = anchors(raw, 128, 16, 400)
    assert (np.diff(at) > 0).all() and first[0] == 0 and (first[1:] == last[:-1] + 1).all() and last[-1] == len(raw) - 128 - 16 + 1
    cut_at, _, _ = anchors(raw[250_000:270_000], 128, 16, 400)
    inner = [x for x in at.tolist() if 250_200 < x < 269_800]
    assert inner == [x + 250_000 for x in cut_at.tolist() if 200 < x < 19_800]
