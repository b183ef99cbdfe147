"""The pipeline's stages, each on its predecessor's rows."""

from collections import Counter

import corpus_pipeline
from larder.llm.decontaminate import contamination
from larder.llm.pii import find_spans
from larder.llm.simhash import simhash_groups
from larder.llm.toxicity import toxicity

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    kept, tables = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, SF).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        tables.append(kept)
    ids = [{r.doc_id for r in t.select("doc_id").collect()} for t in tables]
    assert all(t.columns == corpus_pipeline.COLUMNS and t.dtypes == docs.dtypes for t in tables[:-1])
    assert ids[0] == {r.doc_id for r in toxicity(docs, labels).where("predicted = 0").collect()}
    assert ids[1] == {r.doc_id for r in simhash_groups(tables[0]).where("doc_id = component_id").collect()}
    assert ids[2] == {r.doc_id for r in contamination(tables[1], benchmark).where("not contaminated").collect()}
    assert ids[3] == ids[2] and ids[4] <= ids[3]
    for r in tables[3].select("text", "n_chars").collect():
        assert not find_spans(r.text or "") and r.n_chars == len(r.text or "")
    final = tables[4].toPandas()
    sizes = {r.doc_id: len((r.text or "").split()) for r in tables[3].collect()}
    for _, rows in final.groupby("source"):
        assert abs(rows.taken.sum() - rows.target.iloc[0]) < 1
        assert (rows.groupby("doc_id").taken.sum() <= 2 * rows.groupby("doc_id")["size"].first()).all()
    assert all(r["size"] == sizes[r.doc_id] and len(r.text.split()) == r.taken for r in tables[4].collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows(spark, edge_docs, no_docs, tmp_path):
    for k, docs in enumerate((edge_docs, no_docs)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, kept, "/root/testdata/sf0.001").write.parquet(str(tmp_path / f"{k}-{name}"))
            kept = spark.read.parquet(str(tmp_path / f"{k}-{name}"))
        rows = kept.collect()
        assert {str(r.doc_id) for r in rows} <= {str(r.doc_id) for r in docs.select("doc_id").collect()}
        assert all(0 <= r.word_from < r.word_to <= r["size"] and r.taken == r.word_to - r.word_from for r in rows)
        taken, goal = Counter(), {}
        for r in rows:
            taken[r.source] += r.taken
            goal[r.source] = r.target
        assert bool(rows) == bool(docs.count()) and all(abs(taken[s] - goal[s]) < 1 for s in goal)


def test_mixing_takes_effect(spark, make_docs):
    """The output has the target words of each source in slot order, and no others."""
    rows = [(k, "\n" + "  ".join(f"h{k}_{i}" for i in range(40)) + " ", "hot") for k in range(600)]
    rows += [(1000 + k, " ".join(f"c{k}_{i}" for i in range(70)), "cold") for k in range(40)] + [(5000, None, "cold"), (5001, " ", "hot")]
    docs = make_docs(rows)
    got = sorted(corpus_pipeline.mixing_stage(spark, docs, "").collect(), key=lambda r: (r.slot, r.position))
    assert {r.doc_id for r in got} < {r[0] for r in rows}
    texts = {r[0]: r[1] or "" for r in rows}
    words = {"hot": [], "cold": []}
    for r in got:
        assert r.text.split() == texts[r.doc_id].split()[r.word_from:r.word_to] and r.n_chars == len(r.text) and r.text in texts[r.doc_id]
        words[r.source] += r.text.split()
    target = {r.source: r.target for r in got}
    assert all(abs(len(words[s]) - target[s]) < 1 for s in target)
    # a source below its size repeats no word, one above it starts over
    rare = {s: len(set(w)) for s, w in words.items()}
    for s, n in (("hot", 24_000), ("cold", 2800)):
        assert rare[s] == min(n, len(words[s]))
