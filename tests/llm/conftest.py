import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid string, at int, score double, target string, size int"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_texts():
    """Texts with every awkward case: null, empty, blank, copies, near copies, shared passages, one very long."""
    rng = random.Random(3)
    base, shared = prose(rng, 300), prose(rng, 120)
    near = base.split()
    near[150] = "changed"
    texts = [None, "", "  \n\t ", "one", "two words", base, base, " ".join(near), base.upper(), "a " * 900, "ab" * 700,
             prose(rng, 40) + " " + shared + " " + prose(rng, 60), shared + " " + prose(rng, 30), prose(rng, 20_000) + " " + shared]
    return texts + [prose(rng, rng.randint(0, 200)) for _ in range(30)]


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """Rows written and read back; columns beyond those of documents have clashing names."""
    def make(rows):
        path = str(tmp_path_factory.mktemp("docs") / "t")
        full = [(i, t, "en", s, len(t or ""), "x", 1, 0.5, "y", 7) for i, t, s in rows]
        spark.createDataFrame(full, DOCS).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs, edge_texts):
    """Also a null id, a repeated row, null sources and ids in no order."""
    rows = [(900 - 7 * k, t, [None, "b", "a", "ä", ""][k % 5]) for k, t in enumerate(edge_texts)]
    return make_docs([*rows, (None, "a null id", "a"), (None, edge_texts[5], None), rows[12], rows[12]])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
