"""Quality by Bradley-Terry pairwise ranking.

Of two documents the better one is preferred with probability sigma(s - s'), where s is a
linear score of binned features.  The weights minimise the logistic loss on the feature
differences of preference pairs (a document of label 1 over one of label 0).  The score
quantile at the share of label 0 is the threshold.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.quantiles import exact_quantiles
from larder.llm.common import materialize, text_rows
from larder.llm.labelled import held_out, known_labels, training_rows
from larder.operators.tall import tree_sum
from larder.plans.partitioning import dense_index

_CAPS, _LOWER = re.compile(r"[A-Z]{2}"), re.compile(r"[a-z]")
_MARKED_END = frozenset("#$%&*!@|~^=+<>")
N_FEATURES = 21


def features(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars, words = max(1, len(raw)), text.split()
    n = max(1, len(words))
    seen, lines = Counter(words), [s for s in text.split("\n") if s.strip()]
    letters = int(count[65:91].sum() + count[97:123].sum() + count[192:].sum())
    pairs = len(set(zip(words, words[1:], strict=False)))
    # compressed block by block, so a long text is not favoured for its length
    packed = sum(len(zlib.compress(raw[i:i + 32768], 1)) for i in range(0, len(raw), 32768))
    return [
        math.log1p(len(words)), len(raw) / n, len(seen) / n, max(seen.values(), default=0) / n, pairs / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        sum(w[-1] in _MARKED_END for w in words) / n, sum(_LOWER.search(w) is None and _CAPS.search(w) is not None for w in words) / n,
        int(count[65:91].sum()) / max(1, letters), int(count[48:58].sum()) / chars, int(count[124]) / chars,
        int(count[33]) / chars, int(count[35:39].sum() + count[42] + count[64]) / chars,
        int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()) / chars,
        letters / chars, int(count[10]) / chars, math.log1p(len(lines)), len(set(lines)) / max(1, len(lines)),
        len(words) / max(1, len(lines)), packed / chars, int(count[46]) / n,
    ]


@dataclass
class QualityModel:
    """Bin edges of each feature, a weight for each bin, and the threshold on the raw score."""

    edges: list[np.ndarray]
    weights: np.ndarray
    cut: float
    threshold: float

    def design(self, x: np.ndarray) -> np.ndarray:
        """One 0/1 column for each bin of each feature."""
        out, at = np.zeros((len(x), sum(len(e) + 1 for e in self.edges)), dtype=np.float32), 0
        for j, e in enumerate(self.edges):
            out[np.arange(len(x)), at + np.searchsorted(e, x[:, j], side="right")] = 1
            at += len(e) + 1
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights

    def scores(self, texts) -> np.ndarray:
        return self.scores_of(np.array([features(t or "") for t in texts], dtype=float).reshape(-1, N_FEATURES))

    def scores_of(self, x: np.ndarray) -> np.ndarray:
        level = math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + level, -30, 30)))


def paired(n_good: int, n_bad: int, min_pairs: int) -> tuple[int, int]:
    """(rounds, pairs of a round): in a round every labelled document takes part, the fewer ones in turn.

    Pair i of round r is of good document (r n + i) mod n_good and bad document (r n + i + r) mod
    n_bad, where n is the number of pairs of a round.
    """
    n = max(n_good, n_bad)
    return max(1, -(-min_pairs // n)), n


def newton(sums, n_weights: int, l2: float, steps: int) -> np.ndarray:
    """Weights of the least logistic loss; ``sums(w)`` gives the Hessian over the gradient as one matrix."""
    w = np.zeros(n_weights)
    for _ in range(steps):
        both = sums(w)
        step = np.linalg.solve(both[:-1] + l2 * np.eye(n_weights), both[-1] - l2 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sums(diff: np.ndarray, w: np.ndarray) -> np.ndarray:
    p = 1 / (1 + np.exp(diff @ w))  # the chance that the preference is missed
    return np.vstack([(diff * (p * (1 - p))[:, None].astype(np.float32)).T @ diff, diff.T @ p])


def fit_ranking(x: np.ndarray, y: np.ndarray, threshold: float = 0.3, bins: int = 8, min_pairs: int = 20_000,
                l2: float = 1.0, steps: int = 12) -> QualityModel:
    """``fit_quality`` for features that are arrays: Newton steps on the logistic loss of the preference pairs."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(N_FEATURES)]
    model = QualityModel(edges, np.zeros(sum(len(e) + 1 for e in edges)), 0.0, threshold)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        model.cut = -30.0 if len(good) else 30.0
        return model
    rounds, n = paired(len(good), len(bad), min_pairs)
    at, design = np.arange(rounds * n), model.design(x)
    diff = design[good[at % len(good)]] - design[bad[(at + at // n) % len(bad)]]
    model.weights = newton(lambda w: _sums(diff, w), diff.shape[1], l2, steps)
    model.cut = float(np.quantile(model.raw(x), len(bad) / len(x)))
    return model


def preference_pairs(train: DataFrame, n_good: int, n_bad: int, min_pairs: int) -> DataFrame:
    """(good, bad): the features of the documents of every pair (``paired``), those of a label in the order of ``id``."""
    rounds, n = paired(n_good, n_bad, min_pairs)
    placed = dense_index(train.where("label in (0, 1)"), ["label", "id"], "at")
    rounds = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("r")

    def side(label: int, before: int, own: int, shift: int, name: str) -> DataFrame:
        rows = placed.where(F.col("label") == label).select((F.col("at") - before).alias("at"), F.col("x").alias(name), rounds)
        first = F.pmod(F.col("at") - F.col("r") * F.lit(n + shift), F.lit(own))
        rows = rows.withColumn("first", first).where(F.col("first") < n)
        return rows.select("r", name, F.explode(F.sequence("first", F.lit(n - 1).cast("long"), F.lit(own).cast("long"))).alias("i"))

    return side(1, n_bad, n_good, 0, "good").join(side(0, 0, n_bad, 1, "bad"), ["r", "i"]).select("good", "bad")


def document_features(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, x): the features of every document, and a digest that tells different texts apart.

    One pass over the scan.  What comes after works on these rows, so no text is shuffled or sorted.
    """
    def run(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            digests, rows = [], []
            for (text,) in text_rows(b, "text"):
                text = text or ""
                digests.append(xxhash.xxh3_128_digest(text.encode("utf-8", "replace")))
                rows.append(features(text))
            yield pa.record_batch([b.column(b.schema.get_field_index("doc_id")), pa.array(digests, pa.binary()), pa.array(rows, pa.list_(pa.float64()))],
                                  names=["doc_id", "digest", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialize(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, digest binary, x array<double>"), "quality-features")


def training_features(docs: DataFrame, featured: DataFrame, labels: DataFrame, folds: int, fold: int) -> DataFrame:
    """(id, label, x) of labelled documents outside the held-out fold, each id once.

    Ids that repeat with different texts take the smallest text (``training_rows``); only the
    texts of such ids are shuffled.
    """
    joined = featured.join(known_labels(labels, "quality", folds, fold), "doc_id")
    per = materialize(joined.groupBy("doc_id").agg(F.max("label").alias("label"), F.any_value("x").alias("x"),
                                                   (F.min("digest") != F.max("digest")).alias("differ")), "quality-labelled")
    one = per.where("not differ").select(F.col("doc_id").cast("string").alias("id"), "label", "x")
    differ = materialize(per.where("differ").select("doc_id"), "quality-differ")
    if differ.isEmpty():
        return one
    texts = training_rows(docs.join(differ, "doc_id", "left_semi"), labels, "quality", folds, fold, None)
    smallest = document_features(texts).join(per.select("doc_id", "label"), "doc_id").select(F.col("doc_id").cast("string").alias("id"), "label", "x")
    return materialize(one.unionAll(smallest), "quality-train")


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3, bins: int = 8,
                min_pairs: int = 20_000, l2: float = 1.0, steps: int = 12, featured: DataFrame | None = None) -> QualityModel:
    """A ranking from all labelled documents outside the held-out fold.

    Bin edges and the threshold are exact quantiles over all of them, every one is in a preference
    pair, and every step adds up all pairs in the tasks; the driver gets matrices of the number of
    weights only.  ``featured`` are the rows of ``document_features`` where they are at hand.
    """
    train = training_features(docs, document_features(docs) if featured is None else featured, labels, folds, fold)
    seen = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_good, n_bad, total = seen.get(1, 0), seen.get(0, 0), sum(seen.values())
    share = [float(q) for q in np.linspace(0, 1, bins + 1)[1:-1]]
    found = exact_quantiles(train, {str(j): F.get("x", F.lit(j)) for j in range(N_FEATURES)}, share) if total else {}
    edges = [np.unique(np.array(found[str(j)], dtype=float)) if total else np.zeros(0) for j in range(N_FEATURES)]
    model = QualityModel(edges, np.zeros(sum(len(e) + 1 for e in edges)), 0.0, threshold)
    if not n_good or not n_bad:
        model.cut = -30.0 if n_good else 30.0
        return model
    pairs = materialize(preference_pairs(train, n_good, n_bad, min_pairs), "quality-pairs")
    n_weights, tasks = len(model.weights), pairs.rdd.getNumPartitions()

    def sums(w: np.ndarray) -> np.ndarray:
        def add(batches):
            import pyarrow as pa
            from pyspark import TaskContext

            both = np.zeros((n_weights + 1, n_weights))
            for b in batches:
                for start in range(0, b.num_rows, 4096):
                    good, bad = (model.design(b.column(c).slice(start, 4096).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)) for c in (0, 1))
                    both += _sums(good - bad, w)
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([both.tobytes()], pa.binary())], names=["node", "data"])

        return tree_sum(pairs.mapInArrow(add, "node int, data binary"), tasks, n_weights)

    model.weights = newton(sums, n_weights, l2, steps)

    def raw(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.record_batch([pa.array(model.raw(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)).astype(float))], names=["raw"])

    scored = materialize(train.select("x").mapInArrow(raw, "raw double"), "quality-raw")
    model.cut = float(exact_quantiles(scored, {"raw": F.col("raw")}, [n_bad / total])["raw"][0])
    return model


def score_column(model: QualityModel, text: Column | str) -> Column:
    """The score of a text column, 0 to 1; a null text is scored as an empty one."""
    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(model.scores(part))

    return run(text)


def feature_score_column(model: QualityModel, x: Column | str) -> Column:
    """The score of a column of features (``document_features``), 0 to 1."""
    @F.pandas_udf("double")
    def run(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in rows:
            yield pd.Series(model.scores_of(np.array(part.tolist(), dtype=float).reshape(-1, N_FEATURES)))

    return run(x)


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per input row, repeated rows and null ids included.

    A null text is scored as an empty one.  Without labels of both kinds every document
    gets the only label's side.  The features of a text are computed once, for the fit and
    for its score; the texts are not shuffled.
    """
    featured = document_features(docs)
    model = fit_quality(docs, labels, folds, fold, threshold, featured=featured)
    rows = featured.select("doc_id", held_out(folds, fold).alias("held_out"), feature_score_column(model, "x").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
