"""Toxicity: boosted trees over dense features of the text, with isotonic calibration.

The features are lexicon densities, insults near the second person, capitals, punctuation
and obfuscation rates.  The lexicon is learned from the labelled sample: words and word
beginnings that toxic documents hold far more often.  Spark counts its terms; the trees
are fitted on the driver from the sample's feature rows (both bounded by ``max_rows``).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.boosting import Isotonic, Trees, fit_isotonic, fit_trees
from larder.llm.common import materialize, text_rows
from larder.llm.labelled import held_out, training_rows

#: Second person in the corpus languages.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split())
#: Characters that stand in for letters.
_PLAIN = str.maketrans("013457@$!", "oieastasi")
_WORD = re.compile(r"\w+")
_CAPS = re.compile(r"\b[A-Z]{2,}\b")
# begins where a run of letters begins and never goes back into one, so a long run costs its length once
_MASKED = re.compile(r"(?<![A-Za-z])[A-Za-z]++[013457@$!*]++[A-Za-z]+")
_NEAR = 4
N_FEATURES = 20


def _terms(word: str) -> tuple[str, ...]:
    """What the lexicon knows a word by: itself and its beginnings."""
    if len(word) < 4:
        return (word,)
    return (word, word[:5] + "*", word[:4] + "*") if len(word) > 4 else (word, word + "*")


class _Weights(dict):
    """The lexicon weights (word, beginnings) of each word seen; 0 for most; emptied when large."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        if len(self) > 200_000:
            self.clear()
        get, terms = self.lexicon.get, _terms(word)
        whole, begin = get(word, 0.0), max((get(t, 0.0) for t in terms[1:]), default=0.0)
        self[word] = value = (whole, begin) if whole or begin else None
        return value


def features(text: str, weights: _Weights) -> list[float]:
    import numpy as np

    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    count = np.bincount(raw, minlength=256)
    chars, words = max(1, len(raw)), _WORD.findall(text.lower())
    n = max(1, len(words))
    hits = [(i, v) for i, v in enumerate(map(weights.__getitem__, words)) if v]
    whole, begin = [v[0] for _, v in hits if v[0]], [v[1] for _, v in hits if v[1]]
    second = {i for i, w in enumerate(words) if w in SECOND_PERSON}
    near = sum(any(i + d in second for d in range(-_NEAR, _NEAR + 1)) for i, _ in hits) if second else 0
    masked = _MASKED.findall(text)
    plain = sum(weights[w.lower().translate(_PLAIN).replace("*", "")] is not None for w in masked)
    letters = int(count[65:91].sum() + count[97:123].sum())
    same = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (raw[2:] >= 65)
    return [
        math.log1p(len(words)), len(whole) / n, sum(whole) / n, max(whole, default=0.0), math.log1p(len(whole)),
        len(begin) / n, sum(begin) / n, max(begin, default=0.0), math.log1p(len(begin)),
        math.log1p(len({words[i] for i, _ in hits})), near / n, math.log1p(near), len(second) / n,
        int(count[65:91].sum()) / max(1, letters), len(_CAPS.findall(text)) / n,
        int(count[33]) / chars, int(count[63]) / chars, int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()) / chars,
        len(masked) / n + int(same.sum()) / chars, math.log1p(plain),
    ]


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Trees
    calibration: Isotonic

    def scores(self, texts, weights: _Weights | None = None):
        import numpy as np

        weights = weights if weights is not None else _Weights(self.lexicon)
        x = np.array([features(t or "", weights) for t in texts], dtype=float).reshape(-1, N_FEATURES)
        return np.clip(self.calibration(self.trees.margins(x)), 0.0, 1.0)


def learn_lexicon(train: DataFrame, max_terms: int = 5000, least_docs: int = 3, least_weight: float = 1.5) -> dict[str, float]:
    """Log-odds weights of terms by document frequency in toxic against other documents."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = text_rows(b, "text", "label")
            docs, toxic = Counter(), Counter()
            for text, label in rows:
                terms = {t for w in set(_WORD.findall(text.lower())) for t in _terms(w)}
                docs.update(terms)
                if label:
                    toxic.update(terms)
            yield pa.record_batch([pa.array(list(docs), pa.string()), pa.array(list(docs.values()), pa.int64()),
                                   pa.array([toxic[t] for t in docs], pa.int64())], names=["term", "docs", "toxic"])

    total = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t")).first()
    n, t = total["n"], total["t"] or 0
    weight = F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("docs") - F.col("toxic") + 0.5) / (n - t + 1))
    terms = (train.mapInArrow(run, "term string, docs long, toxic long").groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
             .where(F.col("toxic") >= least_docs).withColumn("weight", weight).where(F.col("weight") >= least_weight))
    return {r["term"]: r["weight"] for r in terms.orderBy((F.col("weight") * F.col("toxic")).desc(), "term").limit(max_terms).collect()}


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, max_rows: int = 20_000) -> ToxicityModel:
    """A model from at most about ``max_rows`` labelled documents outside the held-out fold.

    Calibration is fitted on margins of rows that the trees did not see (three parts).
    Without labels of both kinds the model gives every text the rate of the labels (0 without any).
    """
    import numpy as np

    train = materialize(training_rows(docs, labels, "toxic", folds, fold, max_rows), "toxicity-train")
    lexicon = learn_lexicon(train)

    def run(batches):
        import pyarrow as pa

        weights = _Weights(lexicon)
        for b in batches:
            x, y, ids = [], [], []
            for text, label, doc in text_rows(b, "text", "label", "doc_id"):
                x.append(features(text, weights))
                y.append(label)
                ids.append(str(doc))
            yield pa.record_batch([pa.array(ids, pa.string()), pa.array(y, pa.int32()), pa.array(x, pa.list_(pa.float64()))], names=["id", "label", "x"])

    rows = train.mapInArrow(run, "id string, label int, x array<double>").toPandas().sort_values("id")
    x, y = np.array(rows["x"].tolist(), dtype=float).reshape(-1, N_FEATURES), rows["label"].to_numpy(dtype=float)
    parts = np.arange(len(y)) % 3
    margins = np.zeros(len(y))
    for p in range(3):
        margins[parts == p] = fit_trees(x[parts != p], y[parts != p]).margins(x[parts == p])
    return ToxicityModel(lexicon, fit_trees(x, y), fit_isotonic(margins, y))


def score_column(model: ToxicityModel, text: Column | str) -> Column:
    """The score of a text column, 0 to 1; a null text is scored as an empty one."""
    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:

        weights = _Weights(model.lexicon)
        for part in texts:
            yield pd.Series(model.scores(part, weights))

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, threshold: float = 0.3, max_rows: int = 20_000) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per input row, repeated rows and null ids included.

    A null text is scored as an empty one.  There is no shuffle of the documents.
    """
    model = fit_toxicity(docs, labels, folds, fold, max_rows)
    rows = docs.select("doc_id", held_out(folds, fold).alias("held_out"), score_column(model, "text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    model = fit_toxicity(docs, labels, **options)
    return docs.where(score_column(model, "text") < threshold)
