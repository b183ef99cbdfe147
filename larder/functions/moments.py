"""Means, co-moments and extremes of many columns in one pass.

An aggregate of a few hundred moment columns is one generated method too long for the JVM's
compiler.  Here every task adds up its batches in numpy, pair by pair of columns, and gives one row
of (columns x columns) matrices; these are merged with the formula for two samples.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Of columns i and j: rows where both have a value, the mean of i over these, and their co-moment."""
    n: np.ndarray
    mean: np.ndarray
    c: np.ndarray
    low: np.ndarray       # of each column
    high: np.ndarray

    def mean_of(self, i: int) -> float | None:
        return float(self.mean[i, i]) if self.n[i, i] else None

    def stddev_pop(self, i: int) -> float | None:
        return float(np.sqrt(self.c[i, i] / self.n[i, i])) if self.n[i, i] else None

    def covar_samp(self, i: int, j: int) -> float | None:
        return float(self.c[i, j] / (self.n[i, j] - 1)) if self.n[i, j] > 1 else None

    def extremes(self, i: int) -> tuple[float | None, float | None]:
        return (float(self.low[i]), float(self.high[i])) if self.n[i, i] else (None, None)


def _merged(a: Moments, b: Moments) -> Moments:
    n = a.n + b.n
    some = np.maximum(n, 1.0)
    apart = np.where((a.n > 0) & (b.n > 0), b.mean - a.mean, 0.0)
    mean = np.where(a.n == 0, b.mean, a.mean + apart * (b.n / some))
    return Moments(n, mean, a.c + b.c + apart * apart.T * (a.n * b.n / some), np.fmin(a.low, b.low), np.maximum(a.high, b.high))


def _of_batch(x: np.ndarray, given: np.ndarray) -> Moments:
    """Moments of the rows of ``x``; ``given`` is 0 where a value is missing."""
    rows = given.sum(axis=0)
    centre = np.where(given > 0, x, 0.0).sum(axis=0) / np.maximum(rows, 1.0)
    away = np.where(given > 0, x - centre, 0.0)
    n, total = given.T @ given, away.T @ given
    some = np.maximum(n, 1.0)
    mean = centre[:, None] + total / some
    return Moments(n, mean, away.T @ away - total * total.T / some,
                   np.fmin.reduce(np.where(given > 0, x, np.inf), axis=0), np.where(given > 0, x, -np.inf).max(axis=0))


def co_moments(df: DataFrame, columns: list[str]) -> Moments:
    """The moments of ``columns`` as doubles over all rows; a NULL leaves its row out of its column's pairs only."""
    d = len(columns)

    def sums(batches):
        import pyarrow as pa

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            given = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns]).astype(np.float64)
            with np.errstate(invalid="ignore"):
                now = _of_batch(x, given)
                held = now if held is None else _merged(held, now)
        if held is not None:
            data = np.concatenate([held.n.ravel(), held.mean.ravel(), held.c.ravel(), held.low, held.high])
            yield pa.record_batch([pa.array([data.tobytes()], pa.binary())], names=["data"])

    rows = df.select(*(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)))
    found = None
    for r in rows.mapInArrow(sums, "data binary").collect():
        v = np.frombuffer(r["data"])
        n, mean, c = (v[k * d * d:(k + 1) * d * d].reshape(d, d) for k in range(3))
        now = Moments(n, mean, c, v[3 * d * d:3 * d * d + d], v[3 * d * d + d:])
        with np.errstate(invalid="ignore"):
            found = now if found is None else _merged(found, now)
    none = np.zeros((d, d))
    return found if found is not None else Moments(none, none, none, np.full(d, np.inf), np.full(d, -np.inf))
