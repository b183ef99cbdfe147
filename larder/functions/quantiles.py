"""Exact quantiles without a single-task merge.

Spark's exact ``percentile`` in a global aggregate ships every distinct value
to one final task, which does not survive a continuous column at scale.
Here each wanted order statistic is found by rank selection over the whole
column:

1. one pass: count, min, max per column;
2. bracket passes: values inside each target's current bracket are cut
   into ``buckets`` equal-width buckets and counted (in numpy inside the
   tasks, then a grouped sum; only targets x buckets rows reach the
   driver); the bucket holding the target rank becomes the new bracket;
3. when a bracket holds few rows (or one distinct value), its distinct
   values and counts are fetched and the rank is read off exactly.

Linear interpolation between the two neighbouring order statistics gives
the same quantile definition as pandas, numpy, DuckDB ``quantile_cont`` and
Spark ``percentile``.  Typical columns converge in two or three passes.  There
is one path at every size, so a quantile does not depend on the row count's side
of a limit.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
FINAL_ROWS = 50_000
MAX_PASSES = 24


def _order_statistics(base: DataFrame, names: list[str], wanted: dict[str, set[int]],
                      stats: dict[str, tuple[int, float, float]]) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ranks ``wanted[name]`` of each non-NULL column."""
    # target state: (name, rank) -> [lo, hi, below]
    state = {(n, r): [stats[n][1], stats[n][2], 0] for n in names for r in wanted[n]}
    found: dict[tuple[str, int], float] = {}
    for (n, r), (lo, hi, _) in list(state.items()):
        if lo == hi:
            found[(n, r)] = lo
            del state[(n, r)]
    for _ in range(MAX_PASSES):
        if not state:
            break
        # one bracket per distinct (name, lo, hi); several ranks may share it
        brackets = sorted({(n, st[0], st[1]) for (n, _), st in state.items()})
        bid = {b: i for i, b in enumerate(brackets)}
        counts = (_bucketed(base, brackets).groupBy("b", "k")
                  .agg(F.sum("c").alias("c"), F.min("mn").alias("mn"), F.max("mx").alias("mx")).collect())
        per = {}
        for row in counts:
            per.setdefault(row["b"], []).append((row["k"], row["c"], row["mn"], row["mx"]))
        for lst in per.values():
            lst.sort()
        small = []
        for (n, r), st in list(state.items()):
            lo, hi, below = st
            cum = below
            for _, c, mn, mx in per[bid[(n, lo, hi)]]:
                if cum + c > r:
                    if mn == mx:
                        found[(n, r)] = mn
                        del state[(n, r)]
                    elif c <= FINAL_ROWS:
                        small.append((n, r, mn, mx, cum))
                        del state[(n, r)]
                    else:
                        st[0], st[1], st[2] = mn, mx, cum
                    break
                cum += c
        if small:
            found.update(_finish(base, small))
    if state:  # pathological spacing: finish whatever brackets remain
        found.update(_finish(base, [(n, r, st[0], st[1], st[2]) for (n, r), st in state.items()]))
    return found


def _bucketed(base: DataFrame, brackets: list[tuple[str, float, float]]) -> DataFrame:
    """(b, k, c, mn, mx): count, min and max of the values in every bucket of every bracket, added up in the tasks."""
    spans = [(base.columns.index(n), lo, hi) for n, lo, hi in brackets]
    buckets = BUCKETS

    def count(batches):
        import pyarrow as pa

        held = {}
        for batch in batches:
            for i, (at, lo, hi) in enumerate(spans):
                x = batch.column(at).to_numpy(zero_copy_only=False)
                x = x[(x >= lo) & (x <= hi)]
                if not len(x):
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    k = np.nan_to_num(np.minimum(np.floor((x - lo) / (hi - lo) * buckets), buckets - 1)).astype(np.int64)
                if i not in held:
                    held[i] = np.zeros(buckets, dtype=np.int64), np.full(buckets, np.inf), np.full(buckets, -np.inf)
                c, mn, mx = held[i]
                c += np.bincount(k, minlength=buckets)
                np.minimum.at(mn, k, x)
                np.maximum.at(mx, k, x)
        for i, (c, mn, mx) in held.items():
            k = np.flatnonzero(c)
            yield pa.record_batch([pa.array(np.full(len(k), i, dtype=np.int32)), pa.array(k.astype(np.int32)), pa.array(c[k]), pa.array(mn[k]), pa.array(mx[k])],
                                  names=["b", "k", "c", "mn", "mx"])

    return base.mapInArrow(count, "b int, k int, c long, mn double, mx double")


def _inside(base: DataFrame, brackets: list[tuple[str, float, float]]) -> DataFrame:
    """(b, x, c): the values inside every bracket, counted in batches."""
    spans = [(base.columns.index(n), lo, hi) for n, lo, hi in brackets]

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            for i, (at, lo, hi) in enumerate(spans):
                x = batch.column(at).to_numpy(zero_copy_only=False)
                x, c = np.unique(x[(x >= lo) & (x <= hi)], return_counts=True)
                if len(x):
                    yield pa.record_batch([pa.array(np.full(len(x), i, dtype=np.int32)), pa.array(x), pa.array(c.astype(np.int64))], names=["b", "x", "c"])

    return base.mapInArrow(count, "b int, x double, c long")


def _finish(base: DataFrame, small: list[tuple]) -> dict[tuple[str, int], float]:
    """Read ranks off the distinct values (with counts) inside small brackets."""
    brackets = sorted({(n, lo, hi) for n, _, lo, hi, _ in small})
    bid = {b: i for i, b in enumerate(brackets)}
    rows = _inside(base, brackets).groupBy("b", "x").agg(F.sum("c").alias("c")).collect()
    per: dict[int, list] = {}
    for row in rows:
        per.setdefault(row["b"], []).append((row["x"], row["c"]))
    out = {}
    for n, r, lo, hi, below in small:
        cum = below
        for x, c in sorted(per[bid[(n, lo, hi)]]):
            if cum + c > r:
                out[(n, r)] = x
                break
            cum += c
    return out


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probs: dict[str, list[float]] | list[float],
                    stats: dict[str, tuple[int, float | None, float | None]] | None = None
                    ) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each expression over all non-NULL rows.

    ``columns`` maps a name to a numeric expression over ``df``; ``probs`` is
    one list for all columns or a list per name.  NaN and infinities count as
    missing.  ``stats`` may give each column's (non-NULL count, min, max)
    when an earlier aggregate already has them (saves the first pass).
    Returns ``{name: [q(p) for p in probs]}`` (None for an empty column).
    """
    def clean(c: Column) -> Column:
        d = c.cast("double")
        return F.when(F.isnan(d) | (F.abs(d) == math.inf), F.lit(None).cast("double")).otherwise(d)

    names = list(columns)
    per_probs = probs if isinstance(probs, dict) else {n: list(probs) for n in names}
    base = df.select(*[clean(c).alias(f"q{i}") for i, c in enumerate(columns.values())])
    alias = {n: f"q{i}" for i, n in enumerate(names)}
    if stats is None:
        row = base.agg(*[x for n in names for x in (F.count(alias[n]).alias(f"n_{alias[n]}"),
                                                    F.min(alias[n]).alias(f"lo_{alias[n]}"),
                                                    F.max(alias[n]).alias(f"hi_{alias[n]}"))]).first()
        given = {n: (row[f"n_{alias[n]}"], row[f"lo_{alias[n]}"], row[f"hi_{alias[n]}"]) for n in names}
    else:
        given = stats
    stats, wanted, plan = {}, {}, {}
    for n in names:
        a = alias[n]
        cnt = int(given[n][0] or 0)
        if cnt == 0:
            continue
        stats[a] = (cnt, float(given[n][1]), float(given[n][2]))
        need = set()
        for p in per_probs[n]:
            h = (cnt - 1) * p
            lo_r = int(math.floor(h))
            hi_r = min(lo_r + 1, cnt - 1)
            need.update({lo_r, hi_r})
            plan[(n, p)] = (lo_r, hi_r, h - lo_r)
        wanted[a] = need
    found = _order_statistics(base, list(stats), wanted, stats) if stats else {}
    out: dict[str, list[float | None]] = {}
    for n in names:
        a = alias[n]
        vals = []
        for p in per_probs[n]:
            if a not in stats:
                vals.append(None)
                continue
            lo_r, hi_r, frac = plan[(n, p)]
            lo_v, hi_v = found[(a, lo_r)], found[(a, hi_r)]
            vals.append(lo_v if frac == 0 or lo_v == hi_v else lo_v + (hi_v - lo_v) * frac)
        out[n] = vals
    return out
