"""Leading right singular vectors of a long sparse matrix, with nothing of its width on the driver.

The basis is a tall block (rows of one side of X x columns) in panels of columns.  A panel is a file
of row-major numbers for each of some groups of rows, written once by a task in a folder below
``spark.checkpoint.dir`` and read there by ranges (``pyarrow.fs``), so neither the basis nor X is
shuffled or written again by a pass.  A pass multiplies the newest panel by ``XᵀX``: every task adds
up ``Xᵀ(XQ)`` in numpy for its shares of X, and the sums meet by groups of rows.  Products of two
tall blocks are sums over groups, and orthonormal columns come from a tall-skinny QR; many groups
are taken together by trees of fan-in ``FAN_IN``, so the driver receives matrices of the number of
columns only, where the small Rayleigh-Ritz problem is solved.

The method is block Lanczos with full orthogonalization and thick restarts.  As ``A B = B S + Q Z``
holds for the basis B, the next block Q and A = XᵀX, the residual of a Ritz vector is known from Z
without a further pass.  Blocks may be narrower than the number of wanted vectors; where the space is
spanned early, or a wanted eigenvalue shows as often as a block is wide, random columns join the
next block and the passes go on.  Where X has fewer rows than features the same is done for Xᵀ, whose
basis is the shorter one, and the vectors are ``Xᵀu / σ``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.plans.materialize import discard, discard_folder, materialize, new_folder, opened

#: Rows of the basis that are worked on at once.
ROWS = 1024
#: Matrices that one task of a tree takes together.
FAN_IN = 8
#: Nonzeros of a share of X, at least, where there are cores for more shares.
BLOCK_NONZEROS = 1 << 16
#: Nonzeros of a share of X, about, that one task sorts by row and multiplies.
SORTED = 1 << 22
#: Bytes of gathered rows that are multiplied at once (they should stay in a core's cache).
CACHE_BYTES = 1 << 20
#: Bytes of the columns (all features) that a share of X works on at a time.
CHUNK_BYTES = 64 << 20
#: Entries of a dense block for each of its nonzeros, at most; sparser rows are summed entry by entry.
DENSE = 32
#: Columns of the basis before a restart, as a multiple of the wanted ones.
MAX_BLOCKS = 4
#: Columns that a pass multiplies, at most.  Narrow blocks make polynomials of a higher degree of the same basis.
BLOCK = 128
#: Eigenvalues closer than this share of the largest may be one of a multiplicity that a block cannot show.
SAME = 1e-6
#: Directions below this share of the largest are taken as spanned.
SPANNED = 1e-10
#: Kinds of rows beside pieces of X: one that is asked for, and what it carries.
ID, CARRIED = 1, 2
#: The smallest eigenvalue, as a share of the largest, whose vector is made from that of the other side.
OTHER_SIDE = 1e-6

def _whole_rows(matrix: DataFrame, nonzeros: int, use, kind: str) -> DataFrame:
    """What ``use(features, values, sizes)`` yields for shares of X, each of whole rows.

    A row holds at most one entry per feature, so its size is bounded by the vocabulary, never
    by the data.
    """
    # as many partitions as the entries ask for, so that no task's sort grows with the input
    parts = max(1, -(-nonzeros // SORTED), min(matrix.sparkSession.sparkContext.defaultParallelism, -(-nonzeros // BLOCK_NONZEROS)))

    def taken(batches):
        held = [(b.column(0).to_numpy(zero_copy_only=False), *_ragged(b.column(1), np.int32), _ragged(b.column(2), np.float64)[0]) for b in batches if b.num_rows]
        if held:
            ids, idx, each, val = (np.concatenate(c) for c in zip(*held, strict=True))
            del held
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            yield from use(idx, val, np.add.reduceat(each, starts).astype(np.int32))

    pieces = _pieces(matrix).select(F.xxhash64("id").alias("id"), "features", "values")
    return pieces.repartition(parts, "id").sortWithinPartitions("id").mapInArrow(taken, kind)


def stored_rows(matrix: DataFrame, folder: str, nonzeros: int) -> list[tuple[str, int, int]]:
    """(file, entries, rows) of shares of X, each of whole rows: their features, values and numbers of entries."""
    def store(idx, val, sizes):
        import pyarrow as pa

        file = _written(folder, "x", 0, idx, val, sizes)
        yield pa.record_batch([pa.array([file]), pa.array([len(idx)], pa.int64()), pa.array([len(sizes)], pa.int64())], names=["file", "entries", "rows"])

    return [tuple(r) for r in materialize(_whole_rows(matrix, nonzeros, store, "file string, entries long, rows long"), "svd-shares").collect()]


def _gram(matrix: DataFrame, n: int, nonzeros: int) -> np.ndarray:
    """XᵀX of a matrix of few features, added up in the tasks."""
    def product(idx, val, sizes):
        import pyarrow as pa

        acc = np.zeros((n, n))
        for lo, hi, first, last in _row_blocks(sizes, n):
            block = _dense(idx[first:last], val[first:last], sizes[lo:hi])
            if block is None:
                _add_product(acc, np.eye(n), idx[first:last], val[first:last], sizes[lo:hi])
            else:
                acc[np.ix_(block[0], block[0])] += block[1].T @ block[1]
        yield pa.record_batch([pa.array([0], pa.int32()), pa.array([acc.tobytes()])], names=["node", "data"])

    parts = materialize(_whole_rows(matrix, nonzeros, product, "node int, data binary").withColumn("node", F.monotonically_increasing_id()), "svd-gram")
    # one matrix of each share: a few at a time
    shares = parts.count()
    while shares > FAN_IN:
        parts = materialize(parts.repartition(-(-shares // FAN_IN)).mapInArrow(_summed, "node long, data binary"), "svd-gram")
        shares = parts.count()
    return sum((np.frombuffer(r["data"]).reshape(n, n) for r in parts.collect()), np.zeros((n, n)))


def _summed(batches):
    """The sum of all matrices of a task."""
    import pyarrow as pa

    total = None
    for b in batches:
        for data in b.column(1):
            m = np.frombuffer(data.as_buffer())
            total = m if total is None else total + m
    if total is not None:
        yield pa.record_batch([pa.array([0], pa.int64()), pa.array([total.tobytes()])], names=["node", "data"])


def _written(folder: str, name: str, node: int, *arrays: np.ndarray) -> str:
    """A file of the arrays, one after another; every attempt of a task has files of its own name."""
    from pyspark import TaskContext

    store, path = opened(folder)
    file = f"{name}-{node}-{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(f"{path}/{file}", compression=None) as out:
        for a in arrays:
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if a.size else b"")
    return file


def _share(store, path: str, share: tuple[str, int, int]):
    """(features, values, sizes) of a share of X."""
    file, n, rows = share
    with store.open_input_file(f"{path}/{file}") as f:
        data = f.read_buffer()
    return np.frombuffer(data, np.int32, n), np.frombuffer(data, np.float64, n, 4 * n), np.frombuffer(data, np.int32, rows, 12 * n)


def _dense(idx: np.ndarray, val: np.ndarray, sizes: np.ndarray):
    """(features, rows as a dense block of these), or None where the block would hold mostly zeros."""
    feature, at = np.unique(idx, return_inverse=True)
    if len(sizes) * len(feature) > DENSE * len(idx):
        return None
    at += np.repeat(np.arange(len(sizes)) * len(feature), sizes)
    return feature, np.bincount(at, weights=val, minlength=len(sizes) * len(feature)).reshape(len(sizes), -1)


def _combined(weights: np.ndarray, at: np.ndarray, sizes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The sums of ``weights * table[at]`` over runs of ``sizes`` entries; runs of equal size are multiplied together."""
    out, starts = np.zeros((len(sizes), table.shape[1])), np.cumsum(sizes, dtype=np.int64) - sizes
    order = np.argsort(sizes, kind="stable")
    kinds, first = np.unique(sizes[order], return_index=True)
    for n, lo, hi in zip(kinds.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        step = max(1, CACHE_BYTES // (8 * max(1, n * table.shape[1])))
        run = np.arange(n)
        for s in range(lo, hi if n else lo, step):
            g = order[s:min(hi, s + step)]
            places = starts[g][:, None] + run
            out[g] = np.matmul(weights[places][:, None, :], table.take(at[places], axis=0))[:, 0]
    return out


def _row_blocks(sizes: np.ndarray, width: int):
    """(rows, rows, entries, entries): bounds of whole rows whose products and dense blocks have a bounded size."""
    ends, lo = np.cumsum(sizes, dtype=np.int64), 0
    entries, rows = max(1, (4 << 20) // width), max(1, CHUNK_BYTES // (8 * width))
    while lo < len(sizes):
        first = int(ends[lo - 1]) if lo else 0
        hi = min(max(lo + 1, int(np.searchsorted(ends, first + entries, side="right"))), lo + rows)
        yield lo, hi, first, int(ends[hi - 1])
        lo = hi


def _mostly_zero(idx: np.ndarray, sizes: np.ndarray) -> bool:
    """Whether a dense block of the first rows would hold mostly zeros."""
    n = sizes[:4096]
    few = idx[:int(n.sum())]
    return not len(few) or len(n) * len(np.unique(few)) > DENSE * len(few)


def row_sums(q: np.ndarray, idx: np.ndarray, val: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """X q for some rows of X."""
    width = max(1, q.shape[1])
    if _mostly_zero(idx, sizes):
        return _combined(val, idx, sizes, q)
    out = np.zeros((len(sizes), q.shape[1]))
    for lo, hi, first, last in _row_blocks(sizes, width):
        block = _dense(idx[first:last], val[first:last], sizes[lo:hi])
        out[lo:hi] = _combined(val[first:last], idx[first:last], sizes[lo:hi], q) if block is None else block[1] @ q[block[0]]
    return out


def _add_product(acc: np.ndarray, q: np.ndarray, idx: np.ndarray, val: np.ndarray, sizes: np.ndarray) -> None:
    """acc += Xᵀ(X q) for some rows of X, a bounded number of rows at a time."""
    width = max(1, q.shape[1])

    def sparse(i, v, n):
        y = _combined(v, i, n, q)
        order = np.argsort(i, kind="stable")
        feature, entries = np.unique(i, return_counts=True)
        acc[feature] += _combined(v[order], np.repeat(np.arange(len(n)), n)[order], entries, y)

    if _mostly_zero(idx, sizes):
        ends, rows = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), max(1, CHUNK_BYTES // (8 * width))
        for lo in range(0, len(sizes), rows):
            hi = min(len(sizes), lo + rows)
            sparse(idx[ends[lo]:ends[hi]], val[ends[lo]:ends[hi]], sizes[lo:hi])
        return
    for lo, hi, first, last in _row_blocks(sizes, width):
        i, v, n = idx[first:last], val[first:last], sizes[lo:hi]
        block = _dense(i, v, n)
        if block is None:
            sparse(i, v, n)
        else:
            acc[block[0]] += block[1].T @ (block[1] @ q[block[0]])


def _tree(parts: DataFrame, n_blocks: int, op: str, width: int) -> np.ndarray:
    """The sum, or the R factor, of the matrices (node, data) of all row blocks; ``width`` columns each."""
    def combine(pdf):
        import pandas as pd

        mats = [np.frombuffer(d).reshape(-1, width) for d in pdf["data"]]
        return pd.DataFrame({"node": [int(pdf["node"].iloc[0])], "data": [np.ascontiguousarray(_joined(mats, op)).tobytes()]})

    while n_blocks > FAN_IN:
        parts = parts.withColumn("node", (F.col("node") / FAN_IN).cast("int")).groupBy("node").applyInPandas(combine, "node int, data binary")
        n_blocks = -(-n_blocks // FAN_IN)
    return _joined([np.frombuffer(r["data"]).reshape(-1, width) for r in sorted(parts.collect(), key=lambda r: r["node"])], op)


def tree_sum(parts: DataFrame, n: int, width: int) -> np.ndarray:
    """The sum of ``n`` matrices (node, data) of equal shape, ``width`` columns each, nodes from 0 on."""
    return _tree(parts, n, "sum", width)


@dataclass
class _Panel:
    """Columns of a tall block: a file for each group of rows, times ``t``."""
    files: list[str]
    width: int                       # columns of the files
    t: np.ndarray | None = None

    @property
    def columns(self) -> int:
        return self.width if self.t is None else self.t.shape[1]


@dataclass
class _State:
    spark: object
    folder: str
    n: int                           # rows
    cuts: list[int]                  # where the groups of rows begin, and the end
    panels: list[_Panel]             # the basis
    w: _Panel | None = None          # the newest product, and then what is left of it beside the basis
    runs: int = 0

    @property
    def m(self) -> int:
        return sum(p.columns for p in self.panels)

    def of(self, coefficients: np.ndarray) -> list[np.ndarray]:
        """The rows of ``coefficients`` of the basis by panel, for the columns as they are stored."""
        ends = np.cumsum([p.columns for p in self.panels])[:-1]
        return [c if p.t is None else p.t @ c for p, c in zip(self.panels, np.split(coefficients, ends), strict=True)] if self.panels else []


class _Opened:
    """The files of a group's panels, read by blocks of rows."""

    def __init__(self, folder: str, panels: list[_Panel], node: int):
        store, path = opened(folder)
        self.files = [(store.open_input_file(f"{path}/{p.files[node]}"), p.width) for p in panels]

    def read(self, first: int, n: int) -> list[np.ndarray]:
        """Rows ``first`` to ``first + n`` of the group, of every panel."""
        out = []
        for f, width in self.files:
            f.seek(8 * first * width)
            out.append(np.frombuffer(f.read(8 * n * width)).reshape(n, width))
        return out


def _tasks(state: _State, count: int, make, ops: str = "") -> tuple[list[str], list[np.ndarray]]:
    """Runs ``make(node, name) -> (file, matrices)`` in a task for each node; the files by node, and the matrices of all
    nodes taken together: their sums ("s") or the R factors of them one below another ("r").

    ``name`` tells the files of one run from those of others.
    """
    state.runs += 1
    name = str(state.runs)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for node in b.column(0).to_pylist():
                file, mats = make(node, name)
                yield pa.record_batch([pa.array([node], pa.int32()), pa.array([file]), pa.array([[np.ascontiguousarray(x).tobytes() for x in mats]], pa.list_(pa.binary())),
                                       pa.array([[x.shape[1] for x in mats]], pa.list_(pa.int32()))], names=["node", "file", "data", "width"])

    rows = state.spark.range(0, count, 1, count).mapInArrow(run, "node int, file string, data array<binary>, width array<int>")
    if not ops or count <= 2 * FAN_IN:
        rows = sorted(rows.collect(), key=lambda r: r["node"])
        mats = [_joined([np.frombuffer(r["data"][j]).reshape(-1, r["width"][j]) for r in rows], op) for j, op in enumerate(ops)]
    else:
        rows = materialize(rows, "svd-run")
        widths = rows.select("width").first()["width"]
        mats = [_tree(rows.select("node", F.col("data")[j].alias("data")), count, "sum" if op == "s" else "qr", widths[j]) for j, op in enumerate(ops)]
        rows = rows.select("node", "file").orderBy("node").collect()
    return [r["file"] for r in rows], mats


def _joined(mats: list[np.ndarray], op: str) -> np.ndarray:
    return sum(mats[1:], mats[0]) if op in ("s", "sum") else np.linalg.qr(np.vstack(mats), mode="r")


def _rows_of(state: _State, node: int):
    """(first, n): blocks of the rows of a group."""
    size = state.cuts[node + 1] - state.cuts[node]
    for first in range(0, size, ROWS):
        yield first, min(ROWS, size - first)


def _dropped(state: _State, panel: _Panel | None) -> None:
    """Deletes the files of a panel that nothing reads any more."""
    from pyarrow import fs

    if panel is not None:
        store, path = fs.FileSystem.from_uri(state.folder)
        for f in panel.files:
            store.delete_file(f"{path}/{f}")


def _stacked(mats: list[np.ndarray], columns: int) -> np.ndarray:
    return np.vstack(mats) if mats else np.zeros((0, columns))


def _local(state: _State) -> _State:
    """The state as tasks take it along."""
    return _State(None, state.folder, state.n, state.cuts, [_Panel(p.files, p.width) for p in state.panels], state.w)


def _mapped(state: _State, panels: list[_Panel], coefficients: list[np.ndarray], plus: np.ndarray | None, tag: str, ops: str = "", also=None):
    """A panel ``w @ plus - Σ panel @ coefficients``, written by groups (``plus`` None: ``Σ panel @ coefficients``), and the matrices that
    ``also`` makes of every block: "s" of the blocks of the panels and the new one, "r" of the new one."""
    here, width = _local(state), (plus.shape[1] if plus is not None else coefficients[0].shape[1])
    w = here.w

    def make(node, name):
        files = _Opened(here.folder, [*panels, *([w] if plus is not None else [])], node)
        out, sums, r = [], None, np.zeros((0, width))
        for first, n in _rows_of(here, node):
            blocks = files.read(first, n)
            x = blocks.pop() @ plus if plus is not None else np.zeros((n, width))
            for block, c in zip(blocks, coefficients, strict=True):
                x = x - block @ c if plus is not None else x + block @ c
            out.append(x)
            if "s" in ops:
                mine = np.vstack([block.T @ x for block in blocks]) if blocks else np.zeros((0, width))
                sums = mine if sums is None else sums + mine
            if "r" in ops:
                r = np.linalg.qr(np.vstack([r, x]), mode="r")
        file = _written(here.folder, f"{tag}{name}", node, *out)
        return file, [sums if op == "s" else r for op in ops]

    files, mats = _tasks(state, len(state.cuts) - 1, make, ops)
    return _Panel(files, width), mats


def _transposed_into(state: _State, sums: np.ndarray) -> np.ndarray:
    """Products of the stored columns of the basis with a block, for the basis itself."""
    ends = np.cumsum([p.width for p in state.panels])[:-1]
    return _stacked([s if p.t is None else p.t.T @ s for p, s in zip(state.panels, np.split(sums, ends), strict=True)] if state.panels else [], sums.shape[1])


def _orthonormal(state: _State, c1: np.ndarray, scale: float):
    """(new, H, Z): w = B H + Q Z with orthonormal new columns Q, a panel (None if w lies in B); c1 = Bᵀw.

    ``state.w`` becomes what is left of w beside the basis.
    """
    m, width = state.m, state.w.columns
    rest, mats = _mapped(state, _local(state).panels, state.of(c1), np.eye(width), "v", "sr" if m else "r")
    _dropped(state, state.w)
    state.w = rest
    _, s, vt = np.linalg.svd(mats[-1], full_matrices=False)
    kept = s > SPANNED * max(scale, np.linalg.norm(c1, 2) if m else s[0])
    if not kept.any():
        return None, c1, np.zeros((0, width))
    t1 = vt[kept].T / s[kept]
    c2 = _transposed_into(state, mats[0]) @ t1 if m else np.zeros((0, t1.shape[1]))
    new, (r2,) = _mapped(state, _local(state).panels, state.of(c2), t1, "q", "r")
    new.t = np.linalg.inv(r2)
    back = s[kept, None] * vt[kept]
    return new, c1 + c2 @ back, r2 @ back


def _widened(state: _State, extra: int, seed: list[int]) -> np.ndarray:
    """``extra`` random columns join w; its products with the basis."""
    here = _local(state)
    width = here.w.width + extra

    def make(node, name):
        files, out, sums = _Opened(here.folder, [*here.panels, here.w], node), [], np.zeros((sum(p.width for p in here.panels), width))
        for first, n in _rows_of(here, node):
            *blocks, w = files.read(first, n)
            out.append(np.hstack([w, np.random.default_rng([*seed, here.cuts[node] + first]).standard_normal((n, extra))]))
            sums += _stacked([b.T @ out[-1] for b in blocks], width)
        return _written(here.folder, f"w{name}", node, *out), [sums]

    files, (sums,) = _tasks(state, len(state.cuts) - 1, make, "s")
    _dropped(state, state.w)
    state.w = _Panel(files, width)
    return _transposed_into(state, sums)


def _crowded(lam: np.ndarray, k: int, block: int, scale: float) -> bool:
    """Whether an eigenvalue above the k-th comes ``block`` times: there may be more of it than the passes can show."""
    near = SAME * scale
    return any(lam[i] - lam[i + block - 1] <= near and lam[i + block - 1] > lam[k - 1] + near for i in range(max(0, k - block)))


def _restarted(state: _State, u: np.ndarray) -> None:
    """The basis becomes basis @ u."""
    panel, _ = _mapped(state, _local(state).panels, state.of(u), None, "b")
    for p in state.panels:
        _dropped(state, p)
    state.panels = [panel]


def _multiplied(state: _State, new: _Panel, shares: list[tuple[str, int, int]], q: int) -> np.ndarray:
    """The ``q`` columns of ``new`` join the basis, and w becomes XᵀX times them; the products of basis and w."""
    _dropped(state, state.w)
    state.w = None
    chunk = max(1, min(q, CHUNK_BYTES // (8 * state.n)))
    chunks = -(-q // chunk)
    cores = state.spark.sparkContext.defaultParallelism
    # the heaviest shares first, each to the task with the least
    dealt = [[0, []] for _ in range(min(len(shares), cores))]
    for s in sorted(shares, key=lambda s: -s[1]):
        least = min(dealt, key=lambda d: d[0])
        least[0] += s[1]
        least[1].append(s)
    here, own = _local(state), [d[1] for d in dealt]

    def multiply(node, name):
        store, path = opened(here.folder)
        for c in range(chunks):
            t = new.t[:, c * chunk:(c + 1) * chunk]
            columns = np.empty((here.n, t.shape[1]))
            for group in range(len(here.cuts) - 1):
                files = _Opened(here.folder, [new], group)
                for first, n in _rows_of(here, group):
                    columns[here.cuts[group] + first:][:n] = files.read(first, n)[0] @ t
            acc = np.zeros_like(columns)
            for share in own[node]:
                _add_product(acc, columns, *_share(store, path, share))
            del columns
            file = _written(here.folder, f"p{name}-{c}", node, acc)
        return file[len(f"p{name}-{c}"):], []

    files, _ = _tasks(state, len(own), multiply)
    name = state.runs
    sums = [[_Panel([f"p{name}-{c}{f}"], min(chunk, q - c * chunk)) for f in files] for c in range(chunks)]
    state.panels.append(new)
    here = _local(state)

    def gather(node, run):
        added = [_Opened(here.folder, of, 0) for of in sums]
        basis, out, prod = _Opened(here.folder, here.panels, node), [], np.zeros((sum(p.width for p in here.panels), q))
        for first, n in _rows_of(here, node):
            out.append(np.hstack([sum(a.read(here.cuts[node] + first, n)) for a in added]))
            prod += np.vstack([b.T @ out[-1] for b in basis.read(first, n)])
        return _written(here.folder, f"w{run}", node, *out), [prod]

    files, (prod,) = _tasks(state, len(state.cuts) - 1, gather, "s")
    for of in sums:
        for p in of:
            _dropped(state, p)
    state.w = _Panel(files, q)
    return _transposed_into(state, prod)


def _ragged(column, kind):
    """(numbers, how many of them a row has) of an Arrow column of binary; a null row has none."""
    filled = column.fill_null(b"")
    ends = np.frombuffer(filled.buffers()[1], np.int32, len(filled) + 1, 4 * filled.offset)
    numbers = np.frombuffer(filled.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(filled) else np.zeros(0, np.uint8)
    return np.frombuffer(numbers.tobytes(), kind), np.diff(ends) // np.dtype(kind).itemsize


def _pieces(matrix: DataFrame) -> DataFrame:
    """(id, features, values): the entries of rows of X, those packed that come one after another."""
    kind = matrix.schema["id"].dataType.simpleString()

    def pack(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            codes = b.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            ends = np.append(starts, b.num_rows).astype(np.int32)
            packed = [pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends * np.int32(x.itemsize)), pa.py_buffer(x)])
                      for x in (np.ascontiguousarray(b.column(c).to_numpy(zero_copy_only=False)) for c in (1, 2))]
            yield pa.record_batch([b.column(0).take(pa.array(starts)), *packed], names=["id", "features", "values"])

    rows = matrix.select("id", F.col("feature_index").cast("int").alias("feature_index"), F.col("value").cast("double").alias("value"))
    return rows.mapInArrow(pack, f"id {kind}, features binary, values binary")


def _stored_vectors(vectors: DataFrame, k: int, folder: str) -> list[tuple[str, int]]:
    """(file, rows) of V's first ``k`` columns: the features of some rows and their entries."""
    def store(batches):
        import pyarrow as pa

        for i, b in enumerate(batches):
            if b.num_rows:
                v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                file = _written(folder, f"v{i}", 0, b.column(0).to_numpy(zero_copy_only=False).astype(np.int32), v)
                yield pa.record_batch([pa.array([file]), pa.array([b.num_rows], pa.int64())], names=["file", "rows"])

    stored = materialize(vectors.select("feature_index", F.slice("vector", 1, k).alias("v")).mapInArrow(store, "file string, rows long"), "svd-columns")
    return [tuple(r) for r in stored.collect()]


def row_products(matrix: DataFrame, vectors: DataFrame, k: int, columns: int | None = None, ids: DataFrame | None = None,
                 carry: DataFrame | None = None) -> DataFrame:
    """(id, z): ``X V_k`` for the long matrix ``(id, feature_index, value)``, each row in one piece.

    With ``ids`` (id) there is a row for each of them, zeros where the matrix has none, as of a left
    join; with ``carry`` (id, extra) too, these are joined with its rows (id, z, extra).  Null ids join nothing.

    Rows go to shares by their id, their entries packed, and are multiplied in numpy; what is shuffled is the
    matrix itself.  V is written once and read by every share, ``columns`` components at a time (by default as
    many as ``CHUNK_BYTES`` holds).
    """
    spark, kind = matrix.sparkSession, matrix.schema["id"].dataType.simpleString()
    width = (vectors.agg(F.max("feature_index").alias("f")).first()["f"] or 0) + 1
    columns = columns or max(1, min(k, CHUNK_BYTES // (8 * width)))
    named, carried = ids is not None, carry is not None
    nonzeros = matrix.count() + (0 if ids is None else ids.count())
    parts = max(1, -(-nonzeros // (1 << 22)), min(spark.sparkContext.defaultParallelism, -(-nonzeros // BLOCK_NONZEROS)))
    folder = new_folder(spark, "svd-v")
    stored = _stored_vectors(vectors, k, folder)
    # rows that are multiplied together: where V is read in parts, as many as their scores may take
    at_once = 1 if columns >= k else max(1, CHUNK_BYTES // (8 * k))
    names = ["id", "z", "extra"] if carried else ["id", "z"]

    def read(first, last):
        store, path = opened(folder)
        table = np.zeros((width, last - first))
        for file, n in stored:
            with store.open_input_file(f"{path}/{file}") as f:
                feature = np.frombuffer(f.read(4 * n), np.int32)
                for lo in range(0, n, ROWS):
                    size = min(ROWS, n - lo)
                    table[feature[lo:lo + size]] = np.frombuffer(f.read(8 * size * k)).reshape(size, k)[:, first:last]
        return table

    def multiply(batches):
        import pyarrow as pa

        whole, held, waiting = None, [], 0

        def done(rows):
            """The products of whole rows."""
            nonlocal whole
            if whole is None and columns >= k:
                whole = read(0, k)
            codes = rows["id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            own, sort = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes)))), rows["kind"].to_numpy()
            feature, each = _ragged(rows["features"].combine_chunks(), np.int32)
            value, _ = _ragged(rows["values"].combine_chunks(), np.float64)
            filled = np.bincount(own, weights=each, minlength=len(starts)).astype(np.int64)
            z = np.zeros((len(starts), k))
            if len(feature):
                for c in range(0, k, columns):
                    last = min(k, c + columns)
                    z[filled > 0, c:last] = row_sums(whole if columns >= k else read(c, last), feature, value, filled[filled > 0])
            # where a row is named by ids it comes that often, with each of what it carries
            copies = np.bincount(own[sort == ID], minlength=len(starts)) if named else np.ones(len(starts), dtype=np.int64)
            told = np.flatnonzero(sort == CARRIED) if carried else starts
            last = np.cumsum(copies[own[told]])
            # some rows at a time, as a list's offsets are 32 bits wide
            for lo in range(0, int(last[-1]) if len(last) else 0, 1 << 14):
                some = told[np.searchsorted(last, np.arange(lo, min(int(last[-1]), lo + (1 << 14))), side="right")]
                mine = z[own[some]]
                ends = np.arange(0, mine.size + 1, k, dtype=np.int32)
                some_rows = rows.select(["id", "extra"]).take(pa.array(some))
                products = [some_rows["id"].combine_chunks(), pa.ListArray.from_arrays(pa.array(ends), pa.array(mine.ravel()))]
                yield pa.record_batch([*products, *([some_rows["extra"].combine_chunks()] if carried else [])], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            waiting += b.num_rows
            if waiting <= at_once:
                continue
            rows = pa.Table.from_batches(held)
            codes = rows["id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            # the last row is held until it is surely whole
            last = len(codes) - int(np.argmax(codes[::-1] != codes[-1])) if (codes != codes[-1]).any() else 0
            if last:
                yield from done(rows.slice(0, last))
            held = rows.slice(last).combine_chunks().to_batches()
            waiting = len(codes) - last
        if waiting:
            yield from done(pa.Table.from_batches(held))

    none, numbers = F.lit(None), "array<double>"
    bare = (none.cast("binary").alias("features"), none.cast("binary").alias("values"))
    entries = [_pieces(matrix.where("id is not null") if named else matrix).select("id", "features", "values", F.lit(0).alias("kind"), none.cast(numbers).alias("extra"))]
    if named:
        entries.append(ids.select(F.col("id").cast(kind).alias("id"), *bare, F.lit(ID).alias("kind"), none.cast(numbers).alias("extra")))
    if carried:
        entries.append(carry.where("id is not null").select(F.col("id").cast(kind).alias("id"), *bare, F.lit(CARRIED).alias("kind"), F.col("extra").cast(numbers).alias("extra")))
    rows = reduce(DataFrame.union, entries)
    both = rows.repartitionById(parts, F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).sortWithinPartitions("id")
    return both.mapInArrow(multiply, f"id {kind}, z array<double>" + (", extra array<double>" if carried else ""))


@dataclass
class Leading:
    eigenvalues: np.ndarray      # of XᵀX, descending
    vectors: DataFrame           # (feature_index, vector), written; a vector entry per component
    passes: int


def leading_vectors(matrix: DataFrame, n_features: int, k: int, oversample: int = 10, tolerance: float = 1e-8,
                    max_passes: int = 300, seed: int = 42) -> Leading:
    """The ``k`` leading eigenvalues and vectors of ``XᵀX`` for the long matrix ``(id, feature_index, value)``.

    Stops when the residual of every wanted component is at most ``tolerance`` times the largest
    eigenvalue; a matrix that is not through after ``max_passes`` raises an error.  The largest
    entry of a vector by size is positive (of ties the first).
    """
    from larder.operators.content import task_partitions
    from larder.plans.partitioning import dense_index

    spark = matrix.sparkSession
    if n_features <= 2 * BLOCK:
        lam, u = np.linalg.eigh(_gram(matrix, n_features, matrix.count()))
        v = u[:, ::-1][:, :k]
        raw = spark.createDataFrame([(i, v[i].tolist()) for i in range(n_features)], "feature_index int, vector array<double>")
        return Leading(np.clip(lam[::-1][:k], 0.0, None), _signed(materialize(raw, "svd-vectors"), v.shape[1]), 1)
    n_rows = matrix.select("id").distinct().count()
    if 2 * k <= n_rows < n_features:
        rows = dense_index(matrix.select(F.xxhash64("id").alias("row")).distinct(), ["row"], "row_index")
        other = materialize(matrix.select(F.xxhash64("id").alias("row"), F.col("feature_index").alias("id"), "value").join(rows, "row")
                            .select(F.col("id").cast("int").alias("id"), F.col("row_index").cast("int").alias("feature_index"), "value")
                            .repartition(task_partitions(matrix, matrix.count()), "id").sortWithinPartitions("id"), "svd-transposed")
        lam, u, passes = _lanczos(other, n_rows, k, oversample, tolerance, max_passes, seed, True)
        if lam[-1] > OTHER_SIDE * lam[0]:
            # v = Xᵀu / σ; a feature without an entry has zeros
            z = row_products(other, u, k, ids=spark.range(n_features).select(F.col("id").cast("int").alias("id")))
            scale = F.array(*(F.lit(float(x)) for x in 1.0 / np.sqrt(lam)))
            raw = materialize(z.select(F.col("id").alias("feature_index"), F.zip_with("z", scale, lambda a, b: a * b).alias("vector")), "svd-vectors")
            discard(other, u)
            return Leading(lam, _signed(raw, k), passes)
        discard(other, u)
    lam, v, passes = _lanczos(matrix, n_features, k, oversample, tolerance, max_passes, seed, False)
    return Leading(lam, _signed(v, len(lam)), passes)


def _lanczos(matrix: DataFrame, n: int, k: int, oversample: int, tolerance: float, max_passes: int, seed: int, other: bool) -> tuple[np.ndarray, DataFrame, int]:
    """(eigenvalues, vectors, passes) of ``XᵀX``, whose width is ``n``.

    With ``other`` the residual is that of the vectors Xv / σ of ``XXᵀ``.
    """
    spark = matrix.sparkSession
    folder = new_folder(spark, "svd")
    shares = stored_rows(matrix, folder, matrix.count())
    n_blocks, width = -(-n // ROWS), min(n, k + oversample)
    block = min(width, BLOCK)
    limit, held = MAX_BLOCKS * width, min(n, k + max(oversample, block))
    groups = min(n_blocks, max(spark.sparkContext.defaultParallelism, -(-n_blocks // 64)))
    cuts = [min(n, ROWS * (g * n_blocks // groups)) for g in range(groups)] + [n]
    state = _State(spark, folder, n, cuts, [])
    start = _local(state)

    def random(node, name):
        return _written(folder, f"w{name}", node, *(np.random.default_rng([seed, cuts[node] + first]).standard_normal((size, block)) for first, size in _rows_of(start, node))), []

    state.w = _Panel(_tasks(state, groups, random)[0], block)
    small, m, last, scale, passes = np.zeros((0, 0)), 0, block, 0.0, 0
    lam, u, c1 = np.zeros(0), np.zeros((0, 0)), np.zeros((0, block))
    seen, wait = None, 0
    while True:
        new, h, z = _orthonormal(state, c1, scale)
        if m:
            small[:, -last:] = h
            small[-last:, :] = h.T
            small = (small + small.T) / 2.0
            vals, vecs = np.linalg.eigh(small)
            best = np.argsort(vals)[::-1][:held]
            lam, u = vals[best], vecs[:, best]
            scale = max(float(lam[0]), 1e-300)
            if m >= n:
                break
            norms = np.linalg.norm(z @ u[-last:, :k], axis=0)
            if other:
                norms = norms * np.sqrt(scale / np.maximum(lam[:k], OTHER_SIDE * scale))
            residual = norms.max(initial=0.0)
            if not len(z) or (m >= k and passes >= wait and residual <= tolerance * scale):
                if m >= k and (not _crowded(lam, k, block, scale) or (seen is not None and np.abs(lam[:k] - seen).max() <= SAME * scale)):
                    break
                # the space may lack copies of an eigenvalue, or is spanned: look further from random columns too
                seen, wait = lam[:k] if m >= k else None, 2 * passes
                _dropped(state, new)
                new, _, z = _orthonormal(state, _widened(state, block, [seed, passes + 1]), scale)
                if new is None:
                    break
            if passes >= max_passes:
                raise RuntimeError(f"the SVD has a residual of {residual / scale:.2e} after {passes} passes")
            if m + len(z) > limit and m > len(lam):
                _restarted(state, u)
                small, m = np.diag(lam), len(lam)
        elif new is None:
            break
        last = len(z)
        c1 = _multiplied(state, new, shares, last)
        m, passes = m + last, passes + 1
        grown = np.zeros((m, m))
        grown[:m - last, :m - last] = small
        small = grown
    vectors = _ritz_vectors(state, u[:, :k])
    discard_folder(spark, folder)
    return np.clip(lam[:k], 0.0, None), vectors, passes


def _ritz_vectors(state: _State, u: np.ndarray) -> DataFrame:
    """(feature_index, vector): basis @ u, written."""
    here, parts, k = _local(state), state.of(u), u.shape[1]

    def vectors(batches):
        import pyarrow as pa

        for b in batches:
            for node in b.column(0).to_pylist():
                files = _Opened(here.folder, here.panels, node)
                for first, n in _rows_of(here, node):
                    v = sum((x @ c for x, c in zip(files.read(first, n), parts, strict=True)), np.zeros((n, k)))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, max(k, 1), dtype=np.int32)[:n + 1]), pa.array(v.ravel()))
                    yield pa.record_batch([pa.array(np.arange(n, dtype=np.int32) + np.int32(here.cuts[node] + first)), lists], names=["feature_index", "vector"])

    groups = len(state.cuts) - 1
    return materialize(state.spark.range(0, groups, 1, groups).mapInArrow(vectors, "feature_index int, vector array<double>"), "svd-vectors")


def _signed(raw: DataFrame, k: int) -> DataFrame:
    """The written vectors, in place of ``raw``, with the sign that makes the largest entry of each component positive."""
    def largest(batches):
        import pyarrow as pa

        best, at, value = np.full(k, -1.0), np.full(k, np.iinfo(np.int64).max), np.zeros(k)
        for b in batches:
            if not b.num_rows:
                continue
            feature = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k)
            size = np.abs(x)
            top = size.max(axis=0)
            first = np.where(size == top, feature[:, None], np.iinfo(np.int64).max).argmin(axis=0)
            new = (top > best) | ((top == best) & (feature[first] < at))
            best, at, value = np.where(new, top, best), np.where(new, feature[first], at), np.where(new, x[first, np.arange(k)], value)
        if (best >= 0).any():
            yield pa.record_batch([pa.array(np.arange(k, dtype=np.int32)), pa.array(best), pa.array(at), pa.array(value)], names=["c", "a", "i", "x"])

    # a row of each task and component
    few = raw.select("feature_index", "vector").mapInArrow(largest, "c int, a double, i long, x double")
    peaks = few.groupBy("c").agg(F.max_by("x", F.struct("a", (-F.col("i")).alias("i"))).alias("x"))
    signs = {r["c"]: -1.0 if r["x"] < 0 else 1.0 for r in peaks.collect()}
    sign = F.array(*(F.lit(signs[c]) for c in range(k)))
    signed = materialize(raw.select("feature_index", F.zip_with("vector", sign, lambda x, s: x * s).alias("vector")), "svd-v")
    discard(raw)
    return signed
