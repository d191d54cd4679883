"""Matrix states per contiguous run of a key, merged in bounded steps.

Rows sorted by key inside each partition become one state per key and
partition (``run_states``): a few packed arrays per run, computed by numpy from
Arrow batches.  ``merge_runs`` brings the states of a key together without
taking their arrays apart: runs of up to FAN_IN neighbouring partitions meet
in one merge, then up to FAN_IN of the results, so a merge holds a bounded
number of states however many partitions a key is scattered over.  Keys that
have one run only (one file per subject) skip the merge.

A state is a set of float64 arrays and two functions: ``of`` (rows to state)
and ``merge`` (states in a row, with the starts of the groups to merge).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FAN_IN = 64
MULTI_KEYS = 1_000_000   # keys with several runs that may be broadcast: some 16 MB
RUN_BYTES = 8 << 20      # of finished states that a Python worker holds before it hands them on

States = dict[str, np.ndarray]


class Complete:
    """Rows without gaps: n, mean, centred cross products (packed upper triangle), min, max."""

    columns = ("n", "mean", "m2", "mn", "mx")

    def __init__(self, d: int):
        self.d = d
        self.iu = np.triu_indices(d)

    def of(self, x: np.ndarray, ok: np.ndarray | None = None) -> States:
        mean = x.mean(axis=0)
        c = x - mean
        return {"n": np.array([len(x)], float), "mean": mean, "m2": (c.T @ c)[self.iu], "mn": x.min(axis=0), "mx": x.max(axis=0)}

    def merge(self, s: States, starts: np.ndarray) -> States:
        group = np.repeat(np.arange(len(starts)), np.diff([*starts, len(s["n"])]))
        n = np.add.reduceat(s["n"], starts)
        mean = np.add.reduceat(s["n"] * s["mean"], starts) / n
        off = s["mean"] - mean[group]
        m2 = np.add.reduceat(s["m2"] + s["n"] * off[:, self.iu[0]] * off[:, self.iu[1]], starts)
        return {"n": n, "mean": mean, "m2": m2, "mn": np.minimum.reduceat(s["mn"], starts), "mx": np.maximum.reduceat(s["mx"], starts)}


class Pairwise:
    """Rows with gaps: for each index pair (packed, i <= j) the moments over the
    rows that have both values.  From the masked products of X and M (1 where
    there is a value): n = M'M, sums X'M, squares (X*X)'M, products X'X, taken
    about the column means of the run so that nothing large cancels."""

    columns = ("n", "mi", "mj", "c", "qi", "qj", "mni", "mxi", "mnj", "mxj")

    def __init__(self, d: int):
        self.d = d
        self.iu = np.triu_indices(d)

    def of(self, x: np.ndarray, ok: np.ndarray) -> States:
        iu, ju = self.iu
        m = ok.astype(float)
        shift = np.where(ok, x, 0.0).sum(axis=0) / np.maximum(m.sum(axis=0), 1.0)
        c = np.where(ok, x - shift, 0.0)
        n, sums, squares, products = m.T @ m, c.T @ m, (c * c).T @ m, c.T @ c
        full = np.maximum(n, 1.0)
        mean = sums / full                                     # of i over the rows that have j
        q = np.maximum(squares - sums * mean, 0.0)
        low, high = np.empty((self.d, self.d)), np.empty((self.d, self.d))
        has, up, down = (np.ascontiguousarray(v.T) for v in (ok, np.where(ok, x, np.inf), np.where(ok, x, -np.inf)))
        for j in range(self.d):
            low[:, j] = np.where(has[j], up, np.inf).min(axis=1)
            high[:, j] = np.where(has[j], down, -np.inf).max(axis=1)
        at = mean + shift[:, None]
        return {"n": n[iu, ju], "mi": at[iu, ju], "mj": at[ju, iu], "c": (products - sums * sums.T / full)[iu, ju], "qi": q[iu, ju], "qj": q[ju, iu],
                "mni": low[iu, ju], "mxi": high[iu, ju], "mnj": low[ju, iu], "mxj": high[ju, iu]}

    def merge(self, s: States, starts: np.ndarray) -> States:
        group = np.repeat(np.arange(len(starts)), np.diff([*starts, len(s["n"])]))
        n = np.add.reduceat(s["n"], starts)
        full = np.maximum(n, 1.0)
        mi, mj = (np.add.reduceat(s["n"] * s[m], starts) / full for m in ("mi", "mj"))
        di, dj = np.where(s["n"] > 0, s["mi"] - mi[group], 0.0), np.where(s["n"] > 0, s["mj"] - mj[group], 0.0)
        out = {"n": n, "mi": mi, "mj": mj, "c": np.add.reduceat(s["c"] + s["n"] * di * dj, starts),
               "qi": np.add.reduceat(s["qi"] + s["n"] * di * di, starts), "qj": np.add.reduceat(s["qj"] + s["n"] * dj * dj, starts)}
        for k in ("mni", "mnj"):
            out[k] = np.minimum.reduceat(s[k], starts)
        for k in ("mxi", "mxj"):
            out[k] = np.maximum.reduceat(s[k], starts)
        return out


class Columns:
    """n, mean, centred squares, min, max of each column: nothing of size d x d."""

    columns = ("n", "mean", "q", "mn", "mx")

    def __init__(self, d: int):
        self.d = d

    def of(self, x: np.ndarray, ok: np.ndarray | None = None) -> States:
        mean = x.mean(axis=0)
        return {"n": np.array([len(x)], float), "mean": mean, "q": ((x - mean) ** 2).sum(axis=0), "mn": x.min(axis=0), "mx": x.max(axis=0)}

    def merge(self, s: States, starts: np.ndarray) -> States:
        group = np.repeat(np.arange(len(starts)), np.diff([*starts, len(s["n"])]))
        n = np.add.reduceat(s["n"], starts)
        mean = np.add.reduceat(s["n"] * s["mean"], starts) / n
        q = np.add.reduceat(s["q"] + s["n"] * (s["mean"] - mean[group]) ** 2, starts)
        return {"n": n, "mean": mean, "q": q, "mn": np.minimum.reduceat(s["mn"], starts), "mx": np.maximum.reduceat(s["mx"], starts)}


class Triangle:
    """R of the QR factors of the rows (d x d): R of stacked Rs is R of the stacked rows."""

    columns = ("r",)

    def __init__(self, d: int):
        self.d = d

    def _r(self, x: np.ndarray) -> np.ndarray:
        if not np.isfinite(x).all():
            raise ValueError("a row to factor has a NULL, NaN or infinity")
        r = np.linalg.qr(x, mode="r")
        out = np.zeros((self.d, self.d))
        out[:len(r)] = r * np.where(np.diagonal(r) < 0, -1.0, 1.0)[:, None]
        return out.ravel()

    def of(self, x: np.ndarray, ok: np.ndarray | None = None) -> States:
        return {"r": self._r(x)}

    def merge(self, s: States, starts: np.ndarray) -> States:
        return {"r": np.stack([self._r(g.reshape(-1, self.d)) for g in np.split(s["r"], starts[1:])])}


class Product:
    """X'(X q) for a given d x l matrix q: a pass over the rows without X'X."""

    columns = ("y",)

    def __init__(self, q: np.ndarray):
        self.d, self.q = len(q), q

    def of(self, x: np.ndarray, ok: np.ndarray | None = None) -> States:
        return {"y": (x.T @ (x @ self.q)).ravel()}

    def merge(self, s: States, starts: np.ndarray) -> States:
        return {"y": np.add.reduceat(s["y"], starts)}


def _starts(keys: list[pa.Array], n: int) -> np.ndarray:
    """Where a new combination of keys begins (equal nulls are one key)."""
    if not keys or not n:
        return np.zeros(1, np.int64)
    ends = [np.asarray(pc.run_end_encode(k).run_ends) for k in keys]
    return np.concatenate([[0], reduce(np.union1d, ends)[:-1]]).astype(np.int64)


def _batch(keys: list[pa.Array], names: list[str], part: int, states: States) -> pa.RecordBatch:
    n = len(next(iter(states.values())))
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * v.shape[1], pa.int32()), pa.array(np.ascontiguousarray(v).ravel())) for v in states.values()]
    return pa.RecordBatch.from_arrays([*keys, pa.array(np.full(n, part, np.int32)), *lists], [*names, "part", *states])


def _folded(chunks: Iterable[tuple[list[pa.Array], States]], names: list[str], part: int, state) -> Iterator[pa.RecordBatch]:
    """Chunks of (keys, states) in key order, neighbours of one key merged;
    the last key of a chunk waits for the next chunk."""
    held = None
    for keys, states in chunks:
        if held is not None:
            keys = [pa.concat_arrays([a, b]) for a, b in zip(held[0], keys)]
            states = {c: np.concatenate([held[1][c], v]) for c, v in states.items()}
        n = len(states[state.columns[0]])
        starts = _starts(keys, n)
        if len(starts) < n:
            merged = state.merge(states, starts)
            states = {c: merged[c] for c in state.columns}
            keys = [k.take(pa.array(starts)) for k in keys]
        last = len(starts) - 1
        if last:
            yield _batch([k.slice(0, last) for k in keys], names, part, {c: v[:last] for c, v in states.items()})
        held = [k.slice(last) for k in keys], {c: v[last:].copy() for c, v in states.items()}
    if held is not None:
        yield _batch(held[0], names, part, held[1])


def _plain(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _schema(df: DataFrame, keys: list[str], state) -> str:
    types = dict(df.dtypes)
    return ", ".join([*(f"`{k}` {types[k]}" for k in keys), "part int", *(f"{c} array<double>" for c in state.columns)])


def run_states(df: DataFrame, keys: list[str], x: str, state) -> DataFrame:
    """keys, part, the state's arrays: one row per key and partition of ``df``.
    ``x`` holds arrays of ``state.d`` values; a null array has no value at all."""
    d, names = state.d, list(keys)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def chunks():
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                values = _plain(batch.column("_x")).flatten()
                table = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, d)
                ok = values.is_valid().to_numpy(zero_copy_only=False).reshape(-1, d)
                kc = [_plain(batch.column(k)) for k in names]
                starts = _starts(kc, batch.num_rows)
                ends = [*starts[1:], batch.num_rows]
                size = max(1, RUN_BYTES // (8 * len(state.columns) * (d * (d + 1) // 2 + 1)))
                for a in range(0, len(starts), size):
                    own = [state.of(table[s:e], ok[s:e]) for s, e in zip(starts[a:a + size], ends[a:a + size])]
                    yield [k.take(pa.array(starts[a:a + size])) for k in kc], {c: np.stack([o[c] for o in own]) for c in state.columns}

        yield from _folded(chunks(), names, TaskContext.get().partitionId(), state)

    blank = F.array_repeat(F.lit(None).cast("double"), d)
    source = df.select(*names, F.coalesce(F.col(x).cast("array<double>"), blank).alias("_x"))
    if names:
        source = source.sortWithinPartitions(*names)
    return source.mapInArrow(fn, _schema(df, names, state))


def _merge_fn(names: list[str], state):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks():
            for batch in batches:
                if batch.num_rows:
                    n = batch.num_rows
                    yield ([_plain(batch.column(k)) for k in [*names, "part"]],
                           {c: _plain(batch.column(c)).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c in state.columns})

        for out in _folded(chunks(), [*names, "_part"], 0, state):
            columns = [out.column(names.index(k)) if k in names else out.column("_part") if k == "part" else out.column(k)
                       for k in [*names, "part", *state.columns]]
            yield pa.RecordBatch.from_arrays(columns, [*names, "part", *state.columns])

    return fn


def merge_runs(runs: DataFrame, keys: list[str], state) -> DataFrame:
    """keys and the state's arrays, one row per key, from ``run_states``."""
    runs = materialize(runs)      # read twice or more; the Python pass runs once
    names = list(keys)
    if not names:      # one group: all parts in order
        last = runs.agg(F.max("part")).first()[0] or 0
        while last:
            last //= FAN_IN
            runs = (runs.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
                    .repartition("part").sortWithinPartitions("part").mapInArrow(_merge_fn(names, state), runs.schema))
        return runs.select(*state.columns)
    counts = runs.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.max("part").alias("_last"))
    n_keys, n_multi, last = counts.agg(F.count(F.lit(1)), F.count(F.when(F.col("_n") > 1, 1)), F.max("_last")).first()
    alone, several = runs, None
    if n_multi:
        several = runs
        if n_multi < n_keys:
            multi = counts.where("_n > 1").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)])
            side = F.broadcast(multi) if n_multi <= MULTI_KEYS else multi.hint("merge")
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(names)])
            alone, several = runs.join(side, same, "left_anti"), runs.join(side, same, "left_semi")
        else:
            alone = None
        while last:
            # up to FAN_IN neighbouring parts of a key side by side
            last //= FAN_IN
            several = (several.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
                       .repartition(*names, "part").sortWithinPartitions(*names, "part").mapInArrow(_merge_fn(names, state), runs.schema))
    both = alone if several is None else several if alone is None else alone.unionByName(several)
    return both.select(*names, *state.columns)
