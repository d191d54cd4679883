"""Per-group second moments: the one pass over the raw rows.

Every matrix result of the library (correlation, Fisher z, z-scored
covariance, the Gram matrix behind the factorisation) is a function of each
subject's ``(n, mean, centred co-moments, constant flags)``.  This module
computes them once, as a long table with one row per group and index pair
``i <= j``::

    key..., i INT, j INT, n LONG, mean_i, mean_j DOUBLE,
    c_ij, c_ii, c_jj DOUBLE      -- population (co)variances, co-moment / n
    const_i, const_j BOOLEAN     -- column is constant in the group (min = max)

Three physical forms produce the same table:

``wide``    Catalyst only, for narrow rows (d <= 8): one hash aggregate per
            key with d(d+1)/2 ``covar_pop`` columns plus d ``avg``/``min``/
            ``max``, unpivoted afterwards.  No explode; partial aggregation
            on every map task handles hot keys.  Fastest for small d.

``pairs``   Catalyst only.  Each row is exploded into its d(d+1)/2 index
            pairs and ``covar_pop``/``avg``/``min``/``max`` run as ordinary
            partial + final hash aggregates keyed by ``(key, i, j)``.  A hot
            key is pre-aggregated on every map task, so skew never reaches
            one task.  ``c_ii`` and ``c_jj`` are computed inside the same
            group as ``c_ij``, so two equal columns give r = 1 exactly and a
            negated one r = -1 exactly.

``chunks``  For wide rows (d(d+1)/2 pairs per row is too many): rows are
            sorted by key inside each partition (no shuffle) and an Arrow
            function computes ``n, mean, X_c^T X_c`` per contiguous run of
            a key with numpy; runs are merged exactly (Chan et al.) as packed
            arrays, in steps of bounded size (:mod:`.runs`).  The arrays
            become one row per pair only after the merge.

``tiles``   For rows so wide that d^2 / 2 doubles a subject are too many for
            one state: columns are cut into tiles, every row goes to each
            pair of tiles with its values in these two, and each (key, pair of
            tiles) is a chunk form of its own.  A task holds (2 tiles)^2 / 2
            doubles a state, whatever d; rows are copied once for each tile.

:func:`pairwise_moments` gives the same table for rows with gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import pair_list
from .runs import Complete, Pairwise, merge_runs, run_states

# Up to this many regions one wide aggregate; above it the Arrow chunks.
# (sf0.1 lineitem, local[8]: d=4 wide 0.7 s, pairs 1.9 s, chunks 4.8 s;
#  d=15 wide 20 s, pairs 28 s, chunks 8.6 s.)
WIDE_MAX_D = 8

# Beyond so many regions a state of d^2 / 2 doubles (8 MB) is parted into tiles.
CHUNK_MAX_D, TILE = 1448, 512
PAIRWISE_WIDE_MAX_D = 4   # eight aggregates a pair there
MOMENT_COLS = ["i", "j", "n", "mean_i", "mean_j", "c_ij", "c_ii", "c_jj", "const_i", "const_j"]


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def array_width(df: DataFrame, x: str = "x") -> int:
    """Length of the measurement array, read from one row (a cheap action)."""
    row = df.select(F.size(x).alias("d")).where(F.col("d") > 0).first()
    if row is None:
        raise ValueError("no rows with a non-empty measurement array")
    return int(row["d"])


def moments(df: DataFrame, key, x: str = "x", d: int | None = None, method: str = "auto",
            cluster: bool | int = False) -> DataFrame:
    """Long moments table (see module doc) of ``x`` grouped by ``key``.

    ``x`` must hold complete observations (no NULL entries): the sources
    raise on incomplete rows, or leave them out and count them, before this
    step; :func:`pairwise_moments` takes rows with gaps.  A row of another
    length than ``d`` raises.

    ``cluster`` (for the chunk form): first range-partition the rows by
    ``(key, hash of the row)`` into ``cluster`` partitions (``True``: the
    session's shuffle partition count).  Spark samples the data to balance
    the partitions, so small keys stay whole and a hot key is split over as
    many partitions as its size needs; the run table then has at most
    keys + partitions rows.  Use it when the input scatters every key over
    every partition; leave it off when rows of a key already sit together
    (one file per subject).
    """
    keys = _keys(key)
    d = d or array_width(df, x)
    df = df.withColumn(x, F.when(F.size(x) == d, F.col(x)).otherwise(
        F.raise_error(F.lit(f"a row of {x} does not hold {d} values"))))
    df = _clustered(df, keys, x, cluster)
    if method == "auto":
        method = "wide" if d <= WIDE_MAX_D else "chunks" if d <= CHUNK_MAX_D else "tiles"
    if method == "wide":
        return _wide_moments(df, keys, x, d)
    if method == "pairs":
        return _pair_moments(df, keys, x, d)
    if method == "chunks":
        return _chunk_moments(df, keys, x, d)
    if method == "tiles":
        return _tile_moments(df, keys, x, d)
    raise ValueError(f"unknown method {method!r}")


def _clustered(df: DataFrame, keys: list[str], x: str, cluster: bool | int) -> DataFrame:
    if not cluster:
        return df
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if cluster is True else int(cluster)
    return df.repartitionByRange(n, *[F.col(k) for k in keys], F.xxhash64(F.col(x)))


# ---------------------------------------------------------------- wide form

def _wide_moments(df: DataFrame, keys: list[str], x: str, d: int) -> DataFrame:
    kc = [F.col(k) for k in keys]
    xs = [F.col(x)[k] for k in range(d)]
    aggs = [F.count(F.lit(1)).alias("n")]
    for k in range(d):
        aggs += [F.avg(xs[k]).alias(f"_m{k}"), (F.min(xs[k]) == F.max(xs[k])).alias(f"_k{k}")]
    for i, j in pair_list(d):
        # c_ii is the same aggregate as c_ij with i = j: same rows, same
        # merge order, so equal columns still give r = 1 exactly
        aggs.append(F.covar_pop(xs[i], xs[j]).alias(f"_c{i}_{j}"))
    wide = df.groupBy(*kc).agg(*aggs)

    def cell(i, j):
        return F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"_m{i}").alias("mean_i"),
                        F.col(f"_m{j}").alias("mean_j"), F.col(f"_c{i}_{j}").alias("c_ij"),
                        F.col(f"_c{i}_{i}").alias("c_ii"), F.col(f"_c{j}_{j}").alias("c_jj"),
                        F.col(f"_k{i}").alias("const_i"), F.col(f"_k{j}").alias("const_j"))

    long = wide.select(*kc, "n", F.inline(F.array(*[cell(i, j) for i, j in pair_list(d)])))
    return long.select(*kc, *MOMENT_COLS)


# ---------------------------------------------------------------- pairs form

def _pair_moments(df: DataFrame, keys: list[str], x: str, d: int) -> DataFrame:
    kc = [F.col(k) for k in keys]
    # i from the first explode, j >= i from a slice of the same array: the
    # "every region with every region" pairing happens inside the row,
    # without any join or shuffle.
    one = df.select(*kc, F.posexplode(x).alias("i", "a"), F.col(x).alias("_x"))
    two = one.select(*kc, "i", "a",
                     F.posexplode(F.slice("_x", F.col("i") + 1, F.lit(d) - F.col("i"))).alias("_dj", "b"))
    two = two.withColumn("j", (F.col("i") + F.col("_dj")).cast("int")).withColumn("i", F.col("i").cast("int"))
    a, b = F.col("a"), F.col("b")
    agg = two.groupBy(*kc, "i", "j").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(a).alias("mean_i"),
        F.avg(b).alias("mean_j"),
        F.covar_pop(a, b).alias("c_ij"),
        F.covar_pop(a, a).alias("c_ii"),
        F.covar_pop(b, b).alias("c_jj"),
        (F.min(a) == F.max(a)).alias("const_i"),
        (F.min(b) == F.max(b)).alias("const_j"),
    )
    return agg.select(*kc, *MOMENT_COLS)


# ---------------------------------------------------------------- chunk form

def _cell(i, j, d: int):
    """Place of (i, j), i <= j, in a packed upper triangle."""
    return (i * F.lit(d) - (i * (i - F.lit(1))) / F.lit(2) + (j - i)).cast("int")


def _cells(states: DataFrame, d: int) -> DataFrame:
    """``states`` once for each index pair i <= j, generated on the executors
    from two ``sequence`` explodes (no d^2 literal arrays)."""
    return (states.select("*", F.explode(F.sequence(F.lit(0), F.lit(d - 1))).alias("i"))
            .select("*", F.explode(F.sequence(F.col("i"), F.lit(d - 1))).alias("j")))


def _chunk_moments(df: DataFrame, keys: list[str], x: str, d: int) -> DataFrame:
    state = Complete(d)
    out = _cells(merge_runs(run_states(df, keys, x, state), keys, state), d)
    n, i, j = F.col("n")[0], F.col("i"), F.col("j")
    const = lambda c: F.col("mn")[c] == F.col("mx")[c]
    m2 = lambda a, b: F.col("m2")[_cell(a, b, d)] / n
    return out.select(*[F.col(k) for k in keys], i.cast("int").alias("i"), j.cast("int").alias("j"), n.cast("long").alias("n"),
                      F.col("mean")[i].alias("mean_i"), F.col("mean")[j].alias("mean_j"),
                      m2(i, j).alias("c_ij"), m2(i, i).alias("c_ii"), m2(j, j).alias("c_jj"), const(i).alias("const_i"), const(j).alias("const_j"))


def _tile_moments(df: DataFrame, keys: list[str], x: str, d: int, tile: int | None = None) -> DataFrame:
    tile = tile or TILE
    n = -(-d // tile)
    if n < 3:
        return _chunk_moments(df, keys, x, d)
    # tiles are padded with zeros to one width; pair (a, b), a < b, also yields the cells
    # within a of b = a + 1, and the last one those within b
    padded = F.concat(F.col(x).cast("array<double>"), F.array_repeat(F.lit(0.0), n * tile - d)) if n * tile > d else F.col(x).cast("array<double>")
    pairs = F.array(*[F.struct(F.lit(a).alias("_a"), F.lit(b).alias("_b")) for a in range(n) for b in range(a + 1, n)])
    rows = (df.select(*keys, padded.alias("_all")).select(*keys, "_all", F.inline(pairs))
            .select(*keys, "_a", "_b", F.concat(F.slice("_all", F.col("_a") * tile + 1, F.lit(tile)),
                                                F.slice("_all", F.col("_b") * tile + 1, F.lit(tile))).alias("_x")))
    cells = _chunk_moments(rows, [*keys, "_a", "_b"], "_x", 2 * tile)
    i, j, a, b = (F.col(c) for c in ("i", "j", "_a", "_b"))
    cross = (i < tile) & (j >= tile)
    first = (i < tile) & (j < tile) & (b == a + 1)
    last = (i >= tile) & (j >= tile) & (a == n - 2) & (b == n - 1)
    at = lambda c: F.when(c < tile, a * tile + c).otherwise((b - 1) * tile + c).cast("int")
    out = cells.where(cross | first | last).withColumns({"i": at(i), "j": at(j)}).where(F.col("j") < d)
    return out.select(*keys, *MOMENT_COLS)


# ---------------------------------------------------------------- pairwise complete

def pairwise_moments(df: DataFrame, key, x: str = "x", d: int | None = None, method: str = "auto",
                     cluster: bool | int = False) -> DataFrame:
    """The moments table for rows with gaps: every pair (i, j) over the rows
    that have both values, so ``n``, the means, variances and constant flags
    are those of these rows and differ from pair to pair.

    A gap is a NULL in ``x`` (or a NULL ``x``); NaN is a value and spreads.  A
    pair that no row has both values of is there with n = 0.  Forms as in
    :func:`moments`: ``wide`` up to PAIRWISE_WIDE_MAX_D regions, ``pairs``,
    ``chunks``.  A row of another length than ``d`` raises.  ``cluster`` as
    there: a state here is 5 d^2 doubles, as large as some 5 d rows, so keys
    that lie scattered in smaller runs make more states than there are rows.
    """
    keys = _keys(key)
    d = d or array_width(df, x)
    df = df.withColumn(x, F.when(F.col(x).isNull() | (F.size(x) == d), F.col(x)).otherwise(
        F.raise_error(F.lit(f"a row of {x} does not hold {d} values"))))
    df = _clustered(df, keys, x, cluster)
    if method == "auto":
        method = "wide" if d <= PAIRWISE_WIDE_MAX_D else "chunks"
    if method == "wide":
        return _wide_pairwise(df, keys, x, d)
    if method == "pairs":
        return _pair_pairwise(df, keys, x, d)
    if method == "chunks":
        return _chunk_pairwise(df, keys, x, d)
    raise ValueError(f"unknown method {method!r}")


def _pair_aggs(a, b) -> dict[str, F.Column]:
    """Aggregates of a pair of values over the rows that have both."""
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return {"n": F.count(a), "mean_i": F.avg(a), "mean_j": F.avg(b), "c_ij": F.covar_pop(a, b), "c_ii": F.covar_pop(a, a),
            "c_jj": F.covar_pop(b, b), "const_i": F.min(a) == F.max(a), "const_j": F.min(b) == F.max(b)}


def _wide_pairwise(df: DataFrame, keys: list[str], x: str, d: int) -> DataFrame:
    kc = [F.col(k) for k in keys]
    aggs, cells = [], []
    for i, j in pair_list(d):
        own = _pair_aggs(F.col(x)[i], F.col(x)[j])
        aggs += [agg.alias(f"{name}_{i}_{j}") for name, agg in own.items()]
        cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), *[F.col(f"{name}_{i}_{j}").alias(name) for name in own]))
    return df.groupBy(*kc).agg(*aggs).select(*kc, F.inline(F.array(*cells))).select(*kc, *MOMENT_COLS)


def _pair_pairwise(df: DataFrame, keys: list[str], x: str, d: int) -> DataFrame:
    kc = [F.col(k) for k in keys]
    whole = df.select(*kc, F.coalesce(F.col(x), F.array_repeat(F.lit(None).cast("double"), d)).alias("_x"))
    one = whole.select(*kc, "_x", F.posexplode("_x").alias("i", "a"))
    two = one.select(*kc, "i", "a", F.posexplode(F.slice("_x", F.col("i") + 1, F.lit(d) - F.col("i"))).alias("_dj", "b"))
    return (two.withColumn("j", F.col("i") + F.col("_dj")).groupBy(*kc, "i", "j")
            .agg(*[agg.alias(name) for name, agg in _pair_aggs(F.col("a"), F.col("b")).items()]).select(*kc, *MOMENT_COLS))


def _chunk_pairwise(df: DataFrame, keys: list[str], x: str, d: int) -> DataFrame:
    state = Pairwise(d)
    out = _cells(merge_runs(run_states(df, keys, x, state), keys, state), d)
    at = _cell(F.col("i"), F.col("j"), d)
    n = F.col("n")[at]
    some = lambda c: F.when(n > 0, F.col(c)[at])        # noqa: E731
    return out.select(*[F.col(k) for k in keys], F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), n.cast("long").alias("n"),
                      some("mi").alias("mean_i"), some("mj").alias("mean_j"), (some("c") / n).alias("c_ij"), (some("qi") / n).alias("c_ii"),
                      (some("qj") / n).alias("c_jj"), (some("mni") == F.col("mxi")[at]).alias("const_i"), (some("mnj") == F.col("mxj")[at]).alias("const_j"))


# ---------------------------------------------------------------- helpers

def diagonal(m: DataFrame, key) -> DataFrame:
    """Per key and column: n, mean, population variance, constant flag."""
    kc = [F.col(k) for k in _keys(key)]
    return m.where(F.col("i") == F.col("j")).select(
        *kc, F.col("i").alias("k"), "n", F.col("mean_i").alias("mean"),
        F.col("c_ii").alias("var_pop"), F.col("const_i").alias("const"))


def mirror(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Upper triangle (i <= j) -> full d x d grid, by an explode (no union,
    so the input plan runs once)."""
    kc = [F.col(k) for k in key]
    payload = [F.col(c) for c in cols]
    up = F.struct(F.col("i").alias("i"), F.col("j").alias("j"), *payload)
    lo = F.struct(F.col("j").alias("i"), F.col("i").alias("j"), *payload)
    both = F.when(F.col("i") < F.col("j"), F.array(up, lo)).otherwise(F.array(up))
    return df.select(*kc, F.inline(both))
