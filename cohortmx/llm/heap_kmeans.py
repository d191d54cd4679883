"""Exact k-means over integer vectors with heap-ordered bounds.

A vector's gap is the distance to its second nearest centroid less that to its
nearest one.  When centroids move, the gap of a vector of cluster j shrinks by
at most drift(j) + the largest drift of the others; ``offset[j]`` adds these up
over the rounds.  A vector enters its cluster's heap with the key gap + offset,
so it needs no touch until the offset has caught up with the key: each round
pops the keys that expired, compares just these vectors with all centroids, and
pushes them with new keys.  Sums and counts change by the moved vectors alone.

Vectors lie in blocks of a few thousand, written once, bucketed by block.  The
heaps of a block are one row, rewritten each round (12 bytes a vector): keys
ascending for each cluster (a sorted array is a heap; what expired is its
head).  A round joins heaps and blocks by bucket, without a shuffle, and reads
only blocks with an expired key.  The driver sees centroids and their sums.

Distances are compared as exact integers, so ties go to the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmx.llm.common import small_batches, written
from cohortmx.session import bucketed

DIM, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED = 8, 10, 3
LARGEST = 1 << 27       # of a component: 64 * (2 * LARGEST) ** 2 fits a long
EXACT = 1 << 22         # up to here products are exact in doubles
SLACK = 1e-6            # keys this near to expiry count as expired: rounding of roots

BLOCKS = "block long, vec_ids array<bigint>, vectors binary"
HEAPS = "block long, sizes array<int>, tops array<double>, keys binary, slots binary, moved array<bigint>"


def kept(embeddings: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array<int>: floor(scale * component)) of the vectors with
    ``dim`` components, all of them finite numbers.  A component beyond
    LARGEST / scale raises: its distance might not fit a long."""
    real = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    whole = (F.size("embedding") == dim) & F.forall("embedding", lambda e: F.coalesce(real(e), F.lit(False)))

    def component(e: F.Column) -> F.Column:
        v = F.floor(e.cast("double") * scale)
        return F.when(F.abs(e.cast("double") * scale) < LARGEST - 1, v.cast("int")).otherwise(F.raise_error(F.lit("a component is too large")).cast("int"))

    return (embeddings.where(F.coalesce(whole, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", component).alias("x")))


def seeds(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:vec_id``, in that order
    (equal hashes: by components); fewer if there are fewer ids."""
    ranked = vectors.where("vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "x")
    first = ranked.orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in first], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``c`` (int64)."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x.astype(np.int64) - row) ** 2).sum(1) for row in c], axis=1)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, gap to the next) of every row of ``x``."""
    far = squared(x, c)
    best = far.argmin(axis=1)
    rows = np.arange(len(x))
    near = np.sqrt(far[rows, best].astype(np.float64))
    if len(c) == 1:
        return best, np.full(len(x), np.inf)
    far[rows, best] = np.iinfo(np.int64).max
    return best, np.sqrt(far.min(axis=1).astype(np.float64)) - near


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first, n = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        ids = pa.array([batch.column("vec_id").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([first + n], pa.int64()), ids, pa.array([x.tobytes()], pa.binary())], ["block", "vec_ids", "vectors"])
        n += 1


def _heaps(batch: pa.RecordBatch, i: int, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, slots) of each cluster from row ``i``."""
    cuts = np.cumsum(batch.column("sizes")[i].as_py())[:-1]
    keys = np.frombuffer(batch.column("keys")[i].as_py(), np.float64)
    slots = np.frombuffer(batch.column("slots")[i].as_py(), np.int32)
    return list(zip(np.split(keys, cuts), np.split(slots, cuts)))


def _pushed(heap: tuple[np.ndarray, np.ndarray], keys: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    at = np.searchsorted(heap[0], keys[order])
    return np.insert(heap[0], at, keys[order]), np.insert(heap[1], at, slots[order])


def _row(block: int, heaps: list[tuple[np.ndarray, np.ndarray]], moved: np.ndarray) -> pa.RecordBatch:
    tops = [float(keys[0]) if len(keys) else float("inf") for keys, _ in heaps]
    columns = [pa.array([block], pa.int64()), pa.array([[len(keys) for keys, _ in heaps]], pa.list_(pa.int32())), pa.array([tops], pa.list_(pa.float64())),
               pa.array([np.concatenate([h[0] for h in heaps]).astype(np.float64).tobytes()], pa.binary()),
               pa.array([np.concatenate([h[1] for h in heaps]).astype(np.int32).tobytes()], pa.binary()), pa.array([moved.ravel()], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["block", "sizes", "tops", "keys", "slots", "moved"])


def _change(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """k rows: count, then sums of components."""
    out = np.zeros((k, 1 + x.shape[1]), np.int64)
    for j in np.unique(cluster):
        rows = x[cluster == j]
        out[j, 0], out[j, 1:] = len(rows), rows.sum(axis=0, dtype=np.int64)
    return out


def _scan(centroids: np.ndarray):
    """Blocks -> heaps of all their vectors, at offset 0; moved: what joined each cluster."""
    k, dim = centroids.shape

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("vectors")[i].as_py(), np.int32).reshape(-1, dim)
                best, gap = nearest(x, centroids)
                order = np.argsort(gap, kind="stable").astype(np.int32)
                yield _row(batch.column("block")[i].as_py(), [(gap[own], own) for own in (order[best[order] == j] for j in range(k))], _change(x, best, k))

    return fn


def _rescan(centroids: np.ndarray, offset: np.ndarray):
    """Heaps and vectors of blocks -> heaps with expired keys popped, their
    vectors compared with all centroids and pushed; moved: joined less left."""
    k, dim = centroids.shape

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                heaps, popped, left = _heaps(batch, i, k), [], []
                for j, (keys, slots) in enumerate(heaps):
                    n = int(np.searchsorted(keys, offset[j] + SLACK, side="right"))
                    popped.append(slots[:n])
                    left.append(np.full(n, j))
                    heaps[j] = (keys[n:], slots[n:])
                slots, old = np.concatenate(popped), np.concatenate(left)
                x = np.frombuffer(batch.column("vectors")[i].as_py(), np.int32).reshape(-1, dim)[slots]
                best, gap = nearest(x, centroids)
                for j in np.unique(best):
                    own = best == j
                    heaps[j] = _pushed(heaps[j], gap[own] + offset[j], slots[own])
                new = best != old
                yield _row(batch.column("block")[i].as_py(), heaps, _change(x[new], best[new], k) - _change(x[new], old[new], k))

    return fn


def _assigned(centroids: np.ndarray):
    k, dim = centroids.shape

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("vectors")[i].as_py(), np.int32).reshape(-1, dim)
                cluster, far = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
                for j, (_, slots) in enumerate(_heaps(batch, i, k)):
                    cluster[slots] = j
                    far[slots] = squared(x[slots], centroids[j:j + 1])[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column("vec_ids")[i].values, pa.array(cluster), pa.array(far)], ["vec_id", "cluster", "distance"])

    return fn


def _totals(heaps: DataFrame, k: int) -> np.ndarray:
    """k rows: change of count and sums, over all blocks that were scanned."""
    rows = heaps.where("moved IS NOT NULL").select(F.posexplode("moved").alias("p", "v")).groupBy("p").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(k * (1 + DIM), object)
    for r in rows:
        out[r["p"]] = r["v"]
    return out.reshape(k, -1)


def fit(vectors: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(blocks, heaps, centroids) after ``rounds`` rounds and a last assignment.

    ``vectors``: vec_id, x.  A round ends early when no centroid moves: later
    ones would change nothing.
    """
    small_batches(vectors.sparkSession)
    k = len(centroids)
    blocks = bucketed(vectors.mapInArrow(_blocks, BLOCKS), "block")
    heaps = bucketed(blocks.mapInArrow(_scan(centroids), HEAPS), "block", dealt=True)
    totals, offset = _totals(heaps, k), np.zeros(k)
    for _ in range(rounds):
        after = np.array([[int(s) // int(row[0]) for s in row[1:]] if row[0] else list(c) for row, c in zip(totals, centroids)], np.int64)
        drift = np.sqrt(((after - centroids).astype(np.float64) ** 2).sum(axis=1))
        if not drift.any():
            break
        centroids = after
        others = np.array([max([d for i, d in enumerate(drift) if i != j], default=0.0) for j in range(k)])
        offset = offset + drift + others
        expired = F.lit(False)
        for j in range(k):
            expired = expired | (F.col("tops")[j] <= float(offset[j] + SLACK))
        popped = (heaps.where(expired).select("block", "sizes", "keys", "slots").join(blocks.select("block", "vectors"), "block")
                  .mapInArrow(_rescan(centroids, offset), HEAPS))
        heaps = bucketed(popped.unionByName(heaps.where(~expired).withColumn("moved", F.lit(None).cast("array<bigint>"))), "block", dealt=True)
        totals = totals + _totals(heaps, k)
    return blocks, heaps, centroids


def cluster(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Vectors of another length, and those with a null or non-finite component,
    are left out.  A null vec_id is kept but can't be a first centroid;
    repeated ids are vectors of their own.  With fewer than ``k`` ids there are
    as many centroids as ids; without any, or without rows, there are no rows.
    Other columns are ignored.
    """
    spark = embeddings.sparkSession
    vectors = written(kept(embeddings))
    first = seeds(vectors, k, seed)
    if not len(first):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks, heaps, centroids = fit(vectors, first, rounds)
    placed = written(heaps.select("block", "sizes", "keys", "slots").join(blocks, "block").mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"))
    inertia = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    of_cluster = spark.createDataFrame([(j, s, digest[j]) for j, s in inertia.items()], "cluster int, cluster_inertia long, centroid_sha256 string")
    return (placed.join(F.broadcast(of_cluster), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(inertia.values())).cast("long").alias("inertia"), "centroid_sha256"))
