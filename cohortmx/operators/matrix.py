"""Small-matrix algebra on long ``(by..., i, j, value)`` tables.

These act on d x d results (d regions), never on the raw rows.  Index
arithmetic replaces dense helpers: transpose swaps the index names,
multiplication joins on the inner index and sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _by(by) -> list[str]:
    if not by:
        return []
    return [by] if isinstance(by, str) else list(by)


def transpose(a: DataFrame) -> DataFrame:
    swap = {"i": F.col("j").alias("i"), "j": F.col("i").alias("j")}
    return a.select(*[swap.get(c, F.col(c)) for c in a.columns])


def multiply(a: DataFrame, b: DataFrame, by=()) -> DataFrame:
    """``(A B)_ik = sum_j A_ij B_jk`` per ``by`` group."""
    by = _by(by)
    l = a.select(*by, "i", F.col("j").alias("_m"), F.col("value").alias("_a"))
    r = b.select(*by, F.col("i").alias("_m"), F.col("j"), F.col("value").alias("_b"))
    return (l.join(r, [*by, "_m"]).groupBy(*by, "i", "j")
            .agg(F.sum(F.col("_a") * F.col("_b")).alias("value")))


def subtract(a: DataFrame, b: DataFrame, by=()) -> DataFrame:
    """``A - B``; an entry missing on one side counts as 0."""
    by = _by(by)
    l = a.select(*by, "i", "j", F.col("value").alias("_a"))
    r = b.select(*by, "i", "j", F.col("value").alias("_b"))
    return (l.join(r, [*by, "i", "j"], "full_outer")
            .select(*by, "i", "j", (F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0))).alias("value")))


def subtract_union(a: DataFrame, b: DataFrame, by=()) -> DataFrame:
    """D1 + A13: ``A - B`` as a signed union and a sum (no join)."""
    by = _by(by)
    u = (a.select(*by, "i", "j", F.col("value").alias("v"))
         .unionByName(b.select(*by, "i", "j", (-F.col("value")).alias("v"))))
    return u.groupBy(*by, "i", "j").agg(F.sum("v").alias("value"))


def frobenius(m: DataFrame, by=()) -> DataFrame:
    """A10: ``sqrt(sum(value^2))`` per group, one row each."""
    by = _by(by)
    return m.groupBy(*by).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("value"))


def distance(a: DataFrame, b: DataFrame, by=()) -> DataFrame:
    """Frobenius distance ``||A - B||_F``."""
    return frobenius(subtract(a, b, by), by)


def to_numpy(m: DataFrame, d: int | None = None) -> np.ndarray:
    """Collect one d x d matrix (bounded by d^2 entries) to the driver."""
    rows = m.select("i", "j", "value").collect()
    if d is None:
        d = 1 + max(max(r["i"], r["j"]) for r in rows) if rows else 0
    out = np.zeros((d, d))
    for r in rows:
        out[r["i"], r["j"]] = r["value"]
    return out


def from_numpy(spark: SparkSession, a: np.ndarray, extra: dict | None = None) -> DataFrame:
    """A small dense matrix as a long ``(extra..., i, j, value)`` table."""
    extra = extra or {}
    a = np.atleast_2d(a)
    rows = [(*extra.values(), int(i), int(j), float(a[i, j])) for i in range(a.shape[0]) for j in range(a.shape[1])]
    cols = [*extra.keys(), "i", "j", "value"]
    return spark.createDataFrame(rows, cols).select(
        *[F.col(c) for c in extra], F.col("i").cast("int"), F.col("j").cast("int"), F.col("value").cast("double"))


def dense_rows(m: DataFrame, d: int, by: Sequence[str] = ()) -> DataFrame:
    """Pivot to one row per ``i`` with columns ``c0..c{d-1}`` (for CSV sinks)."""
    by = list(by)
    p = m.groupBy(*by, "i").pivot("j", list(range(d))).agg(F.first("value"))
    return p.select(*by, "i", *[F.col(str(j)).alias(f"c{j}") for j in range(d)]).orderBy(*by, "i")
