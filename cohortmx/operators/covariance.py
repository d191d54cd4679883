"""Sample covariances, from the moments table.

Z-scored stack without rows: inside one subject, the z-scored columns have
Gram matrix ``(n - ddof_z) * R`` where R is the subject's correlation matrix
(a constant column z-scores to 0 and contributes 0).  The stacked rows of
all subjects in a split have mean 0, so

    C_split = sum_s (n_s - ddof_z) * R_s / (N_split - 1)

and the Gram matrix of the stack is the numerator.  This is an aggregate of
the small per-subject table: the raw rows are read once, by the moments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from .moments import _keys, mirror, moments
from .summarise import attach_split

NAN = float("nan")


def cov_from_moments(m: DataFrame, key=(), ddof: int = 1) -> DataFrame:
    """``key..., i, j, value``: sample (ddof 1) or population covariance."""
    keys = _keys(key) if key else []
    n = F.col("n").cast("double")
    val = F.when(n > ddof, F.col("c_ij") * n / (n - F.lit(float(ddof)))).otherwise(F.lit(NAN))
    return mirror(m.select(*keys, "i", "j", val.alias("value")), keys, ["value"])


def cov_matrix(df: DataFrame, by, x: str = "x", d: int | None = None, ddof: int = 1, method: str = "auto") -> DataFrame:
    """Covariance of ``x`` per ``by`` group (no z-scoring)."""
    return cov_from_moments(moments(df, by, x, d, method), by, ddof)


def zscored_contributions(m: DataFrame, key, ddof_z: int = 0) -> DataFrame:
    """Per subject and i <= j: ``n`` and the z-scored cross-product sum.

    A constant column or a subject of fewer than two rows z-scores to 0 and
    contributes 0; an undefined r of any other cause (NaN values) stays NaN.
    """
    c = F.col
    nn = c("n").cast("double") - F.lit(float(ddof_z))
    flat = c("const_i") | c("const_j") | (c("n") < 2) | (nn <= 0)
    r = F.when(c("i") == c("j"), F.when(F.isnan("c_ii"), F.lit(NAN)).otherwise(F.lit(1.0))).otherwise(
        scalar.safe_corr(c("c_ij"), c("c_ii"), c("c_jj"), c("n"), c("const_i"), c("const_j")))
    return m.select(*_keys(key), "i", "j", "n", F.when(flat, F.lit(0.0)).otherwise(nn * r).alias("w"))


def zscored_sums(m: DataFrame, key, ddof_z: int = 0, split: str = "split") -> DataFrame:
    """``split, i, j, s, N`` (i <= j): cross-product sums and row counts of the
    z-scored rows per split, from moments that carry their subject's split.
    ``s`` is the Gram matrix, ``s / (N - ddof)`` the covariance."""
    contrib = zscored_contributions(m, [*_keys(key), split], ddof_z)
    return contrib.groupBy(split, "i", "j").agg(F.sum("w").alias("s"), F.sum("n").alias("N"))


def zscored_stack_cov(m: DataFrame, key, splits: DataFrame | None = None, ddof_z: int = 0,
                      ddof: int = 1, gram: bool = False) -> DataFrame:
    """T4: covariance (or, with ``gram=True``, the Gram matrix ``X^T X``) of
    the z-scored rows stacked per split: ``split, i, j, value``.

    ``splits`` maps each subject to a split (``key, split``); without it
    every subject is in one split named 'all'.
    """
    keys = _keys(key)
    labelled = attach_split(m, splits, keys[0]) if splits is not None else m.withColumn("split", F.lit("all"))
    sums = zscored_sums(labelled, keys, ddof_z)
    value = F.col("s") if gram else F.col("s") / (F.col("N").cast("double") - F.lit(float(ddof)))
    return mirror(sums.select("split", "i", "j", value.alias("value")), ["split"], ["value"])
