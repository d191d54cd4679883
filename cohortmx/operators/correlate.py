"""Per-subject correlation matrix and its Fisher z-transform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from .moments import _keys, mirror, moments, pairwise_moments

NAN = float("nan")


def corr_from_moments(m: DataFrame, key, keep_n: bool = False, full: bool = True) -> DataFrame:
    """``key..., i, j, r`` over the full d x d grid (``full=False``: only
    i <= j, for statistics that are mirrored after aggregating).

    Off-diagonal r comes from the population co-moments of the same group;
    the diagonal is 1 for a column with at least two distinct values and NaN
    otherwise (constant column or a single row).
    """
    keys = _keys(key)
    c = F.col
    r = (F.when(c("i") == c("j"),
                F.when((c("n") < 2) | c("const_i"), F.lit(NAN)).otherwise(F.lit(1.0)))
         .otherwise(scalar.safe_corr(c("c_ij"), c("c_ii"), c("c_jj"), c("n"), c("const_i"), c("const_j"))))
    extra = ["n"] if keep_n else []
    up = m.select(*keys, "i", "j", r.alias("r"), *extra)
    return mirror(up, keys, ["r", *extra]) if full else up


def corr_matrix(df: DataFrame, key, x: str = "x", d: int | None = None, method: str = "auto", pairwise: bool = False,
                cluster: bool | int = False) -> DataFrame:
    """A1: Pearson correlation of the columns of ``x`` within each ``key`` group.

    ``pairwise``: ``x`` may hold NULLs, and r of a pair of columns is that of
    the rows which have both values (NaN for fewer than two).  ``cluster`` as
    in :func:`.moments.moments`.
    """
    m = (pairwise_moments if pairwise else moments)(df, key, x, d, method, cluster)
    return corr_from_moments(m, key)


def fisher_z(corr: DataFrame, undefined: str = "nan") -> DataFrame:
    """Add ``f = atanh(r)``, 0 on the diagonal and where r == 1.

    ``undefined="skip"`` drops entries whose r is undefined (constant column,
    one-row subject) instead of carrying NaN into later means.
    """
    out = corr.withColumn("f", scalar.fisher_z(F.col("r"), F.col("i"), F.col("j")))
    if undefined == "skip":
        out = out.where(~F.isnan("f"))
    elif undefined != "nan":
        raise ValueError("undefined must be 'nan' or 'skip'")
    return out
