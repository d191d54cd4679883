"""Per-subject column statistics and z-scoring.

Column means and deviations come from the diagonal of the moments table, so
they cost no extra pass.  Z-scored *rows* are only needed for row-level
outputs (the left factor U, ``UG``); for covariances of the z-scored stack
see :func:`cohortmx.operators.covariance.zscored_stack_cov`, which needs no
row at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .moments import _keys, array_width, diagonal, moments
from .runs import Columns, merge_runs, run_states

# Broadcast the per-subject statistics only below this size (bytes); above
# it the rows are joined by a shuffle join (AQE splits hot subjects).
BROADCAST_LIMIT = 64 * 1024 * 1024


def column_stats(df: DataFrame, key, x: str = "x", d: int | None = None, m: DataFrame | None = None) -> DataFrame:
    """``key..., k, n, mean, sd_pop, sd_samp, const``."""
    keys = _keys(key)
    m = m if m is not None else moments(df, keys, x, d)
    dg = diagonal(m, keys)
    n = F.col("n").cast("double")
    var_pop = F.when(F.col("const"), F.lit(0.0)).otherwise(F.col("var_pop"))
    return dg.select(*keys, "k", "n", "mean",
                     F.sqrt(var_pop).alias("sd_pop"),
                     F.when(F.col("n") > 1, F.sqrt(var_pop * n / (n - 1.0))).alias("sd_samp"),
                     "const")


def zscore_params(m: DataFrame, key, ddof: int = 0) -> DataFrame:
    """Per subject: arrays ``mean``, ``sd`` (ddof), ``const`` of length d.

    Built with ``collect_list`` over the d columns of one subject, so the
    group size is bounded by d, not by the data.
    """
    keys = _keys(key)
    dg = diagonal(m, keys)
    n = F.col("n").cast("double")
    sd = F.sqrt(F.try_divide(F.col("var_pop") * n, n - F.lit(float(ddof))))
    # constant column or too few rows: z is 0 (as scikit-learn's scale does)
    flat = F.col("const") | (F.col("n") <= ddof)
    items = dg.select(*keys, F.struct("k", "mean", sd.alias("sd"), flat.alias("flat")).alias("s"))
    agg = items.groupBy(*keys).agg(F.sort_array(F.collect_list("s")).alias("s"))
    # field of an array of structs: no lambda, stays in generated code
    return agg.select(*keys, F.col("s").getField("mean").alias("z_mean"),
                      F.col("s").getField("sd").alias("z_sd"), F.col("s").getField("flat").alias("z_flat"))


def column_params(df: DataFrame, key, x: str = "x", d: int | None = None, ddof: int = 0) -> DataFrame:
    """:func:`zscore_params` straight from the rows, by d means and squares a
    subject: for widths whose d x d moments nobody needs."""
    keys = _keys(key)
    d = d or array_width(df, x)
    state = Columns(d)
    s = merge_runs(run_states(df, keys, x, state), keys, state)
    n = F.col("n")[0]
    flat = F.transform(F.arrays_zip("mn", "mx"), lambda e: (e["mn"] == e["mx"]) | (n <= ddof))
    return s.select(*keys, F.col("mean").alias("z_mean"), F.transform("q", lambda q: F.sqrt(F.try_divide(q, n - F.lit(float(ddof))))).alias("z_sd"), flat.alias("z_flat"))


def apply_zscore(rows: DataFrame, params: DataFrame, key, x: str = "x", out: str = "z",
                 broadcast: bool | str = "auto", limit: int = BROADCAST_LIMIT, d: int | None = None,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """Join per-subject parameters to the rows and z-score ``x`` (JVM-side);
    ``carry`` names other columns of ``params`` that the rows get.

    ``broadcast="auto"`` checkpoints the (small) parameter table, counts it
    and broadcasts it only when subjects x d x 24 bytes fit under ``limit``;
    otherwise the rows take a shuffle join on the subject key.
    """
    keys = _keys(key)
    if broadcast == "auto" or d is None:
        params = materialize(params)
        head = params.select(F.size("z_mean")).first()
        d = d or (int(head[0]) if head is not None else 0)
    if broadcast == "auto":
        broadcast = params.count() * (24 * d + 64) <= limit
    side = F.broadcast(params) if broadcast else params
    joined = rows.join(side, keys)
    # one plain expression per region (no lambda): stays in generated code
    z = F.array(*[F.when(F.col("z_flat")[k], F.lit(0.0))
                  .otherwise(F.try_divide(F.col(x)[k] - F.col("z_mean")[k], F.col("z_sd")[k]))
                  for k in range(d)])
    other = [c for c in rows.columns if c != x]
    return joined.select(*other, *carry, z.alias(out))


def zscore(df: DataFrame, key, x: str = "x", d: int | None = None, ddof: int = 0,
           m: DataFrame | None = None, broadcast: bool | str = "auto") -> DataFrame:
    """Each subject's columns to mean 0 and variance 1 (ddof 0 default)."""
    keys = _keys(key)
    m = m if m is not None else moments(df, keys, x, d)
    return apply_zscore(df, zscore_params(m, keys, ddof), keys, x, out=x, broadcast=broadcast, d=d)
