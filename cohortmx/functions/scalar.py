"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
EXACT = 1e-12


def pair_list(d: int, diagonal: bool = True) -> list[tuple[int, int]]:
    """Upper-triangle index pairs (i <= j), row-major."""
    return [(i, j) for i in range(d) for j in range(i if diagonal else i + 1, d)]


def clamp_corr(r: Column) -> Column:
    """NULL -> NaN; values past +-1, or within EXACT of it, are +-1.

    Columns that are equal or negated give exactly +-1 then in every physical
    form of the moments, whatever the order in which they were summed.

    NULL and NaN are tested first: ``least(r, 1)`` would turn both into 1.
    """
    return (F.when(r.isNull() | F.isnan(r), F.lit(NAN))
            .when(r > 1.0 - EXACT, F.lit(1.0))
            .when(r < -1.0 + EXACT, F.lit(-1.0))
            .otherwise(r))


def safe_corr(c_ab: Column, c_aa: Column, c_bb: Column, n: Column,
              const_a: Column, const_b: Column) -> Column:
    """Pearson r from population co-moments without an ANSI division error.

    A column whose min equals its max is constant: r is NaN (its merged
    variance can be a tiny non-zero number, so the variance is not tested).
    One-row groups give NaN as well.
    """
    # one square root at a time: the product could leave the range of a double
    r = F.try_divide(F.try_divide(c_ab, F.sqrt(c_aa)), F.sqrt(c_bb))
    return (F.when((n < 2) | const_a | const_b, F.lit(NAN))
            .otherwise(clamp_corr(r)))


def fisher_z(r: Column, i: Column | None = None, j: Column | None = None) -> Column:
    """F = 0.5 * ln((1 + r) / (1 - r)) = atanh(r).

    The diagonal (by index) and r == 1 map to 0; r == -1 gives -inf; an
    undefined r (NaN) stays NaN.  ``atanh`` avoids the ANSI division error
    the quotient form raises at r = 1.
    """
    on_diag = (i == j) if i is not None and j is not None else F.lit(False)
    return (F.when(on_diag, F.lit(0.0))
            .when(r.isNull() | F.isnan(r), F.lit(NAN))
            .when(r >= 1.0, F.lit(0.0))
            .when(r <= -1.0, F.lit(float("-inf")))
            .otherwise(F.atanh(r)))


def fixed(c: Column, decimals: int) -> Column:
    """Round to a fixed number of decimals the same way DuckDB's
    ``round(v * 10^k) / 10^k`` does, and map -0.0 to 0.0.

    Used only where results are compared with an oracle; both sides compute
    the same IEEE operations, so the stored doubles are bit-identical.
    """
    scale = float(10 ** decimals)
    # one rounding per value; adding 0.0 turns -0.0 into 0.0 (IEEE)
    return F.round(c * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def sql_fixed(expr: str, decimals: int) -> str:
    """The DuckDB side of :func:`fixed`."""
    scale = f"{10 ** decimals}.0"
    v = f"(round(({expr}) * {scale}) / {scale})"
    return f"(CASE WHEN {v} = 0 THEN 0.0 ELSE {v} END)"
