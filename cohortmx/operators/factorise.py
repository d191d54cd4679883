"""Low-rank factorisation ``X_train ~ U G`` of the z-scored stack.

Three ways to the singular values and right vectors of the tall stack:

``gram``    ``X^T X = V diag(s^2) V^T``, from the moments that other results
            need anyway (``zscored_stack_cov(..., gram=True)``): no pass over
            the rows of its own.  Squares the condition number, so singular
            values below about ``s_max * sqrt(eps)`` are noise.
``tsqr``    R of a QR factorisation: one d x d triangle per Arrow batch, merged
            in a tree; the SVD of the last R has the singular values of the
            stack to working accuracy.  One pass over the rows.
``random``  k of many regions: a block Krylov space of X^T X from a random start,
            one pass over the rows for each block, nothing of size d x d on
            the executors; ends when the residual of the k vectors is small.

Only matrices of at most d x d reach the driver, where numpy factors them.  Then

    G = diag(s) V^T            (k x d)
    U = X V diag(1/s)          (rows; an Arrow map with a d x k matrix)
    UG = X P, P = V_k V_k^T     (rows; same)
    cov(UG) = P C_train P      (closed form: UG is a linear map of X)

Each component is unique up to sign: the largest-magnitude entry of every
column of V is made positive.  Singular values are reported as they come; for
U alone, those below the accuracy of the method (``tol``) count as zero (their U
column is 0), which avoids dividing by a rounding residue on rank-deficient stacks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .matrix import from_numpy
from .moments import _keys, array_width
from .runs import Complete, Product, Triangle, merge_runs, run_states


@dataclass
class Factors:
    spark: SparkSession
    s: np.ndarray        # k singular values, descending
    v: np.ndarray        # d x k right singular vectors
    k: int
    d: int
    tol: float

    @property
    def g(self) -> np.ndarray:
        return np.diag(self.s) @ self.v.T

    @property
    def projector(self) -> np.ndarray:
        return self.v @ self.v.T

    def g_matrix(self) -> DataFrame:
        return from_numpy(self.spark, self.g)

    def singular_values(self) -> DataFrame:
        return self.spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(self.s)],
                                          "component int, s double")

    def cov_ug(self, c_train: np.ndarray) -> np.ndarray:
        p = self.projector
        return p @ c_train @ p

    def left_map(self) -> np.ndarray:
        """d x k matrix M with U = X M."""
        inv = np.where(self.s > self.tol, 1.0 / np.where(self.s > self.tol, self.s, 1.0), 0.0)
        return self.v * inv[None, :]

    def u_rows(self, z_rows: DataFrame, x: str = "x", keep: Sequence[str] | None = None) -> DataFrame:
        """``keep..., u`` with ``u = x M`` per row."""
        return _row_map(z_rows, x, self.left_map(), "u", keep)

    def ug_rows(self, z_rows: DataFrame, x: str = "x", keep: Sequence[str] | None = None) -> DataFrame:
        """Reconstruction ``UG = X P`` per row."""
        return _row_map(z_rows, x, self.projector, "ug", keep)


def _factors(spark: SparkSession, s: np.ndarray, v: np.ndarray, k: int | None, accuracy: float) -> Factors:
    """Factors of descending ``s`` and their vectors, cut to ``k``, with signs fixed."""
    d = len(v)
    k = len(s) if k is None else int(k)
    if not 1 <= k <= len(s):
        raise ValueError(f"k must be in 1..{len(s)}")
    # sign convention: largest |entry| of each right singular vector positive
    at = np.argmax(np.abs(v), axis=0)
    sign = np.where(v[at, np.arange(v.shape[1])] < 0, -1.0, 1.0)
    return Factors(spark=spark, s=s[:k], v=(v * sign)[:, :k], k=k, d=d, tol=s[0] * accuracy * d)


def factor_gram(spark: SparkSession, gram: np.ndarray, k: int | None = None) -> Factors:
    """X1/X2 from a symmetric d x d Gram matrix."""
    w, v = np.linalg.eigh((gram + gram.T) / 2.0)
    order = np.argsort(w)[::-1]
    return _factors(spark, np.sqrt(np.clip(w[order], 0.0, None)), v[:, order], k, np.sqrt(np.finfo(float).eps))


def factor_triangle(spark: SparkSession, r: np.ndarray, k: int | None = None) -> Factors:
    """X1/X2 from the triangle R of the stack's QR factorisation."""
    _, s, vt = np.linalg.svd(r)
    return _factors(spark, s, vt.T, k, np.finfo(float).eps)


def tall_r(rows: DataFrame, x: str = "x", d: int | None = None, by=()) -> DataFrame:
    """``by..., r``: the d x d triangle (row-major, diagonal not negative) of
    the QR factorisation of each group's rows.  A NULL or NaN in a row raises."""
    by = _keys(by) if by else []
    state = Triangle(d or array_width(rows, x))
    return merge_runs(run_states(rows, by, x, state), by, state)


def factor_rows(rows: DataFrame, x: str = "x", d: int | None = None, k: int | None = None) -> Factors:
    """``tsqr``: the factors of all rows of ``x``, one pass over them."""
    d = d or array_width(rows, x)
    found = tall_r(rows, x, d).first()
    if found is None:
        raise ValueError("no rows to factor")
    return factor_triangle(rows.sparkSession, np.array(found["r"]).reshape(d, d), k)


def factor_range(rows: DataFrame, k: int, x: str = "x", d: int | None = None, oversample: int = 8, tol: float = 1e-8,
                 max_passes: int = 30, seed: int = 0) -> Factors:
    """``random``: the first ``k`` factors of all rows of ``x``.

    Blocks of k + oversample vectors, each the last one's image under X^T X
    made orthogonal to all before, span the space in which the k vectors are
    sought.  Ends when each of them is an eigenvector up to ``tol`` times the
    largest eigenvalue; raises if that takes more than ``max_passes``.
    """
    d = d or array_width(rows, x)
    if not 1 <= k <= d:
        raise ValueError(f"k must be in 1..{d}")
    width = min(d, k + oversample)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    basis, images = np.zeros((d, 0)), np.zeros((d, 0))
    for _ in range(max_passes):
        state = Product(block)
        found = merge_runs(run_states(rows, [], x, state), [], state).first()
        if found is None:
            raise ValueError("no rows to factor")
        y = np.array(found["y"]).reshape(d, -1)
        if not np.isfinite(y).all():
            raise ValueError("a row to factor has a NULL, NaN or infinity")
        basis, images = np.hstack([basis, block]), np.hstack([images, y])
        small = basis.T @ images
        w, v = np.linalg.eigh((small + small.T) / 2.0)
        w, v = w[::-1][:k], v[:, ::-1][:, :k]
        residual = np.linalg.norm(images @ v - (basis @ v) * w, axis=0).max(initial=0.0)
        if residual <= tol * max(w[0], 0.0) or basis.shape[1] == d:
            return _factors(rows.sparkSession, np.sqrt(np.clip(w, 0.0, None)), basis @ v, k, np.sqrt(np.finfo(float).eps))
        for _ in range(2):       # twice: the first pass leaves rounding behind
            y = y - basis @ (basis.T @ y)
            y = y / np.maximum(np.linalg.norm(y, axis=0), np.finfo(float).tiny)
        block = np.linalg.qr(y)[0][:, :min(width, d - basis.shape[1])]
        block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
    raise ValueError(f"not converged after {max_passes} passes: residual {residual:.3g}; allow more passes or a larger oversample")


METHODS = ("gram", "tsqr", "random")


def factorise(rows: DataFrame, x: str = "x", k: int | None = None, method: str = "tsqr", d: int | None = None, **options) -> Factors:
    """X1-X5 of all rows of ``x`` (complete rows): ``Factors`` with s, V, G, and
    U and UG row by row.  ``options`` go to :func:`factor_range`."""
    d = d or array_width(rows, x)
    if method == "random":
        return factor_range(rows, d if k is None else k, x, d, **options)
    if method == "tsqr":
        return factor_rows(rows, x, d, k)
    if method != "gram":
        raise ValueError(f"method must be one of {METHODS}")
    state = Complete(d)
    found = merge_runs(run_states(rows, [], x, state), [], state).first()
    if found is None:
        raise ValueError("no rows to factor")
    gram, mean = np.zeros((d, d)), np.array(found["mean"])
    gram[state.iu] = np.array(found["m2"])
    gram = np.triu(gram) + np.triu(gram, 1).T + found["n"][0] * np.outer(mean, mean)
    if not np.isfinite(gram).all():
        raise ValueError("a row to factor has a NULL, NaN or infinity")
    return factor_gram(rows.sparkSession, gram, k)


def _row_map(rows: DataFrame, x: str, mat: np.ndarray, out: str, keep: Sequence[str] | None) -> DataFrame:
    """``out = x @ mat`` per row, in Arrow batches.  The regions travel as
    primitive columns both ways; the array is rebuilt on the JVM side."""
    keep = list(keep) if keep is not None else [c for c in rows.columns if c != x]
    d, k = mat.shape
    fields = [f for f in rows.schema.fields if f.name in keep]
    ocols = [f"_{out}{c}" for c in range(k)]
    schema = T.StructType([*fields, *(T.StructField(c, T.DoubleType(), False) for c in ocols)])
    m = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(mat))  # d x k, bounded by d^2
    xcols = [f"_x{c}" for c in range(d)]

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = m.value
        for pdf in batches:
            if pdf.empty:
                continue
            Y = pdf[xcols].to_numpy(dtype=np.float64) @ a
            res = pdf[keep].copy()
            for c in range(k):
                res[ocols[c]] = Y[:, c]
            yield res

    src = rows.select(*keep, *[F.col(x)[c].alias(xcols[c]) for c in range(d)])
    mapped = src.mapInPandas(fn, schema=schema)
    return mapped.select(*keep, F.array(*[F.col(c) for c in ocols]).alias(out))
