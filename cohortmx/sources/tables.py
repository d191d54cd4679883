"""Columnar tables as a ``measurement`` table.

``measurement`` is ``subject_id LONG, <row columns>, x ARRAY<DOUBLE>``: one
row per observation of a subject, the measured regions as one array.  Only
the referenced columns are selected, so the parquet scan reads just them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the lineitem measures used as regions, in this order
LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def null_reason(subject: str, columns: Sequence[str] = (), array_col: str | None = None) -> F.Column:
    """Why a row is no complete observation; NULL for one that is."""
    reason = F.when(F.col(subject).isNull(), F.lit("no subject id"))
    for c in columns:
        reason = reason.when(F.col(c).isNull(), F.lit(f"no value in {c}"))
    if array_col is not None:
        reason = (reason.when(F.col(array_col).isNull(), F.lit(f"no value in {array_col}"))
                  .when(F.exists(array_col, lambda v: v.isNull()), F.lit(f"a NULL within {array_col}")))
    return reason


def null_rejects(df: DataFrame, subject: str, columns: Sequence[str] = (), array_col: str | None = None) -> DataFrame:
    """``reason, count`` of the rows that ``strict=False`` leaves out."""
    reason = null_reason(subject, columns, array_col)
    return df.where(reason.isNotNull()).groupBy(reason.alias("reason")).count()


def _complete(df: DataFrame, reason: F.Column, strict: bool) -> DataFrame:
    if not strict:
        return df.where(reason.isNull())
    return df.where(F.when(reason.isNull(), F.lit(True)).otherwise(F.raise_error(reason).cast("boolean")))


def measurement_from_columns(df: DataFrame, subject: str, columns: Sequence[str], row_cols: Sequence[str] = (),
                             strict: bool = True, gaps: bool = False) -> DataFrame:
    """Numeric columns -> ``x`` array.  A NULL subject or measure raises, or
    (``strict=False``) its row is left out: :func:`null_rejects` counts these.
    ``gaps``: measures may be NULL and stay so within ``x``, for pairwise
    complete statistics."""
    x = F.array(*[F.col(c).cast("double") for c in columns])
    return _complete(df, null_reason(subject, () if gaps else columns), strict).select(
        F.col(subject).cast("long").alias("subject_id"), *[F.col(c) for c in row_cols], x.alias("x"))


def measurement_from_array(df: DataFrame, subject: str, array_col: str, row_cols: Sequence[str] = (),
                           strict: bool = True, gaps: bool = False) -> DataFrame:
    """An array column (e.g. ``array<float>``) cast to ``array<double>``; NULL
    subjects, arrays and values within arrays as in :func:`measurement_from_columns`."""
    return _complete(df, null_reason(subject, array_col=None if gaps else array_col), strict).select(
        F.col(subject).cast("long").alias("subject_id"), *[F.col(c) for c in row_cols],
        F.col(array_col).cast(T.ArrayType(T.DoubleType())).alias("x"))


def lineitem_measurement(spark: SparkSession, sf_dir: str, row_cols: Sequence[str] = ("l_orderkey", "l_linenumber")) -> DataFrame:
    """Subject = supplier, regions = quantity, price, discount, tax.

    ``(l_orderkey, l_linenumber)`` identifies a row only loosely (it repeats
    in the generated data); results that keep row identity carry it along
    with the values.
    """
    li = read_table(spark, sf_dir, "lineitem")
    return measurement_from_columns(li, "l_suppkey", LINEITEM_MEASURES, row_cols)


def _wide_lineitem(spark: SparkSession, sf_dir: str, mirrored: bool) -> tuple[DataFrame, list[str]]:
    """lineitem's numeric columns and measures derived from them, as x0 .. x14 (``mirrored``: and x15, x16)."""
    li = read_table(spark, sf_dir, "lineitem")
    p, q, d, t = (F.col(c) for c in ("l_extendedprice", "l_quantity", "l_discount", "l_tax"))
    cols = [q, p, d, t, F.col("l_linenumber"), F.col("l_partkey"), F.col("l_orderkey"),
            F.unix_seconds(F.col("l_shipdate").cast("timestamp")), p * (1 - d), p * (1 - d) * (1 + t),
            p / q, F.log1p(p), F.sqrt(q), d * t, q * d]
    if mirrored:
        cols += [q, -q]
    names = [f"x{k}" for k in range(len(cols))]
    return li.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", *[c.cast("double").alias(n) for c, n in zip(cols, names)]), names


def lineitem_wide_measurement(spark: SparkSession, sf_dir: str, mirrored: bool = False) -> DataFrame:
    """Subject = supplier, 15 regions: lineitem's numeric columns and measures
    derived from them.  ``mirrored`` adds two: the first one again, and negated.
    A NULL in any of them raises."""
    li, names = _wide_lineitem(spark, sf_dir, mirrored)
    return measurement_from_columns(li, "l_suppkey", names)


def planted_gaps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` of lineitem with ``columns`` set to NULL by a rule that SQL can
    state: the k-th one where l_orderkey + (k + 2) * l_partkey + l_linenumber is
    divisible by k % 5 + 3; all of them where l_orderkey is divisible by 97."""
    mark = F.col("l_orderkey") + F.col("l_linenumber")
    return df.select("l_suppkey", *[F.when(((mark + (k + 2) * F.col("l_partkey")) % (k % 5 + 3) != 0) & (F.col("l_orderkey") % 97 != 0), F.col(c)).alias(c)
                                    for k, c in enumerate(columns)])


def lineitem_with_gaps(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Subject = supplier, the four measures (``wide``: 17), with planted gaps."""
    if wide:
        li, names = _wide_lineitem(spark, sf_dir, mirrored=True)
    else:
        li, names = read_table(spark, sf_dir, "lineitem"), LINEITEM_MEASURES
    return measurement_from_columns(planted_gaps(li, names), "l_suppkey", names, gaps=True)


def embeddings_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject = label, row = vec_id, regions = the 64 embedding floats."""
    emb = read_table(spark, sf_dir, "embeddings")
    return measurement_from_array(emb, "label", "embedding", ["vec_id"]).withColumnRenamed("vec_id", "row_idx")
