"""Registered queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

Inputs: ``lineitem`` as a measurement table (subject = supplier, regions =
quantity, extended price, discount, tax) and ``embeddings`` (subject =
label, 64 regions).  Every query reads the whole table.

Float outputs are rounded the same way on both sides (``fixed`` /
``sql_fixed``): 9 decimals for values of order 1 (r, F, z, covariances of
z-scored data), 6 for sums and raw-unit statistics.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import fixed, sql_fixed
from ..operators import matrix as mx
from ..operators.correlate import corr_from_moments, corr_matrix, fisher_z
from ..operators.covariance import zscored_stack_cov, zscored_sums
from ..operators.factorise import factor_gram, factor_range, factor_rows, tall_r
from ..operators.moments import mirror, moments, pairwise_moments
from ..operators.normalise import apply_zscore, column_params, column_stats, zscore_params
from ..operators.summarise import (attach_split, entry_stats, split_by_rank, split_by_threshold,
                                   subject_dim)
from ..session import materialize, scratch_path
from ..sources import sinks
from ..sources.text import read_matrix_dir
from ..sources.tables import (LINEITEM_MEASURES, embeddings_measurement, lineitem_measurement, lineitem_wide_measurement,
                              lineitem_with_gaps)
from . import pipeline

D = 4          # lineitem regions
D_EMB = 64     # embedding regions
CUT = 39       # threshold split: subject_id <= CUT is train (as the reference's fixed id cut)
D_WIDE = 17    # 15 lineitem measures, one of them again and negated
K_RANGE = 3    # rank sought by the randomised range finder
K_LOW = 2      # rank of the truncated factorisation
WRITTEN = ("Fn", "Fv", "Ftrain", "Ftest", "Ctrain", "Ctest", "CtrainCtest")   # result files that SQL can state
R9, R6 = 9, 6
STEPS = 40     # squarings in the SQL of eigenvectors

# ------------------------------------------------------------------ shared


def _li(spark: SparkSession, sf: str) -> DataFrame:
    return lineitem_measurement(spark, sf)


def _li_moments(spark, sf):
    return moments(_li(spark, sf), "subject_id", d=D)


def _fisher(spark, sf, full=True):
    return fisher_z(corr_from_moments(_li_moments(spark, sf), "subject_id", full=full))


def _rank_split(table: DataFrame) -> DataFrame:
    return split_by_rank(subject_dim(table))


def _prepared(spark, sf):
    """Moments and the rank split, checkpointed: several steps (driver-side
    d x d collects, the range partitioning of the subjects) read them."""
    m = materialize(_li_moments(spark, sf))
    return m, materialize(_rank_split(m))


def _stacks(m, splits):
    """Per split: (Gram matrix, covariance) of the z-scored stack, from one
    aggregate and one collect of 2 d^2 rows."""
    s = {"train": np.zeros((D, D)), "test": np.zeros((D, D))}
    n = dict.fromkeys(s, 0)
    for r in mirror(zscored_sums(attach_split(m, splits), "subject_id"), ["split"], ["s", "N"]).collect():
        s[r["split"]][r["i"], r["j"]], n[r["split"]] = r["s"], r["N"]
    return {k: (v, v / (n[k] - 1.0)) for k, v in s.items()}


def _factors(spark, sf, k=None):
    m, splits = _prepared(spark, sf)
    return m, splits, factor_gram(spark, _stacks(m, splits)["train"][0], k)


def _r9(c: str):
    return fixed(F.col(c), R9).alias(c)


# ------------------------------------------------------------------ queries

def q_subject_corr(spark, sf):
    c = corr_from_moments(_li_moments(spark, sf), "subject_id")
    return c.select("subject_id", "i", "j", _r9("r"))


def q_fisher_z(spark, sf):
    return _fisher(spark, sf).select("subject_id", "i", "j", _r9("r"), _r9("f"))


def q_fisher_mean_var(spark, sf):
    s = entry_stats(_fisher(spark, sf, full=False), ddof=0, upper=True)
    return s.select("i", "j", fixed(F.col("mean"), R9).alias("f_mean"),
                    fixed(F.col("var"), R9).alias("f_var"), F.col("n").alias("n_subjects"))


def q_fisher_var_samp(spark, sf):
    s = entry_stats(_fisher(spark, sf, full=False), ddof=1, upper=True)
    return s.select("i", "j", fixed(F.col("var"), R9).alias("f_var_samp"))


def q_fisher_mean_by_rank_split(spark, sf):
    m, splits = _prepared(spark, sf)
    f = fisher_z(corr_from_moments(m, "subject_id", full=False))
    s = entry_stats(attach_split(f, splits), by="split", upper=True)
    return s.select("split", "i", "j", fixed(F.col("mean"), R9).alias("f_mean"), F.col("n").alias("n_subjects"))


def q_fisher_mean_by_threshold(spark, sf):
    f = _fisher(spark, sf, full=False)
    s = entry_stats(attach_split(f, split_by_threshold(subject_dim(f), CUT)), by="split", upper=True)
    return s.select("split", "i", "j", fixed(F.col("mean"), R9).alias("f_mean"), F.col("n").alias("n_subjects"))


def q_subjects_ordered(spark, sf):
    return _rank_split(_li(spark, sf))


def q_column_mean_std(spark, sf):
    s = column_stats(None, "subject_id", m=_li_moments(spark, sf))
    return s.select("subject_id", "k", "n", fixed(F.col("mean"), R6).alias("mean"),
                    fixed(F.col("sd_pop"), R6).alias("sd_pop"), fixed(F.col("sd_samp"), R6).alias("sd_samp"))


def q_zscore_rows(spark, sf):
    li = _li(spark, sf)
    z = apply_zscore(li, zscore_params(moments(li, "subject_id", d=D), "subject_id"), "subject_id", d=D)
    return z.select("subject_id", "l_orderkey", "l_linenumber",
                    *[fixed(F.col("z")[k], R9).alias(f"z{k}") for k in range(D)])


def q_cov_train_test(spark, sf):
    m, splits = _prepared(spark, sf)
    return zscored_stack_cov(m, "subject_id", splits).select("split", "i", "j", _r9("value"))


def _train_test(spark, sf):
    m, splits = _prepared(spark, sf)
    c = materialize(zscored_stack_cov(m, "subject_id", splits))   # 2 d^2 rows, read four times or less
    tr = c.where(F.col("split") == "train").drop("split")
    te = c.where(F.col("split") == "test").drop("split")
    return tr, te


def q_cov_difference(spark, sf):
    tr, te = _train_test(spark, sf)
    return mx.subtract(tr, te).select("i", "j", _r9("value"))


def q_cov_difference_union(spark, sf):
    tr, te = _train_test(spark, sf)
    return mx.subtract_union(tr, te).select("i", "j", _r9("value"))


def q_frobenius_train_test(spark, sf):
    tr, te = _train_test(spark, sf)
    return mx.distance(tr, te).select(_r9("value"))


def q_gram_matrix(spark, sf):
    m, splits = _prepared(spark, sf)
    g = zscored_stack_cov(m, "subject_id", splits, gram=True)
    return g.where(F.col("split") == "train").select("i", "j", fixed(F.col("value"), R6).alias("value"))


def q_matrix_transpose_multiply(spark, sf):
    tr, te = _train_test(spark, sf)
    return mx.multiply(mx.transpose(tr), te).select("i", "j", _r9("value"))


def q_embedding_corr_wide(spark, sf):
    e = embeddings_measurement(spark, sf)
    c = corr_from_moments(moments(e, "subject_id", d=D_EMB, method="chunks"), "subject_id")
    return c.select("subject_id", "i", "j", _r9("r"))


def q_cov_ug_full_rank(spark, sf):
    gram, cov = _stacks(*_prepared(spark, sf))["train"]
    return mx.from_numpy(spark, factor_gram(spark, gram).cov_ug(cov)).select("i", "j", _r9("value"))


def _closeness(spark, sf, k):
    # the distances are d x d algebra, as in pipeline.compute
    c = _stacks(*_prepared(spark, sf))
    (gram, train), (_, test) = c["train"], c["test"]
    cug = factor_gram(spark, gram, k).cov_ug(train)
    return spark.createDataFrame(
        [("CUG_Ctest", float(np.linalg.norm(cug - test))), ("Ctrain_Ctest", float(np.linalg.norm(train - test)))], "pair string, value double")


def q_ug_closeness(spark, sf):
    return _closeness(spark, sf, None).select("pair", _r9("value"))


def q_ug_closeness_rank2(spark, sf):
    return _closeness(spark, sf, K_LOW).select("pair", _r9("value"))


def q_singular_values(spark, sf):
    return _factors(spark, sf)[2].singular_values().select("component", fixed(F.col("s"), R6).alias("s"))


def q_g_matrix(spark, sf):
    return _factors(spark, sf)[2].g_matrix().select("i", "j", fixed(F.col("value"), R6).alias("value"))


def _train_z_rows(spark, sf, m, splits):
    # parameters of train subjects only: one join keeps and z-scores the rows
    params = zscore_params(m, "subject_id").join(
        splits.where(F.col("split") == "train").select("subject_id"), "subject_id")
    return apply_zscore(_li(spark, sf), params, "subject_id", out="x", d=D)


def q_u_rows(spark, sf):
    m, splits, f = _factors(spark, sf)
    u = f.u_rows(_train_z_rows(spark, sf, m, splits))
    return u.select("subject_id", "l_orderkey", "l_linenumber",
                    *[fixed(F.col("u")[k], R6).alias(f"u{k}") for k in range(D)])


def q_ug_truncated(spark, sf):
    m, splits, f = _factors(spark, sf, K_LOW)
    ug = f.ug_rows(_train_z_rows(spark, sf, m, splits))
    return ug.select("subject_id", "l_orderkey", "l_linenumber",
                     *[fixed(F.col("ug")[k], R6).alias(f"ug{k}") for k in range(D)])


def q_r_gram(spark, sf):
    """X1 by tall-skinny QR: the transpose of R times R is the train Gram matrix."""
    m, splits = _prepared(spark, sf)
    r = np.array(tall_r(_train_z_rows(spark, sf, m, splits), d=D).first()["r"]).reshape(D, D)
    return mx.from_numpy(spark, r.T @ r).select("i", "j", fixed(F.col("value"), R6).alias("value"))


def q_tsqr_factors(spark, sf):
    """X1/X2 by tall-skinny QR: s and V of each component."""
    m, splits = _prepared(spark, sf)
    f = factor_rows(_train_z_rows(spark, sf, m, splits), d=D)
    rows = [(i, j, float(f.s[i]), float(f.v[j, i])) for i in range(D) for j in range(D)]
    return spark.createDataFrame(rows, "component int, j int, s double, v double").select(
        "component", "j", fixed(F.col("s"), R6).alias("s"), fixed(F.col("v"), R6).alias("v"))


def q_range_projector_d15(spark, sf):
    """X1 at k = 3 of 15 regions by the randomised range finder: the projector
    on the first three right vectors of all z-scored rows."""
    rows = lineitem_wide_measurement(spark, sf)
    z = apply_zscore(rows, column_params(rows, "subject_id", d=15), "subject_id", out="x", d=15)
    p = factor_range(z, K_RANGE, d=15, oversample=2, tol=1e-10).projector
    return mx.from_numpy(spark, p).select("i", "j", fixed(F.col("value"), R6).alias("value"))


def q_g_gram(spark, sf):
    """The transpose of G times G is the train Gram matrix."""
    g = materialize(_factors(spark, sf)[2].g_matrix())
    return mx.multiply(mx.transpose(g), g).select("i", "j", fixed(F.col("value"), R6).alias("value"))


def q_u_orthonormal(spark, sf):
    """The transpose of U times U, summed over all train rows."""
    m, splits, f = _factors(spark, sf)
    u = f.u_rows(_train_z_rows(spark, sf, m, splits))
    sums = u.agg(*[F.sum(F.col("u")[i] * F.col("u")[j]).alias(f"p{i}_{j}") for i in range(D) for j in range(D)])
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"p{i}_{j}").alias("value"))
                      for i in range(D) for j in range(D)])
    return sums.select(F.inline(cells)).select("i", "j", _r9("value"))


def q_ug_full_rank_rows(spark, sf):
    """At full rank the rows of U times G are the z-scored train rows."""
    m, splits, f = _factors(spark, sf)
    u = f.u_rows(_train_z_rows(spark, sf, m, splits))
    entry = [sum((F.col("u")[k] * F.lit(float(f.g[k, j])) for k in range(D)), F.lit(0.0)) for j in range(D)]
    return u.select("subject_id", "l_orderkey", "l_linenumber", *[fixed(entry[j], R6).alias(f"z{j}") for j in range(D)])


def _wide_corr(spark, sf):
    # a supplier's rows lie all over the table
    m = moments(lineitem_wide_measurement(spark, sf, mirrored=True), "subject_id", d=D_WIDE, cluster=True)
    return corr_from_moments(m, "subject_id")


def q_subject_corr_d15(spark, sf):
    """A1 at 15 regions and two more, equal to the first and its negation."""
    return _wide_corr(spark, sf).select("subject_id", "i", "j", fixed(F.col("r"), R6).alias("r"))


def q_fisher_z_d15(spark, sf):
    """M1/F3 there: r = 1 gives 0, r = -1 minus infinity (marked; f is 0 there)."""
    f = fisher_z(_wide_corr(spark, sf))
    low = F.col("f") == F.lit(float("-inf"))
    return f.select("subject_id", "i", "j", low.alias("is_minus_inf"),
                    F.when(low, F.lit(0.0)).otherwise(fixed(F.col("f"), R6)).alias("f"))


def q_u_csv_roundtrip(spark, sf):
    """K2: U written in subject order with its key, and read back."""
    res = pipeline.compute(_li(spark, sf), d=D)
    paths = pipeline.write(res, _fresh(spark, "results"), u_key=True)
    back = sinks.read_rows(spark, paths["U"], D, {"subject_id": "long"})
    return back.select("subject_id", *[fixed(F.col("u")[k], R6).alias(f"u{k}") for k in range(D)])


def q_subject_corr_pairwise(spark, sf):
    """A1 on rows with gaps: each pair over the rows that have both values."""
    m = pairwise_moments(lineitem_with_gaps(spark, sf), "subject_id", d=D)
    return corr_from_moments(m, "subject_id", keep_n=True).select("subject_id", "i", "j", F.col("n").alias("n_both"), _r9("r"))


def q_subject_corr_pairwise_d15(spark, sf):
    """The same at 17 regions, in Arrow chunks; NULL stands for an undefined r."""
    r = corr_matrix(lineitem_with_gaps(spark, sf, wide=True), "subject_id", d=D_WIDE, pairwise=True, cluster=True)
    return r.select("subject_id", "i", "j", F.when(~F.isnan("r"), fixed(F.col("r"), R6)).alias("r"))


def q_fisher_mean_pairwise(spark, sf):
    """A2 over subjects whose rows have gaps, undefined entries skipped."""
    f = fisher_z(corr_from_moments(pairwise_moments(lineitem_with_gaps(spark, sf), "subject_id", d=D), "subject_id", full=False), undefined="skip")
    s = entry_stats(f, ddof=0, upper=True)
    return s.select("i", "j", fixed(F.col("mean"), R9).alias("f_mean"), F.col("n").alias("n_subjects"))


def q_pipeline_csv_roundtrip(spark, sf):
    """K1/K4/K5: the whole pipeline on the table, written as CSV files and read back."""
    res = pipeline.compute(_li(spark, sf), d=D)
    paths = pipeline.write(res, _fresh(spark, "results"))
    parts = [sinks.read_matrix(spark, paths[n], 1 if n == "CtrainCtest" else D)
             .select(F.lit(n).alias("name"), "i", "j", _r9("value")) for n in WRITTEN]
    return reduce(DataFrame.unionByName, parts)


def _fresh(spark, name):
    import uuid

    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def q_ingest_text_roundtrip(spark, sf):
    """S1-P10 + the directory writer: lineitem measures written as subject
    text folders and read back; every value must survive exactly."""
    path = _fresh(spark, "subject-text")
    sinks.write_matrix_dir(_li(spark, sf), path, D)
    back = read_matrix_dir(spark, path, glob="*.txt", id_regex=r"sub=(\d+)", id_from="path",
                           recursive=True, width=D)
    return back.rows.select("subject_id", *[F.col("x")[k].alias(f"x{k}") for k in range(D)])


def q_csv_sink_roundtrip(spark, sf):
    """K1: the Fn matrix written as headerless CSV (%.18e) and read back."""
    s = entry_stats(_fisher(spark, sf, full=False), ddof=0, upper=True)
    path = _fresh(spark, "fn-csv")
    sinks.write_matrix(s.select("i", "j", F.col("mean").alias("value")), path, D)
    return sinks.read_matrix(spark, path, D).select("i", "j", fixed(F.col("value"), R9).alias("f_mean"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "subject_corr": q_subject_corr,
    "fisher_z": q_fisher_z,
    "fisher_mean_var": q_fisher_mean_var,
    "fisher_var_samp": q_fisher_var_samp,
    "fisher_mean_by_rank_split": q_fisher_mean_by_rank_split,
    "fisher_mean_by_threshold": q_fisher_mean_by_threshold,
    "subjects_ordered": q_subjects_ordered,
    "column_mean_std": q_column_mean_std,
    "zscore_rows": q_zscore_rows,
    "cov_train_test": q_cov_train_test,
    "cov_difference": q_cov_difference,
    "cov_difference_union": q_cov_difference_union,
    "frobenius_train_test": q_frobenius_train_test,
    "gram_matrix": q_gram_matrix,
    "matrix_transpose_multiply": q_matrix_transpose_multiply,
    "embedding_corr_wide": q_embedding_corr_wide,
    "cov_ug_full_rank": q_cov_ug_full_rank,
    "ug_closeness": q_ug_closeness,
    "ug_closeness_rank2": q_ug_closeness_rank2,
    "singular_values": q_singular_values,
    "g_matrix": q_g_matrix,
    "u_rows": q_u_rows,
    "ug_truncated": q_ug_truncated,
    "g_gram": q_g_gram,
    "u_orthonormal": q_u_orthonormal,
    "ug_full_rank_rows": q_ug_full_rank_rows,
    "ingest_text_roundtrip": q_ingest_text_roundtrip,
    "csv_sink_roundtrip": q_csv_sink_roundtrip,
    "subject_corr_d15": q_subject_corr_d15,
    "fisher_z_d15": q_fisher_z_d15,
    "pipeline_csv_roundtrip": q_pipeline_csv_roundtrip,
    "u_csv_roundtrip": q_u_csv_roundtrip,
    "r_gram": q_r_gram,
    "tsqr_factors": q_tsqr_factors,
    "range_projector_d15": q_range_projector_d15,
    "subject_corr_pairwise": q_subject_corr_pairwise,
    "subject_corr_pairwise_d15": q_subject_corr_pairwise_d15,
    "fisher_mean_pairwise": q_fisher_mean_pairwise,
}

# ------------------------------------------------------------------ oracles

_M = """m AS (
  SELECT l_suppkey AS subject_id, l_orderkey, l_linenumber,
         CAST(l_quantity AS DOUBLE) AS x0, CAST(l_extendedprice AS DOUBLE) AS x1,
         CAST(l_discount AS DOUBLE) AS x2, CAST(l_tax AS DOUBLE) AS x3
  FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
    AND l_discount IS NOT NULL AND l_tax IS NOT NULL)"""

_PAIRS = """p AS (
  SELECT subject_id, CAST(t1.i AS INTEGER) AS i, CAST(t2.j AS INTEGER) AS j,
         [x0, x1, x2, x3][t1.i + 1] AS a, [x0, x1, x2, x3][t2.j + 1] AS b
  FROM m, range(4) AS t1(i), range(4) AS t2(j))"""

_CORR = """c AS (
  SELECT subject_id, i, j, CASE WHEN i = j THEN 1.0 ELSE corr(a, b) END AS r
  FROM p GROUP BY subject_id, i, j)"""

_FISHER = """fz AS (
  SELECT subject_id, i, j, r,
         CASE WHEN i = j OR r >= 1 THEN 0.0 WHEN r <= -1 THEN CAST('-inf' AS DOUBLE) ELSE atanh(r) END AS f
  FROM c)"""

_RANK = """s AS (
  SELECT subject_id, CAST(row_number() OVER (ORDER BY subject_id) AS BIGINT) AS rank,
         count(*) OVER () AS n_subjects
  FROM (SELECT DISTINCT subject_id FROM m)),
sp AS (
  SELECT subject_id, rank,
         CASE WHEN rank <= floor(n_subjects / 2) THEN 'train' ELSE 'test' END AS split
  FROM s)"""

_Z = """z AS (
  SELECT subject_id, l_orderkey, l_linenumber,
         (x0 - avg(x0) OVER w) / stddev_pop(x0) OVER w AS z0,
         (x1 - avg(x1) OVER w) / stddev_pop(x1) OVER w AS z1,
         (x2 - avg(x2) OVER w) / stddev_pop(x2) OVER w AS z2,
         (x3 - avg(x3) OVER w) / stddev_pop(x3) OVER w AS z3
  FROM m WINDOW w AS (PARTITION BY subject_id))"""

_ZP = """zp AS (
  SELECT sp.split, CAST(t1.i AS INTEGER) AS i, CAST(t2.j AS INTEGER) AS j,
         [z0, z1, z2, z3][t1.i + 1] AS a, [z0, z1, z2, z3][t2.j + 1] AS b
  FROM z JOIN sp USING (subject_id), range(4) AS t1(i), range(4) AS t2(j))"""

_COV = """cv AS (SELECT split, i, j, covar_samp(a, b) AS value FROM zp GROUP BY split, i, j),
tr AS (SELECT i, j, value FROM cv WHERE split = 'train'),
te AS (SELECT i, j, value FROM cv WHERE split = 'test')"""


_WIDE = """w AS (
  SELECT l_suppkey AS subject_id, [l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber, l_partkey, l_orderkey,
         floor(epoch(l_shipdate)), l_extendedprice * (1 - l_discount), l_extendedprice * (1 - l_discount) * (1 + l_tax),
         l_extendedprice / l_quantity, ln(1 + l_extendedprice), sqrt(l_quantity), l_discount * l_tax,
         l_quantity * l_discount, l_quantity, -l_quantity]::DOUBLE[] AS x FROM lineitem)"""

_WIDE_CORR = """p AS (
  SELECT subject_id, CAST(t1.i AS INTEGER) AS i, CAST(t2.j AS INTEGER) AS j, x[t1.i + 1] AS a, x[t2.j + 1] AS b
  FROM w, range(17) AS t1(i), range(17) AS t2(j)),
c AS (SELECT subject_id, i, j, CASE WHEN i = j THEN 1.0 ELSE corr(a, b) END AS r FROM p GROUP BY subject_id, i, j)"""

# NULL stands for minus infinity
_WIDE_FISHER = """fz AS (
  SELECT subject_id, i, j,
         CASE WHEN i = j OR r > 1 - 1e-12 THEN 0.0 WHEN r < -1 + 1e-12 THEN NULL ELSE atanh(r) END AS f FROM c)"""


def _gap(k: int, value: str) -> str:
    return (f"CASE WHEN (l_orderkey + l_linenumber + {k + 2} * l_partkey) % {k % 5 + 3} <> 0 AND l_orderkey % 97 <> 0 "
            f"THEN CAST({value} AS DOUBLE) END")


_GAPS = f"""g AS (
  SELECT l_suppkey AS subject_id, [{', '.join(_gap(k, c) for k, c in enumerate(LINEITEM_MEASURES))}] AS x FROM lineitem)"""

_WIDE_GAPS = """g AS (
  SELECT subject_id, list_transform(range(17), lambda k: CASE WHEN (ok + ln + (k + 2) * pk) % (k % 5 + 3) <> 0 AND ok % 97 <> 0 THEN x[k + 1] END) AS x
  FROM (SELECT w.*, l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk FROM w))"""


def _gap_corr(d: int) -> str:
    # corr, regr_count: over the rows that have both values
    return f"""p AS (
  SELECT subject_id, CAST(t1.i AS INTEGER) AS i, CAST(t2.j AS INTEGER) AS j, x[t1.i + 1] AS a, x[t2.j + 1] AS b
  FROM g, range({d}) AS t1(i), range({d}) AS t2(j)),
c0 AS (
  SELECT subject_id, i, j, CAST(regr_count(a, b) AS BIGINT) AS n, corr(a, b) AS r,
         min(a) FILTER (WHERE b IS NOT NULL) = max(a) FILTER (WHERE b IS NOT NULL)
         OR min(b) FILTER (WHERE a IS NOT NULL) = max(b) FILTER (WHERE a IS NOT NULL) AS flat
  FROM p GROUP BY subject_id, i, j),
c AS (SELECT subject_id, i, j, n, CASE WHEN n < 2 OR flat THEN CAST('nan' AS DOUBLE) WHEN i = j THEN 1.0 ELSE r END AS r FROM c0)"""


def _eigen(d: int, k: int) -> list[str]:
    """e: c, s (root of the eigenvalue), v of the first k eigenpairs of the matrix in list ``a`` of table gm.

    A symmetric matrix squared again and again, with trace 1, tends to v v' of
    its largest eigenvalue; the column with the largest diagonal entry gives v
    with its largest entry positive.  Taken off, the next one is the largest.
    """
    cell = f"list_sum(list_transform(range({d}), lambda t: m[(z - z % {d}) + t + 1] * m[t * {d} + z % {d} + 1]))"
    trace = f"list_sum(list_transform(range({d}), lambda t: p[t * {d + 1} + 1]))"
    parts = ["a0 AS MATERIALIZED (SELECT a FROM gm)"]
    for c in range(k):
        parts.append(f"""q{c} AS (
  SELECT 0 AS step, list_transform(a, lambda x: x / {trace.replace('p[', 'a[')}) AS m FROM a{c}
  UNION ALL
  SELECT step + 1, list_transform(p, lambda x: x / {trace}) FROM (
    SELECT step, list_transform(range({d * d}), lambda z: {cell}) AS p FROM q{c} WHERE step < {STEPS}))""")
        diagonal = f"list_transform(range({d}), lambda t: m[t * {d + 1} + 1])"
        parts.append(f"""v{c} AS MATERIALIZED (
  SELECT list_transform(range({d}), lambda t: m[t * {d} + b + 1] / sqrt(m[b * {d + 1} + 1])) AS v FROM (
    SELECT m, list_position({diagonal}, list_max({diagonal})) - 1 AS b FROM q{c} WHERE step = {STEPS}))""")
        row = f"CAST((z - z % {d}) / {d} AS BIGINT) + 1"
        image = f"list_sum(list_transform(range({d * d}), lambda z: a[z + 1] * v[{row}] * v[z % {d} + 1]))"
        parts.append(f"e{c} AS MATERIALIZED (SELECT {c} AS c, {image} AS l, v FROM v{c}, gm)")
        parts.append(f"""a{c + 1} AS MATERIALIZED (
  SELECT list_transform(range({d * d}), lambda z: a[z + 1] - e{c}.l * e{c}.v[{row}] * e{c}.v[z % {d} + 1]) AS a FROM a{c}, e{c})""")
    parts.append("e AS (" + " UNION ALL ".join(f"SELECT c, sqrt(l) AS s, v FROM e{c}" for c in range(k)) + ")")
    return parts


_GRAM = """gm AS MATERIALIZED (
  SELECT list(g ORDER BY i, j) AS a FROM (SELECT i, j, fsum(a * b) AS g FROM zp WHERE split = 'train' GROUP BY i, j))"""

# all rows of the 15 columns, z-scored per subject, and the Gram matrix of the stack
_WIDE_GRAM = """cells AS (
  SELECT id, subject_id, CAST(t.k AS INTEGER) AS k, x[t.k + 1] AS v FROM (SELECT row_number() OVER () AS id, subject_id, x FROM w), range(15) AS t(k)),
zs AS MATERIALIZED (
  SELECT id, k, CASE WHEN min(v) OVER s = max(v) OVER s THEN 0.0 ELSE (v - avg(v) OVER s) / stddev_pop(v) OVER s END AS z
  FROM cells WINDOW s AS (PARTITION BY subject_id, k)),
gm AS MATERIALIZED (
  SELECT list(g ORDER BY i, j) AS a FROM (SELECT a.k AS i, b.k AS j, fsum(a.z * b.z) AS g FROM zs a JOIN zs b USING (id) GROUP BY a.k, b.k))"""


def _rec(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _f9(e: str) -> str:
    return sql_fixed(e, R9)


def _f6(e: str) -> str:
    return sql_fixed(e, R6)


_DIST = "sqrt(sum((tr.value - te.value) * (tr.value - te.value)))"

_U = (_rec(_M, _RANK, _Z, _ZP, _GRAM, *_eigen(D, D), "u AS (SELECT list(e.s ORDER BY c) AS s, list(e.v ORDER BY c) AS v FROM e)"),
      ", ".join(_f6("(" + " + ".join(f"z{j} * u.v[{k + 1}][{j + 1}]" for j in range(D)) + f") / u.s[{k + 1}]") + f" AS u{k}" for k in range(D))
      + " FROM z JOIN sp USING (subject_id), u WHERE split = 'train'")

ORACLE: dict[str, str] = {
    "subject_corr": _with(_M, _PAIRS, _CORR) + f"SELECT subject_id, i, j, {_f9('r')} AS r FROM c",
    "fisher_z": _with(_M, _PAIRS, _CORR, _FISHER) + f"SELECT subject_id, i, j, {_f9('r')} AS r, {_f9('f')} AS f FROM fz",
    "fisher_mean_var": _with(_M, _PAIRS, _CORR, _FISHER)
    + f"SELECT i, j, {_f9('avg(f)')} AS f_mean, {_f9('var_pop(f)')} AS f_var, count(*) AS n_subjects FROM fz GROUP BY i, j",
    "fisher_var_samp": _with(_M, _PAIRS, _CORR, _FISHER)
    + f"SELECT i, j, {_f9('var_samp(f)')} AS f_var_samp FROM fz GROUP BY i, j",
    "fisher_mean_by_rank_split": _with(_M, _PAIRS, _CORR, _FISHER, _RANK)
    + f"SELECT split, i, j, {_f9('avg(f)')} AS f_mean, count(*) AS n_subjects FROM fz JOIN sp USING (subject_id) GROUP BY split, i, j",
    "fisher_mean_by_threshold": _with(_M, _PAIRS, _CORR, _FISHER)
    + f"SELECT CASE WHEN subject_id <= {CUT} THEN 'train' ELSE 'test' END AS split, i, j, {_f9('avg(f)')} AS f_mean, "
      "count(*) AS n_subjects FROM fz GROUP BY 1, i, j",
    "subjects_ordered": _with(_M, _RANK) + "SELECT subject_id, rank, split FROM sp",
    "column_mean_std": _with(_M)
    + "SELECT subject_id, CAST(k AS INTEGER) AS k, count(*) AS n, "
      + f"{_f6('avg(v)')} AS mean, {_f6('stddev_pop(v)')} AS sd_pop, {_f6('stddev_samp(v)')} AS sd_samp "
      "FROM (SELECT subject_id, t.k, [x0, x1, x2, x3][t.k + 1] AS v FROM m, range(4) AS t(k)) GROUP BY subject_id, k",
    "zscore_rows": _with(_M, _Z)
    + f"SELECT subject_id, l_orderkey, l_linenumber, {_f9('z0')} AS z0, {_f9('z1')} AS z1, {_f9('z2')} AS z2, {_f9('z3')} AS z3 FROM z",
    "cov_train_test": _with(_M, _RANK, _Z, _ZP, _COV) + f"SELECT split, i, j, {_f9('value')} AS value FROM cv",
    "cov_difference": _with(_M, _RANK, _Z, _ZP, _COV)
    + f"SELECT i, j, {_f9('tr.value - te.value')} AS value FROM tr JOIN te USING (i, j)",
    "cov_difference_union": _with(_M, _RANK, _Z, _ZP, _COV)
    + f"SELECT i, j, {_f9('tr.value - te.value')} AS value FROM tr JOIN te USING (i, j)",
    "frobenius_train_test": _with(_M, _RANK, _Z, _ZP, _COV)
    + f"SELECT {_f9(_DIST)} AS value FROM tr JOIN te USING (i, j)",
    "gram_matrix": _with(_M, _RANK, _Z, _ZP)
    + f"SELECT i, j, {_f6('sum(a * b)')} AS value FROM zp WHERE split = 'train' GROUP BY i, j",
    "matrix_transpose_multiply": _with(_M, _RANK, _Z, _ZP, _COV)
    + f"SELECT tr.j AS i, te.j AS j, {_f9('sum(tr.value * te.value)')} AS value FROM tr JOIN te ON tr.i = te.i GROUP BY tr.j, te.j",
    "embedding_corr_wide": """WITH e AS (
  SELECT CAST(label AS BIGINT) AS subject_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
p AS (
  SELECT subject_id, CAST(t1.i AS INTEGER) AS i, CAST(t2.j AS INTEGER) AS j, x[t1.i + 1] AS a, x[t2.j + 1] AS b
  FROM e, range(64) AS t1(i), range(64) AS t2(j))
""" + f"SELECT subject_id, i, j, {_f9('CASE WHEN i = j THEN 1.0 ELSE corr(a, b) END')} AS r FROM p GROUP BY subject_id, i, j",
    # full rank: UG = X_train, so C_UG equals C_train up to rounding
    "cov_ug_full_rank": _with(_M, _RANK, _Z, _ZP, _COV) + f"SELECT i, j, {_f9('value')} AS value FROM tr",
    # what only the right factors give: the train Gram matrix, orthonormal columns, the rows themselves
    "g_gram": _with(_M, _RANK, _Z, _ZP)
    + f"SELECT i, j, {_f6('sum(a * b)')} AS value FROM zp WHERE split = 'train' GROUP BY i, j",
    "u_orthonormal": _with(_M, _RANK, _Z, _ZP)
    + "SELECT i, j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM zp WHERE split = 'train' GROUP BY i, j",
    "ug_full_rank_rows": _with(_M, _RANK, _Z)
    + f"SELECT subject_id, l_orderkey, l_linenumber, {', '.join(_f6(f'z{k}') + f' AS z{k}' for k in range(D))} "
      "FROM z JOIN sp USING (subject_id) WHERE split = 'train'",
    "subject_corr_d15": _with(_WIDE, _WIDE_CORR) + f"SELECT subject_id, i, j, {_f6('r')} AS r FROM c",
    "fisher_z_d15": _with(_WIDE, _WIDE_CORR, _WIDE_FISHER)
    + f"SELECT subject_id, i, j, f IS NULL AS is_minus_inf, CASE WHEN f IS NULL THEN 0.0 ELSE {_f6('f')} END AS f FROM fz",
    "pipeline_csv_roundtrip": _with(_M, _PAIRS, _CORR, _FISHER, _RANK, _Z, _ZP, _COV)
    + f"SELECT 'Fn' AS name, i, j, {_f9('avg(f)')} AS value FROM fz GROUP BY i, j "
      f"UNION ALL SELECT 'Fv', i, j, {_f9('var_pop(f)')} FROM fz GROUP BY i, j "
      f"UNION ALL SELECT CASE split WHEN 'train' THEN 'Ftrain' ELSE 'Ftest' END, i, j, {_f9('avg(f)')} "
      "FROM fz JOIN sp USING (subject_id) GROUP BY split, i, j "
      f"UNION ALL SELECT CASE split WHEN 'train' THEN 'Ctrain' ELSE 'Ctest' END, i, j, {_f9('value')} FROM cv "
      f"UNION ALL SELECT 'CtrainCtest', 0::INTEGER, 0::INTEGER, {_f9(_DIST)} FROM tr JOIN te USING (i, j)",
    "subject_corr_pairwise": _with(_GAPS, _gap_corr(D)) + f"SELECT subject_id, i, j, n AS n_both, {_f9('r')} AS r FROM c",
    "subject_corr_pairwise_d15": _with(_WIDE.replace("AS x FROM lineitem", "AS x, l_orderkey, l_linenumber, l_partkey FROM lineitem"), _WIDE_GAPS, _gap_corr(D_WIDE))
    + f"SELECT subject_id, i, j, CASE WHEN isnan(r) THEN NULL ELSE {_f6('r')} END AS r FROM c",
    "fisher_mean_pairwise": _with(_GAPS, _gap_corr(D), _FISHER)
    + f"SELECT i, j, {_f9('avg(f)')} AS f_mean, count(*) AS n_subjects FROM fz WHERE i = j OR NOT isnan(r) GROUP BY i, j",
    "ingest_text_roundtrip": _with(_M) + "SELECT subject_id, x0, x1, x2, x3 FROM m",
    "csv_sink_roundtrip": _with(_M, _PAIRS, _CORR, _FISHER)
    + f"SELECT i, j, {_f9('avg(f)')} AS f_mean FROM fz GROUP BY i, j",
    "r_gram": _with(_M, _RANK, _Z, _ZP)
    + f"SELECT i, j, {_f6('sum(a * b)')} AS value FROM zp WHERE split = 'train' GROUP BY i, j",
    "singular_values": _rec(_M, _RANK, _Z, _ZP, _GRAM, *_eigen(D, D)) + f"SELECT CAST(c AS INTEGER) AS component, {_f6('s')} AS s FROM e",
    "tsqr_factors": _rec(_M, _RANK, _Z, _ZP, _GRAM, *_eigen(D, D))
    + f"SELECT CAST(c AS INTEGER) AS component, CAST(j AS INTEGER) AS j, {_f6('s')} AS s, {_f6('v[j + 1]')} AS v FROM e, range({D}) t(j)",
    "g_matrix": _rec(_M, _RANK, _Z, _ZP, _GRAM, *_eigen(D, D))
    + f"SELECT CAST(c AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {_f6('s * v[j + 1]')} AS value FROM e, range({D}) t(j)",
    "u_rows": f"{_U[0]}SELECT subject_id, l_orderkey, l_linenumber, {_U[1]}",
    "u_csv_roundtrip": f"{_U[0]}SELECT subject_id, {_U[1]}",
    "ug_truncated": _rec(_M, _RANK, _Z, _ZP, _GRAM, *_eigen(D, K_LOW), "u AS (SELECT list(e.v ORDER BY c) AS v FROM e)")
    + "SELECT subject_id, l_orderkey, l_linenumber, "
    + ", ".join(_f6(" + ".join("(" + " + ".join(f"z{j} * u.v[{c + 1}][{j + 1}]" for j in range(D)) + f") * u.v[{c + 1}][{k + 1}]" for c in range(K_LOW))) + f" AS ug{k}"
                for k in range(D))
    + " FROM z JOIN sp USING (subject_id), u WHERE split = 'train'",
    "ug_closeness_rank2": _rec(_M, _RANK, _Z, _ZP, _COV, _GRAM, *_eigen(D, K_LOW),
                               "pr AS (SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, sum(v[i + 1] * v[j + 1]) AS value FROM e, range(4) t(i), range(4) t2(j) GROUP BY i, j)",
                               "cug AS (SELECT a.i, b.j, sum(a.value * tr.value * b.value) AS value FROM pr a JOIN tr ON tr.i = a.j JOIN pr b ON b.i = tr.j GROUP BY a.i, b.j)")
    + f"SELECT 'CUG_Ctest' AS pair, {_f9('sqrt(sum((cug.value - te.value) * (cug.value - te.value)))')} AS value FROM cug JOIN te USING (i, j) "
      f"UNION ALL SELECT 'Ctrain_Ctest', {_f9(_DIST)} FROM tr JOIN te USING (i, j)",
    "range_projector_d15": _rec(_WIDE, _WIDE_GRAM, *_eigen(15, K_RANGE))
    + f"SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {_f6('sum(v[i + 1] * v[j + 1])')} AS value FROM e, range(15) t(i), range(15) t2(j) GROUP BY i, j",
    "ug_closeness": _with(_M, _RANK, _Z, _ZP, _COV)
    + f"SELECT 'CUG_Ctest' AS pair, {_f9(_DIST)} AS value FROM tr JOIN te USING (i, j) "
      f"UNION ALL SELECT 'Ctrain_Ctest' AS pair, {_f9(_DIST)} AS value FROM tr JOIN te USING (i, j)",
}
