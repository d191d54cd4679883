"""T1-T5 end to end: the eleven named results from one measurement table.

Plan (raw rows are read twice in all, whatever d; with ``keep`` the text once):

1. ``moments`` of every subject                     -- pass 1 over the rows
   checkpointed: subjects x d(d+1)/2 rows
2. r, F per subject; Fn, Fv                         -- from (1)
3. subject split (rank or threshold); Ftrain, Ftest -- from (1)
4. Ctrain, Ctest and the train Gram matrix          -- from (1), no rows
5. eigh of the d x d Gram on the driver -> V, s, G; CUG = P Ctrain P
6. U = Z_train V diag(1/s)                          -- pass 2 over the rows
7. Frobenius distances                              -- d x d tables

T5 (300 regions) is the same call: ``auto`` switches the moments to the
Arrow chunk form for wide rows.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matrix as mx
from ..operators.correlate import corr_from_moments, fisher_z
from ..operators.covariance import zscored_sums
from ..operators.factorise import METHODS, Factors, factor_gram, factorise
from ..operators.moments import array_width, mirror, moments
from ..operators.normalise import BROADCAST_LIMIT, apply_zscore, zscore_params
from ..operators.summarise import (attach_split, entry_stats, row_offsets, split_by_rank, split_by_threshold,
                                   subject_dim)
from ..session import clear_scratch, kept, materialize
from ..sources import sinks


PART_BYTES = 128 << 20   # of text of a partition of U


@dataclass
class Results:
    d: int
    tables: dict[str, DataFrame] = field(default_factory=dict)
    factors: Factors | None = None
    distances: dict[str, float] = field(default_factory=dict)
    moments: DataFrame | None = None
    splits: DataFrame | None = None
    arrays: dict[str, np.ndarray] = field(default_factory=dict)  # the small results, on the driver
    rejects: dict[str, int] = field(default_factory=dict)  # rows left out, by reason
    z_train: DataFrame | None = None  # z-scored train rows, input of U, with _rows and _offset of their subject
    n_train_rows: int = 0

    def report(self) -> DataFrame:
        """K7: the two closeness values as ``(pair, distance)`` rows."""
        spark = next(iter(self.tables.values())).sparkSession
        return spark.createDataFrame([(k, float(v)) for k, v in self.distances.items()], "pair string, distance double")


def compute(meas: DataFrame, d: int | None = None, split: str = "rank", n_train: int | None = None,
            cut=None, k: int | None = None, ddof_var: int = 0, ddof_z: int = 0,
            undefined: str = "nan", method: str = "auto", cluster: bool | int = False, factor: str = "gram") -> Results:
    """All results as DataFrames (U lazily, as a row-level plan).

    ``cluster``: see :func:`moments` (scattered layouts with many subjects).
    ``factor``: how the train stack is factored (see
    :mod:`..operators.factorise`); ``tsqr`` and ``random`` read the rows again.
    """
    if factor not in METHODS:
        raise ValueError(f"factor must be one of {METHODS}")
    spark = meas.sparkSession
    d = d or array_width(meas)
    m = materialize(moments(meas, "subject_id", d=d, method=method, cluster=cluster))
    subjects = subject_dim(m)
    if split == "rank":
        splits = split_by_rank(subjects, n_train=n_train)
    elif split == "threshold":
        if cut is None:
            raise ValueError("threshold split needs cut")
        splits = split_by_threshold(subjects, cut)
    else:
        raise ValueError("split must be 'rank' or 'threshold'")
    splits = materialize(splits)
    # the one split join: F and the z-scored sums both come from labelled moments
    labelled = attach_split(m, splits)
    # upper triangle only: F is symmetric, mirror the d x d results
    fz = fisher_z(corr_from_moments(labelled, ["subject_id", "split"], full=False), undefined=undefined)
    stats = entry_stats(fz, ddof=ddof_var, upper=True)
    by_split = entry_stats(fz, by="split", ddof=ddof_var, upper=True)
    sums = mirror(zscored_sums(labelled, "subject_id", ddof_z), ["split"], ["s", "N"])

    # every d x d result in one small collect (7 d^2 rows + 1, bounded by d);
    # one branch per source table, the result name computed per row
    def tag(df, name, value):
        return df.select(name.alias("name"), "i", "j", value.cast("double").alias("value"))

    is_train = F.col("split") == "train"
    small = (tag(stats.select("i", "j", F.explode(F.array(
                 F.struct(F.lit("Fn").alias("n"), F.col("mean").alias("v")),
                 F.struct(F.lit("Fv").alias("n"), F.col("var").alias("v")))).alias("s")),
                 F.col("s.n"), F.col("s.v"))
             .unionByName(tag(by_split, F.when(is_train, "Ftrain").otherwise("Ftest"), F.col("mean")))
             # covariance and, for train, the Gram matrix from one aggregate
             .unionByName(tag(sums.select("split", "i", "j", F.inline(F.array(
                 F.struct(F.when(is_train, "Ctrain").otherwise("Ctest").alias("name"), (F.col("s") / (F.col("N").cast("double") - 1.0)).alias("value")),
                 F.struct(F.when(is_train, F.lit("gram")).alias("name"), F.col("s").alias("value")),
                 F.struct(F.when(is_train & (F.col("i") == 0) & (F.col("j") == 0), F.lit("rows")).alias("name"), F.col("N").cast("double").alias("value"))))).where("name is not null"),
                 F.col("name"), F.col("value")))
             # the subject count rides along: it sizes the z-score join below
             .unionByName(m.where((F.col("i") == 0) & (F.col("j") == 0))
                          .agg(F.count(F.lit(1)).alias("value"))
                          .select(F.lit(0).alias("i"), F.lit(0).alias("j"), "value")
                          .transform(lambda df: tag(df, F.lit("subjects"), F.col("value")))))
    mats = {n: np.full((d, d), np.nan) for n in ("Fn", "Fv", "Ftrain", "Ftest", "Ctrain", "Ctest", "gram")}
    n_subjects = n_train_rows = 0
    for r in small.collect():
        if r["name"] == "subjects":
            n_subjects = int(r["value"])
        elif r["name"] == "rows":
            n_train_rows = int(r["value"])
        else:
            mats[r["name"]][r["i"], r["j"]] = r["value"]

    if not np.isfinite(mats["gram"]).all():
        raise ValueError("the train split has no subject, or its values have NaN or infinity")
    # one row-level join: parameters of train subjects only, so the inner
    # join both keeps the train rows and z-scores them
    # (they also bring how many rows lie before each subject, for writing U in order)
    train = labelled.where((F.col("i") == 0) & (F.col("j") == 0) & (F.col("split") == "train"))
    place = row_offsets(train.select("subject_id", "n")).select("subject_id", F.col("n").alias("_rows"), F.col("offset").alias("_offset"))
    train_params = zscore_params(m, "subject_id", ddof_z).join(place, "subject_id")
    small_params = n_subjects * (24 * d + 80) <= BROADCAST_LIMIT
    placed = apply_zscore(meas, train_params, "subject_id", out="x", d=d, broadcast=small_params, carry=("_rows", "_offset"))
    z_train = placed.drop("_rows", "_offset")
    f = factor_gram(spark, mats["gram"], k) if factor == "gram" else factorise(z_train, "x", k, factor, d)
    ctrain_np, ctest_np = mats["Ctrain"], mats["Ctest"]
    cug_np = f.cov_ug(ctrain_np)
    u = f.u_rows(z_train)

    dist = {"CUG_Ctest": float(np.linalg.norm(cug_np - ctest_np)),
            "Ctrain_Ctest": float(np.linalg.norm(ctrain_np - ctest_np))}
    t = {name: mx.from_numpy(spark, mats[name]) for name in ("Fn", "Fv", "Ftrain", "Ftest", "Ctrain", "Ctest")}
    t.update({
        "U": u,
        "G": f.g_matrix(),
        "CUG": mx.from_numpy(spark, cug_np),
        "CUGCtest": spark.createDataFrame([(dist["CUG_Ctest"],)], "value double"),
        "CtrainCtest": spark.createDataFrame([(dist["Ctrain_Ctest"],)], "value double"),
    })
    arrays = {name: mats[name] for name in ("Fn", "Fv", "Ftrain", "Ftest", "Ctrain", "Ctest")}
    arrays.update({"G": f.g, "CUG": cug_np, "CUGCtest": np.array([[dist["CUG_Ctest"]]]),
                   "CtrainCtest": np.array([[dist["Ctrain_Ctest"]]])})
    return Results(d=d, tables=t, factors=f, distances=dist, moments=m, splits=splits, arrays=arrays,
                   z_train=placed, n_train_rows=n_train_rows)


def in_row_order(placed: DataFrame, n_rows: int, k: int) -> DataFrame:
    """O1/K2: rows by subject and row_idx, in partitions that follow each other.

    A row's place is known (``_offset`` rows before its subject, then row_idx),
    so it is sent to its partition directly: nothing is sampled, the rows are
    read once, and a subject with most of all rows is spread over as many
    partitions as its size takes.  Without row_idx a subject's rows are in
    no order and are dealt within its range by a hash of the row.
    """
    share = max(1, PART_BYTES // (25 * k))             # rows of a partition: text of 25 bytes a number
    parts = max(1, -(-n_rows // share))
    last = F.greatest(F.col("_rows") - 1, F.lit(0))
    order = ["subject_id", "row_idx"] if "row_idx" in placed.columns else ["subject_id"]
    # row_idx may have holes (rejected rows): never beyond the subject's own range
    within = F.least(F.col("row_idx").cast("long"), last) if len(order) == 2 else F.pmod(F.xxhash64("x"), last + 1)
    part = F.least(F.floor((F.col("_offset") + within) / share), F.lit(parts - 1)).cast("int")
    return placed.repartitionById(parts, part).sortWithinPartitions(*order)


def write(res: Results, out_dir: str, suffix: str = "", fmt: str | None = "%.18e",
          single_files: bool = True, u_key: bool = False) -> dict[str, str]:
    """K5: the eleven results under their names, ``suffix`` appended (``p5``).

    The ten small results (d x d matrices, k x d G, two scalars) are written
    by one job as ``<name><suffix>.csv`` files; U, the only tall result, into
    the folder ``U<suffix>.csv/`` (part files in row order), never through a
    single task.  ``u_key``: its lines begin with subject_id and row_idx.
    """
    names = [n for n in sinks.OUTPUT_NAMES if n != "U"]
    if all(n in res.arrays for n in names):
        paths = sinks.write_arrays(res.tables["U"].sparkSession, {n: res.arrays[n] for n in names},
                                   out_dir, suffix, fmt, single_files)
    else:
        small = {}
        for name in names:
            df = res.tables[name]
            if name in ("CUGCtest", "CtrainCtest"):
                small[name] = (df.select(F.lit(0).alias("i"), F.lit(0).alias("j"), "value"), 1)
            else:
                small[name] = (df, res.d)
        paths = sinks.write_small(small, out_dir, suffix, fmt, single_files)
    u = res.tables["U"]
    paths["U"] = os.path.join(out_dir, "U" + suffix + (".csv" if single_files else ""))
    order = ["subject_id", "row_idx"] if "row_idx" in u.columns else ["subject_id"]
    if res.z_train is not None:
        # the Arrow map keeps row order, so the z-scored rows are dealt and sorted, then mapped
        u = res.factors.u_rows(in_row_order(res.z_train, res.n_train_rows, res.factors.k), keep=[c for c in u.columns if c != "u"])
        sinks.write_rows(u, paths["U"], order, "u", res.factors.k, fmt, presorted=True, keys=order if u_key else ())
    else:
        sinks.write_rows(u, paths["U"], order, "u", res.factors.k, fmt, keys=order if u_key else ())
    return {name: paths[name] for name in sinks.OUTPUT_NAMES}


def run(spark: SparkSession, input_dir: str, out_dir: str, glob: str = "sub*.txt", width: int | None = None,
        suffix: str = "", read_opts: dict | None = None, on_reject: str = "fail", keep: str | None = None,
        u_key: bool = False, **kw) -> Results:
    """Read a ``subNNNNNN.txt`` directory, compute, write the eleven files.

    ``read_opts`` go to :func:`read_matrix_dir` (e.g. ids from
    ``sub=NNNNNN`` folders: ``id_from="path", id_regex=r"sub=(\\d+)",
    recursive=True``).  A row that does not parse ends the run
    (``on_reject="fail"``), or is left out and counted by reason in
    ``Results.rejects`` (``"count"``: one more read of the text).

    ``keep`` (K6) writes the parsed rows once and reads them for the moments
    and for U, in place of parsing the text twice: ``"parquet"``, or
    ``"buckets"`` of subjects, which the z-score join reads without a shuffle
    even where its parameters are too many to broadcast (not for data in
    which one subject has a large share of the rows).
    """
    if keep not in (None, "parquet", "buckets"):
        raise ValueError("keep must be None, 'parquet' or 'buckets'")
    if on_reject not in ("fail", "count"):
        raise ValueError("on_reject must be 'fail' or 'count'")
    from ..sources.text import read_matrix_dir

    src = read_matrix_dir(spark, input_dir, glob=glob, width=width, strict=on_reject == "fail", **(read_opts or {}))
    rows = src.rows
    if keep:
        rows = kept(rows, "subject_id" if keep == "buckets" else None, sort=("subject_id", "row_idx"))
    res = compute(rows, d=src.width, **kw)
    if on_reject == "count":
        res.rejects = {r["reason"]: r["count"] for r in src.rejects.groupBy("reason").count().collect()}
    write(res, out_dir, suffix, u_key=u_key)
    return res


def main(argv: list[str] | None = None) -> None:
    """``python -m cohortmx.plans.pipeline INPUT_DIR OUT_DIR [options]``.

    The master and cluster settings come from spark-submit / the
    environment; prints the two distances (K7).
    """
    import argparse

    from ..session import builder

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("input_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--glob", default="sub*.txt")
    ap.add_argument("--width", type=int)
    ap.add_argument("--split", choices=["rank", "threshold"], default="rank")
    ap.add_argument("--n-train", type=int)
    ap.add_argument("--cut", type=int)
    ap.add_argument("--k", type=int)
    ap.add_argument("--ddof-var", type=int, default=0)
    ap.add_argument("--ddof-z", type=int, default=0)
    ap.add_argument("--factor", choices=METHODS, default="gram")
    ap.add_argument("--keep", choices=["parquet", "buckets"])
    ap.add_argument("--u-key", action="store_true")
    ap.add_argument("--suffix", default="")
    ap.add_argument("--on-reject", choices=["fail", "count"], default="fail")
    a = ap.parse_args(argv)
    spark = builder("cohortmx-pipeline").getOrCreate()
    res = run(spark, a.input_dir, a.out_dir, glob=a.glob, width=a.width, suffix=a.suffix, split=a.split,
              n_train=a.n_train, cut=a.cut, k=a.k, ddof_var=a.ddof_var, ddof_z=a.ddof_z, on_reject=a.on_reject, factor=a.factor,
              keep=a.keep, u_key=a.u_key)
    for reason, n in res.rejects.items():
        print(f"rejected, {reason}: {n}")
    for pair, value in res.distances.items():
        print(f"{pair}: {value:.17g}")
    clear_scratch(spark)


if __name__ == "__main__":
    main()
