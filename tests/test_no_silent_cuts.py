"""Ids, rows and values are kept whole or refused aloud."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmx.operators.correlate import corr_matrix, fisher_z
from cohortmx.operators.covariance import zscored_stack_cov
from cohortmx.operators.moments import moments
from cohortmx.operators.summarise import rank_subjects
from cohortmx.plans import pipeline
from cohortmx.sources.sinks import write_matrix_dir
from cohortmx.sources.tables import measurement_from_array, measurement_from_columns, null_rejects
from cohortmx.sources.text import read_delimited, read_matrix_dir

from conftest import make_matrix, write_subject


def folder(tmp_path, subjects):
    d = str(tmp_path / "in")
    os.makedirs(d)
    for sid, mat in subjects.items():
        write_subject(os.path.join(d, f"sub{sid}.txt"), mat)
    return d


def test_long_ids_both_ways(spark, tmp_path):
    ids = [100000, 1000000, 1000001, 200042]
    rng = np.random.default_rng(1)
    src = read_matrix_dir(spark, folder(tmp_path, {i: make_matrix(rng, 6) for i in ids}), width=4)
    assert sorted(r.subject_id for r in src.rows.select("subject_id").distinct().collect()) == sorted(ids)
    out = str(tmp_path / "out")
    write_matrix_dir(src.rows, out, 4)
    assert sorted(os.path.basename(p) for p in os.listdir(out) if p.startswith("sub=")) == ["sub=100000", "sub=1000000", "sub=1000001", "sub=200042"]
    sliced = read_matrix_dir(spark, str(tmp_path / "in"), width=4, id_slice=(3, 9))
    assert {r.subject_id for r in sliced.rows.collect()} == {100000, 200042}
    assert {r.reason for r in sliced.rejects.collect()} == {"no subject id in name"}


def test_run_refuses_or_counts_bad_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    d = folder(tmp_path, {100100 + i: make_matrix(rng, 20) for i in range(4)})
    with open(os.path.join(d, "sub100103.txt"), "a") as fh:
        fh.write("\n1 2 3\n1 2 x 4")
    with pytest.raises(Exception, match="wrong number of values|not a number"):
        pipeline.run(spark, d, str(tmp_path / "a"), width=4)
    res = pipeline.run(spark, d, str(tmp_path / "b"), width=4, on_reject="count")
    assert res.rejects == {"wrong number of values": 1, "not a number": 1}
    with pytest.raises(Exception):
        read_delimited(spark, d, 4).collect()


def test_rows_of_another_length_raise(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0, 3.0])], "s long, x array<double>")
    with pytest.raises(Exception, match="does not hold 2 values"):
        moments(df, "s", d=2).collect()


@pytest.mark.parametrize("d,method", [(4, "wide"), (15, "chunks"), (15, "pairs")])
def test_equal_and_negated_columns_are_exact(spark, d, method):
    rng = np.random.default_rng(3)
    rows = []
    for s in range(12):
        m = rng.normal(size=(30, d)) * 10.0 ** rng.integers(-6, 6)
        m[:, 1], m[:, 2] = m[:, 0], -m[:, 0]
        rows += [(s, r.tolist()) for r in m]
    df = spark.createDataFrame(rows, "subject_id long, x array<double>").repartition(5)
    f = fisher_z(corr_matrix(df, "subject_id", d=d, method=method))
    got = {(r.subject_id, r.i, r.j): (r.r, r.f) for r in f.where("i = 0 and j in (1, 2)").collect()}
    assert all(got[s, 0, 1] == (1.0, 0.0) and got[s, 0, 2] == (-1.0, -math.inf) for s in range(12))


@pytest.mark.parametrize("scale", [1e90, 1e-90])
def test_correlation_of_extreme_scales(spark, scale):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(50, 3)) @ rng.normal(size=(3, 3))
    df = spark.createDataFrame([(1, (r * scale).tolist()) for r in m], "subject_id long, x array<double>")
    got = {(r.i, r.j): r.r for r in corr_matrix(df, "subject_id", d=3).collect()}
    want = np.corrcoef(m.T)
    assert all(got[i, j] == pytest.approx(want[i, j], abs=1e-9) for i in range(3) for j in range(3))


def test_nan_values_stay_visible(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(20, 3))
    m[4, 1] = np.nan
    df = spark.createDataFrame([(s, r.tolist()) for s in (1, 2) for r in (m if s == 1 else rng.normal(size=(20, 3)))], "subject_id long, x array<double>")
    c = {(r.i, r.j): r.value for r in zscored_stack_cov(moments(df, "subject_id", d=3), "subject_id").collect()}
    assert math.isnan(c[0, 1]) and math.isnan(c[1, 1]) and not math.isnan(c[0, 2])


def test_one_subject_has_no_train_split(spark, tmp_path):
    with pytest.raises(ValueError, match="train split"):
        pipeline.run(spark, folder(tmp_path, {100001: make_matrix(np.random.default_rng(6))}), str(tmp_path / "o"), width=4)


def test_ranks_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ranks = rank_subjects(spark.range(300_000).select((F.col("id") * 7).alias("subject_id")), partitions=8)
        row = ranks.agg(F.countDistinct("rank").alias("n"), F.min("rank").alias("a"), F.max("rank").alias("b")).collect()[0]
        assert (row.n, row.a, row.b) == (300_000, 1, 300_000)
        assert ranks.where("subject_id <> (rank - 1) * 7").isEmpty()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_null_measures_are_refused_or_counted(spark):
    rows = [(1, 1.0, 2.0, [1.0, 2.0]), (1, None, 5.0, None), (1, 2.0, None, [1.0, None]), (None, 3.0, 3.0, [3.0, 3.0]), (2, 4.0, 4.0, [4.0, 4.0])]
    df = spark.createDataFrame(rows, "s int, a double, b double, e array<double>")
    for made in (measurement_from_columns(df, "s", ["a", "b"]), measurement_from_array(df, "s", "e")):
        for action in (made.collect, made.select("subject_id").collect, made.count):
            with pytest.raises(Exception, match="no value in|a NULL within|no subject id"):
                action()
    for made in (measurement_from_columns(df, "s", ["a", "b"], strict=False), measurement_from_array(df, "s", "e", strict=False)):
        assert sorted((r.subject_id, list(r.x)) for r in made.collect()) == [(1, [1.0, 2.0]), (2, [4.0, 4.0])]
    assert {r.reason: r["count"] for r in null_rejects(df, "s", ["a", "b"]).collect()} == {"no subject id": 1, "no value in a": 1, "no value in b": 1}
    assert {r.reason: r["count"] for r in null_rejects(df, "s", array_col="e").collect()} == {"no subject id": 1, "no value in e": 1, "a NULL within e": 1}
    whole = df.where("s is not null and a is not null and b is not null")
    assert measurement_from_columns(whole, "s", ["a", "b"]).count() == 2
