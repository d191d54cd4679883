"""Pairwise complete moments and the merge of runs, against pandas and numpy."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortmx import corr_from_moments, corr_matrix, pairwise_moments
from cohortmx.operators import runs as rn
from cohortmx.operators.moments import moments
from cohortmx.sources.tables import measurement_from_array, measurement_from_columns
from cohortmx.sources.text import read_matrix_dir


def with_gaps(spark, mats, parts):
    rows = [(k, None if np.isnan(r).all() and i % 2 else [None if np.isnan(v) else float(v) for v in r]) for k, m in mats.items() for i, r in enumerate(m)]
    return spark.createDataFrame(rows, "subject_id long, x array<double>").repartition(parts)


def gappy(rng, n, d, share):
    m = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 1e4
    m[rng.random((n, d)) < share] = np.nan
    return m


@pytest.mark.parametrize("method", ["wide", "pairs", "chunks"])
@pytest.mark.parametrize("d", [4, 17])
def test_pairwise_is_pandas_corr(spark, method, d):
    if method == "wide" and d == 17:
        pytest.skip("153 pairs of eight aggregates: not a form for 17 regions")
    rng = np.random.default_rng(d)
    mats = {1: gappy(rng, 300, d, 0.3), 2: gappy(rng, 40, d, 0.7), 3: gappy(rng, 9, d, 0.9), 4: gappy(rng, 5, d, 1.0)}
    mats[1][:, 1] = mats[1][:, 0]                      # equal where present
    mats[1][::3, 1] = np.nan
    mats[2][:, 2] = np.where(np.isnan(mats[2][:, 2]), np.nan, 7.0)   # constant
    m = pairwise_moments(with_gaps(spark, mats, 5), "subject_id", d=d, method=method)
    got = {(r["subject_id"], r["i"], r["j"]): (r["r"], r["n"]) for r in corr_from_moments(m, "subject_id", keep_n=True).collect()}
    assert len(got) == 4 * d * d
    for k, mat in mats.items():
        frame = pd.DataFrame(mat)
        want = frame.corr(min_periods=2).to_numpy()
        ok = ~np.isnan(mat)
        for i in range(d):
            for j in range(d):
                both = ok[:, i] & ok[:, j]
                r, n = got[(k, i, j)]
                assert n == both.sum()
                flat = n < 2 or any(np.ptp(mat[both, c]) == 0 for c in (i, j))
                assert (np.isnan(r) if flat else r == pytest.approx(want[i, j], abs=1e-9)), (k, i, j)
    assert got[(1, 0, 1)][0] == 1.0


def test_without_gaps_it_is_the_complete_table(spark):
    rng = np.random.default_rng(5)
    df = with_gaps(spark, {1: gappy(rng, 60, 6, 0.0), 2: gappy(rng, 60, 6, 0.0)}, 3)
    order = lambda m: sorted(map(tuple, m.collect()), key=lambda r: r[:3])
    a = order(moments(df, "subject_id", d=6, method="pairs"))
    for method in ("wide", "pairs", "chunks"):
        for r, s in zip(a, order(pairwise_moments(df, "subject_id", d=6, method=method))):
            assert r[:4] == s[:4] and r[9:] == s[9:]
            assert r[4:9] == pytest.approx(s[4:9], rel=1e-9)


def test_gaps_from_tables_and_text(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0, None, [1.0, None]), (1, 2.0, 3.0, None), (1, 3.0, 5.0, [2.0, 2.0])], "s long, a double, b double, v array<float>")
    r = corr_matrix(measurement_from_columns(df, "s", ["a", "b"], gaps=True), "subject_id", d=2, pairwise=True)
    assert r.where("i = 0 and j = 1").first()["r"] == 1.0
    m = pairwise_moments(measurement_from_array(df, "s", "v", gaps=True), "subject_id", d=2, method="chunks")
    assert sorted((r["i"], r["j"], r["n"]) for r in m.collect()) == [(0, 0, 2), (0, 1, 1), (1, 1, 1)]
    with pytest.raises(Exception, match="no value in b"):
        measurement_from_columns(df, "s", ["a", "b"]).collect()
    with open(os.path.join(tmp_path, "sub100001.txt"), "w") as fh:
        fh.write("1 2 3\n4 NA 6\n7 x 9\n")
    src = read_matrix_dir(spark, str(tmp_path), gaps=("NA",))
    assert [r["x"] for r in src.rows.orderBy("row_idx").collect()] == [[1.0, 2.0, 3.0], [4.0, None, 6.0]]
    assert [r["reason"] for r in src.rejects.collect()] == ["not a number"]
    assert read_matrix_dir(spark, str(tmp_path)).rejects.count() == 2


def test_nan_is_a_value_and_spreads(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, float("nan")]), (1, [2.0, 1.0, 5.0]), (1, [4.0, None, 1.0])], "s long, x array<double>")
    for method in ("wide", "pairs", "chunks"):
        got = {(r["i"], r["j"]): r["r"] for r in corr_from_moments(pairwise_moments(df, "s", d=3, method=method), "s").collect()}
        assert got[(0, 1)] == pytest.approx(-1.0) and np.isnan(got[(0, 2)])


@pytest.mark.parametrize("fan_in", [2, 64])
@pytest.mark.parametrize("keys", [["k"], ["a", "k"]])
def test_runs_merge_alike_whatever_the_layout(spark, monkeypatch, fan_in, keys):
    """Scattered rows, rows in order, one key in every part, null keys."""
    monkeypatch.setattr(rn, "FAN_IN", fan_in)
    rng = np.random.default_rng(8)
    rows = [(None if k == 0 else f"k{k}", k % 2, [float(v) for v in rng.normal(size=5) + 100]) for k in (0, 1, 2, 3) for _ in range(50 if k == 1 else 8)]
    df = spark.createDataFrame(rows, "k string, a int, x array<double>")
    tables = []
    for layout in (df.repartition(13), df.repartition(7, "k"), df.coalesce(1), df.repartitionByRange(4, "k", F.xxhash64("x"))):
        m = moments(layout, keys, d=5, method="chunks").collect()
        assert len(m) == 4 * 15
        tables.append(sorted([[str(r["k"]), r["i"], r["j"], r["n"], r["mean_i"], r["c_ij"], r["c_jj"]] for r in m], key=lambda r: r[:3]))
    for t in tables[1:]:
        for r, s in zip(tables[0], t):
            assert r[:4] == s[:4] and r[4:] == pytest.approx(s[4:], rel=1e-10)


def test_runs_of_one_part_keys_are_not_shuffled(spark):
    """One run a key: no exchange but the counts'; the arrays stay packed."""
    df = spark.createDataFrame([(k, [float(k + i), float(i * i)]) for k in range(6) for i in range(5)], "k long, x array<double>").repartition(3, "k")
    state = rn.Complete(2)
    merged = rn.merge_runs(rn.run_states(df, ["k"], "x", state), ["k"], state)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Explode" not in plan
    assert merged.count() == 6
