import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MAIN_IDS, WIDTH, np_fisher, np_zscore, to_dense
from cohortmx import (attach_split, column_stats, corr_matrix, entry_stats, fisher_z, moments, rank_subjects,
                      split_by_rank, split_by_threshold, subject_dim, zscore, zscored_stack_cov)
from cohortmx.operators import matrix as mx
from cohortmx.sources.text import read_matrix_dir


def test_rank_is_global_order(spark):
    ids = spark.range(0, 1000).select(((F.col("id") * 7919) % 100003).alias("subject_id"))
    got = rank_subjects(ids, partitions=7).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 1001))
    assert [r["subject_id"] for r in got] == sorted(r["subject_id"] for r in got)
    assert {r["n_subjects"] for r in got} == {1000}


def test_rank_and_threshold_split_differ_on_purpose(spark, main_dir):
    d, _ = main_dir
    subj = subject_dim(read_matrix_dir(spark, d).rows)
    by_rank = {r["subject_id"]: r["split"] for r in split_by_rank(subj).collect()}
    by_cut = {r["subject_id"]: r["split"] for r in split_by_threshold(subj, 211316).collect()}
    assert [s for s in MAIN_IDS if by_rank[s] == "train"] == MAIN_IDS[:3]
    assert [s for s in MAIN_IDS if by_cut[s] == "train"] == MAIN_IDS[:4]


def test_odd_count_and_explicit_n_train(spark):
    subj = spark.createDataFrame([(i,) for i in (5, 1, 9, 3, 7)], "subject_id long")
    half = {r["subject_id"]: r["split"] for r in split_by_rank(subj).collect()}
    assert sorted(k for k, v in half.items() if v == "train") == [1, 3]
    three = {r["subject_id"]: r["split"] for r in split_by_rank(subj, n_train=3).collect()}
    assert sorted(k for k, v in three.items() if v == "train") == [1, 3, 5]


def test_train_test_fisher_means(spark, main_dir):
    d, mats = main_dir
    rows = read_matrix_dir(spark, d).rows
    fz = fisher_z(corr_matrix(rows, "subject_id", d=WIDTH))
    st = entry_stats(attach_split(fz, split_by_rank(subject_dim(fz))), by="split").collect()
    for split, ids in (("train", MAIN_IDS[:3]), ("test", MAIN_IDS[3:])):
        want = np.mean([np_fisher(mats[s])[1] for s in ids], axis=0)
        got = to_dense([r for r in st if r["split"] == split], col="mean")
        assert np.allclose(got, want, atol=1e-12)


@pytest.mark.parametrize("ddof", [0, 1])
def test_column_stats_and_zscore(spark, main_dir, ddof):
    d, mats = main_dir
    rows = read_matrix_dir(spark, d).rows
    cs = column_stats(rows, "subject_id", d=WIDTH).collect()
    for r in cs:
        col = mats[r["subject_id"]][:, r["k"]]
        assert r["mean"] == pytest.approx(col.mean(), abs=1e-12)
        assert r["sd_pop"] == pytest.approx(col.std(), abs=1e-12)
        assert r["sd_samp"] == pytest.approx(col.std(ddof=1), abs=1e-12)
    for bc in (True, False):
        z = zscore(rows, "subject_id", d=WIDTH, ddof=ddof, broadcast=bc).collect()
        for sid, mat in mats.items():
            got = np.array([r["x"] for r in sorted(z, key=lambda r: r["row_idx"]) if r["subject_id"] == sid])
            assert np.allclose(got, np_zscore(mat, ddof), atol=1e-12)


def test_zscore_constant_column_is_zero(spark):
    data = [(1, i, [float(i), 2.5, float(i * i)]) for i in range(6)]
    df = spark.createDataFrame(data, "subject_id long, row_idx int, x array<double>")
    z = zscore(df, "subject_id", d=3).collect()
    assert all(r["x"][1] == 0.0 for r in z)


def test_stack_covariance_matches_numpy(spark, main_dir):
    d, mats = main_dir
    rows = read_matrix_dir(spark, d).rows
    m = moments(rows, "subject_id", d=WIDTH)
    splits = split_by_rank(subject_dim(m))
    cov = zscored_stack_cov(m, "subject_id", splits).collect()
    gram = zscored_stack_cov(m, "subject_id", splits, gram=True).collect()
    for split, ids in (("train", MAIN_IDS[:3]), ("test", MAIN_IDS[3:])):
        X = np.vstack([np_zscore(mats[s]) for s in ids])
        assert np.allclose(to_dense([r for r in cov if r["split"] == split], col="value"), np.cov(X.T), atol=1e-12)
        assert np.allclose(to_dense([r for r in gram if r["split"] == split], col="value"), X.T @ X, atol=1e-10)


def test_unequal_lengths_weight_by_rows(spark):
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=(40, 3)), rng.normal(size=(60, 3)) @ rng.normal(size=(3, 3))
    data = [(1, i, r.tolist()) for i, r in enumerate(a)] + [(2, i, r.tolist()) for i, r in enumerate(b)]
    df = spark.createDataFrame(data, "subject_id long, row_idx int, x array<double>")
    cov = zscored_stack_cov(moments(df, "subject_id", d=3), "subject_id").collect()
    X = np.vstack([np_zscore(a), np_zscore(b)])
    assert np.allclose(to_dense(cov, col="value", d=3), np.cov(X.T), atol=1e-12)


def test_matrix_helpers(spark):
    rng = np.random.default_rng(5)
    A, B = rng.normal(size=(4, 4)), rng.normal(size=(4, 4))
    a, b = mx.from_numpy(spark, A), mx.from_numpy(spark, B)
    assert np.allclose(mx.to_numpy(mx.transpose(a), 4), A.T)
    assert np.allclose(mx.to_numpy(mx.multiply(a, b), 4), A @ B)
    assert np.allclose(mx.to_numpy(mx.subtract(a, b), 4), A - B)
    assert np.allclose(mx.to_numpy(mx.subtract_union(a, b), 4), A - B)
    assert mx.distance(a, b).first()["value"] == pytest.approx(np.linalg.norm(A - B))
    assert mx.distance(a, a).first()["value"] == 0.0
