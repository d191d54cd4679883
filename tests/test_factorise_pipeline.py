import os
import tempfile

import numpy as np
import pytest

from conftest import WIDTH, np_fisher, np_zscore, to_dense
from cohortmx.operators.factorise import factor_gram
from cohortmx.plans import pipeline
from cohortmx.sources import sinks


def _numpy_task(mats, n_train, k=None):
    ids = sorted(mats)
    Fs = np.stack([np_fisher(mats[s])[1] for s in ids])
    Xtr = np.vstack([np_zscore(mats[s]) for s in ids[:n_train]])
    Xte = np.vstack([np_zscore(mats[s]) for s in ids[n_train:]])
    u, s, vt = np.linalg.svd(Xtr, full_matrices=False)
    k = k or Xtr.shape[1]
    ug = u[:, :k] @ np.diag(s[:k]) @ vt[:k]
    out = {"Fn": Fs.mean(0), "Fv": Fs.var(0), "Ftrain": Fs[:n_train].mean(0), "Ftest": Fs[n_train:].mean(0),
           "Ctrain": np.cov(Xtr.T), "Ctest": np.cov(Xte.T), "CUG": np.cov(ug.T), "s": s[:k], "UG": ug, "Xtr": Xtr}
    out["CUGCtest"] = np.linalg.norm(out["CUG"] - out["Ctest"])
    out["CtrainCtest"] = np.linalg.norm(out["Ctrain"] - out["Ctest"])
    return out


@pytest.mark.parametrize("k", [None, 2])
def test_pipeline_matches_numpy(spark, main_dir, k):
    d, mats = main_dir
    out = tempfile.mkdtemp(prefix="cohortmx-out-")
    res = pipeline.run(spark, d, out, k=k)
    want = _numpy_task(mats, 3, k)
    for name in ("Fn", "Fv", "Ftrain", "Ftest", "Ctrain", "Ctest", "CUG"):
        got = sinks.read_matrix(spark, os.path.join(out, name + ".csv"), WIDTH).collect()
        assert np.allclose(to_dense(got, col="value"), want[name], atol=1e-10), name
    for name in ("CUGCtest", "CtrainCtest"):
        val = float(spark.read.text(os.path.join(out, name + ".csv")).first()[0])
        assert val == pytest.approx(want[name], abs=1e-10)
    assert np.allclose(res.factors.s, want["s"], atol=1e-10)
    # U: written in (subject, row) order; U G reconstructs the rank-k stack
    U = np.array([[float(v) for v in r] for r in spark.read.csv(os.path.join(out, "U.csv")).collect()])
    names = sorted(f for f in os.listdir(out) if not f.startswith("."))  # local FS adds .crc files
    assert names == sorted(n + ".csv" for n in sinks.OUTPUT_NAMES)
    assert U.shape == (150, res.factors.k)
    assert np.allclose(U @ res.factors.g, want["UG"], atol=1e-9)
    assert np.allclose(U.T @ U, np.eye(res.factors.k), atol=1e-9)
    if k is None:  # full rank: CUG equals Ctrain to rounding
        assert np.allclose(want["Ctrain"], want["CUG"], atol=1e-12)


def test_closed_form_cov_ug_equals_direct(spark):
    rng = np.random.default_rng(9)
    X = np_zscore(rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6)))
    f = factor_gram(spark, X.T @ X, k=3)
    ug = X @ f.projector
    assert np.allclose(f.cov_ug(np.cov(X.T)), np.cov(ug.T), atol=1e-13)


def test_rank_deficient_has_no_division_by_zero(spark):
    rng = np.random.default_rng(4)
    raw = rng.normal(size=(80, 4))
    raw[:, 3] = raw[:, 0] + raw[:, 1]
    X = raw - raw.mean(0)          # one subject: the deficiency survives centring
    f = factor_gram(spark, X.T @ X)
    assert f.s[-1] <= f.tol        # reported as it comes; U's column is 0
    M = f.left_map()
    assert np.all(M[:, -1] == 0.0)
    assert np.all(np.isfinite(M))
    assert np.allclose((X @ M) @ f.g, X, atol=1e-9)


def test_sign_convention(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(50, 5))
    f = factor_gram(spark, X.T @ X)
    idx = np.argmax(np.abs(f.v), axis=0)
    assert np.all(f.v[idx, np.arange(5)] > 0)


def test_threshold_pipeline(spark, main_dir):
    d, mats = main_dir
    from cohortmx.sources.text import read_matrix_dir

    res = pipeline.compute(read_matrix_dir(spark, d).rows, d=WIDTH, split="threshold", cut=211316)
    want = _numpy_task(mats, 4)
    assert np.allclose(to_dense(res.tables["Ctrain"].collect(), col="value"), want["Ctrain"], atol=1e-12)
    assert res.distances["Ctrain_Ctest"] == pytest.approx(want["CtrainCtest"], abs=1e-12)


def test_wide_pipeline_d64_matches_numpy(spark):
    """T5 path: 64 regions (chunk moments) through the whole pipeline."""
    import os

    from cohortmx.sources.tables import embeddings_measurement

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test tables not present")
    meas = embeddings_measurement(spark, sf)
    res = pipeline.compute(meas, d=64, k=8)
    pdf = meas.toPandas()
    mats = {int(s): np.vstack(g.sort_values("row_idx").x.to_numpy()) for s, g in pdf.groupby("subject_id")}
    want = _numpy_task(mats, len(mats) // 2, 8)
    got = {n: to_dense(res.tables[n].collect(), col="value", d=64) for n in ("Fn", "Ftrain", "Ctrain", "Ctest", "CUG")}
    for n, v in got.items():
        assert np.allclose(v, want[n], atol=1e-9), n
    assert np.allclose(res.factors.s, want["s"], rtol=1e-8)
    assert res.distances["CUG_Ctest"] == pytest.approx(want["CUGCtest"], rel=1e-9)
    # invariant: sum of squared singular values = trace of the train Gram
    assert float(np.sum(res.factors.s ** 2)) <= float(np.trace(want["Xtr"].T @ want["Xtr"])) + 1e-6


def test_singular_values_agree_with_rowmatrix(spark, main_dir):
    from pyspark.mllib.linalg.distributed import RowMatrix

    from cohortmx.operators.moments import moments
    from cohortmx.operators.normalise import zscore
    from cohortmx.operators.covariance import zscored_stack_cov
    from cohortmx.operators import matrix as mx
    from cohortmx.sources.text import read_matrix_dir

    d, _ = main_dir
    rows = read_matrix_dir(spark, d).rows
    m = moments(rows, "subject_id", d=WIDTH)
    gram = zscored_stack_cov(m, "subject_id", gram=True)
    f = factor_gram(spark, mx.to_numpy(gram, WIDTH))
    z = zscore(rows, "subject_id", d=WIDTH)
    svd = RowMatrix(z.select("x").rdd.map(lambda r: r["x"])).computeSVD(WIDTH, computeU=False)
    assert np.allclose(np.array(svd.s.toArray()), f.s, rtol=1e-10)


def test_cli_writes_the_eleven_files(spark, main_dir, capsys):
    d, mats = main_dir
    out = tempfile.mkdtemp(prefix="cohortmx-cli-")
    pipeline.main([d, out, "--k", "2", "--suffix", "p5"])
    names = sorted(f for f in os.listdir(out) if not f.startswith("."))
    assert names == sorted(n + "p5.csv" for n in sinks.OUTPUT_NAMES)
    printed = dict(line.split(": ") for line in capsys.readouterr().out.strip().splitlines())
    want = _numpy_task(mats, 3, 2)
    assert float(printed["CUG_Ctest"]) == pytest.approx(want["CUGCtest"], abs=1e-10)
    assert float(printed["Ctrain_Ctest"]) == pytest.approx(want["CtrainCtest"], abs=1e-10)
