import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MAIN_IDS, WIDTH, np_fisher, to_dense
from cohortmx import corr_matrix, entry_stats, fisher_z, moments
from cohortmx.operators.correlate import corr_from_moments
from cohortmx.sources.text import read_matrix_dir


@pytest.mark.parametrize("method", ["wide", "pairs", "chunks"])
def test_corr_and_fisher_match_numpy(spark, main_dir, method):
    d, mats = main_dir
    rows = read_matrix_dir(spark, d).rows
    fz = fisher_z(corr_matrix(rows, "subject_id", d=WIDTH, method=method)).collect()
    assert len(fz) == len(MAIN_IDS) * WIDTH * WIDTH
    for sid, mat in mats.items():
        r, f = np_fisher(mat)
        assert np.allclose(to_dense(fz, sid, col="r"), r, atol=1e-13)
        assert np.allclose(to_dense(fz, sid, col="f"), f, atol=1e-12)
        assert np.all(np.diag(to_dense(fz, sid, col="f")) == 0.0)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_layout_independence(spark, main_dir, parts):
    d, mats = main_dir
    rows = read_matrix_dir(spark, d).rows.repartition(parts)
    for method in ("wide", "pairs", "chunks"):
        got = corr_matrix(rows, "subject_id", d=WIDTH, method=method).collect()
        for sid, mat in mats.items():
            assert np.allclose(to_dense(got, sid), np.corrcoef(mat, rowvar=False), atol=1e-12)


def _edge_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 3))
    cases = {}
    c = base.copy(); c[:, 1] = 1.0; cases[1] = c                 # constant column
    e = base.copy(); e[:, 1] = e[:, 0]; cases[2] = e             # equal columns
    n = base.copy(); n[:, 1] = -n[:, 0]; cases[3] = n            # negated columns
    cases[4] = base[:1].copy()                                   # one row
    data = [(sid, i, [float(v) for v in row]) for sid, m in cases.items() for i, row in enumerate(m)]
    return spark.createDataFrame(data, "subject_id long, row_idx int, x array<double>"), cases


@pytest.mark.parametrize("method", ["wide", "pairs", "chunks"])
def test_edge_cases(spark, method):
    df, _ = _edge_rows(spark)
    got = fisher_z(corr_matrix(df.repartition(3), "subject_id", d=3, method=method)).collect()
    cell = {(r["subject_id"], r["i"], r["j"]): (r["r"], r["f"]) for r in got}
    # constant column: r NaN, F NaN (off-diagonal), diagonal F 0
    assert math.isnan(cell[(1, 0, 1)][0]) and math.isnan(cell[(1, 0, 1)][1])
    assert math.isnan(cell[(1, 1, 1)][0]) and cell[(1, 1, 1)][1] == 0.0
    # equal columns: r = 1 exactly, F = 0
    assert cell[(2, 0, 1)] == (1.0, 0.0)
    # negated columns: r = -1, F = -inf
    assert cell[(3, 0, 1)][0] == -1.0 and cell[(3, 0, 1)][1] == float("-inf")
    # one row: r undefined
    assert math.isnan(cell[(4, 0, 1)][0])
    # skip option drops the undefined entries from later means
    skip = fisher_z(corr_matrix(df, "subject_id", d=3, method=method), undefined="skip")
    assert skip.where(F.isnan("f")).count() == 0


def test_moments_forms_agree(spark, main_dir):
    d, _ = main_dir
    rows = read_matrix_dir(spark, d).rows.repartition(5)
    a = {(r["subject_id"], r["i"], r["j"]): r for r in moments(rows, "subject_id", d=WIDTH, method="pairs").collect()}
    for other in ("chunks", "wide"):
        b = {(r["subject_id"], r["i"], r["j"]): r
             for r in moments(rows, "subject_id", d=WIDTH, method=other).collect()}
        assert a.keys() == b.keys()
        for k in a:
            assert a[k]["n"] == b[k]["n"]
            assert (a[k]["const_i"], a[k]["const_j"]) == (b[k]["const_i"], b[k]["const_j"])
            for c in ("mean_i", "mean_j", "c_ij", "c_ii", "c_jj"):
                assert a[k][c] == pytest.approx(b[k][c], rel=1e-12, abs=1e-12)


def test_entry_stats_match_numpy(spark, main_dir):
    d, mats = main_dir
    rows = read_matrix_dir(spark, d).rows
    fz = fisher_z(corr_matrix(rows, "subject_id", d=WIDTH))
    F_all = np.stack([np_fisher(mats[s])[1] for s in MAIN_IDS])
    for ddof in (0, 1):
        st = entry_stats(fz, ddof=ddof).collect()
        assert np.allclose(to_dense(st, col="mean"), F_all.mean(axis=0), atol=1e-12)
        assert np.allclose(to_dense(st, col="var"), F_all.var(axis=0, ddof=ddof), atol=1e-12)


def test_clustered_chunks_same_result(spark, main_dir):
    d, mats = main_dir
    rows = read_matrix_dir(spark, d).rows
    m = moments(rows.repartition(5), "subject_id", d=WIDTH, method="chunks", cluster=3)
    got = corr_from_moments(m, "subject_id").collect()
    for sid, mat in mats.items():
        assert np.allclose(to_dense(got, sid), np.corrcoef(mat, rowvar=False), atol=1e-12)


@pytest.mark.parametrize("d,tile", [(13, 4), (12, 4), (9, 5), (7, 3)])
def test_tiles_are_the_chunks(spark, monkeypatch, d, tile):
    from cohortmx.operators import moments as mo

    monkeypatch.setattr(mo, "TILE", tile)
    rng = np.random.default_rng(d)
    rows = [(k, [float(v) for v in np.where(np.arange(d) == 2, 7.0, rng.normal(size=d) + k)]) for k in range(3) for _ in range(20 + 30 * (k == 1))]
    df = spark.createDataFrame(rows, "subject_id long, x array<double>").repartition(4)
    a, b = ({(r["subject_id"], r["i"], r["j"]): tuple(r)[3:] for r in moments(df, "subject_id", d=d, method=m).collect()} for m in ("pairs", "tiles"))
    assert a.keys() == b.keys() and len(b) == 3 * d * (d + 1) // 2
    for k in a:
        assert a[k][0] == b[k][0] and a[k][6:] == b[k][6:] and a[k][1:6] == pytest.approx(b[k][1:6], abs=1e-10)


def test_a_tile_holds_its_width_not_all(spark, monkeypatch):
    """No state of a task is larger than two tiles make it."""
    from cohortmx.operators import moments as mo
    from cohortmx.operators import runs as rn

    seen = []
    monkeypatch.setattr(mo, "TILE", 8)
    monkeypatch.setattr(mo, "run_states", lambda df, keys, x, state: seen.append(state.d) or rn.run_states(df, keys, x, state))
    df = spark.createDataFrame([(1, [float((i * j) % 7) for j in range(300)]) for i in range(20)], "subject_id long, x array<double>")
    got = moments(df, "subject_id", d=300, method="tiles")
    assert seen == [16] and got.count() == 300 * 301 // 2
