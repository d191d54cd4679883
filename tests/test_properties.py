"""Property tests: the three moment forms agree with numpy on random inputs,
including a hot subject holding most rows and constant columns."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortmx import corr_from_moments, zscored_stack_cov
from cohortmx.operators.moments import moments
from conftest import np_zscore


@st.composite
def datasets(draw):
    d = draw(st.integers(2, 6))
    n_keys = draw(st.integers(1, 5))
    sizes = [draw(st.integers(2, 40)) for _ in range(n_keys)]
    sizes[0] += draw(st.integers(0, 200))          # a hot subject
    seed = draw(st.integers(0, 2**31 - 1))
    const_col = draw(st.one_of(st.none(), st.integers(0, d - 1)))
    parts = draw(st.integers(1, 7))
    rng = np.random.default_rng(seed)
    mats = {}
    for k, n in enumerate(sizes):
        m = np.round(rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 10, 3)
        if const_col is not None:
            m[:, const_col] = 2.5
        mats[k + 1] = m
    return d, mats, parts


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=datasets())
def test_forms_agree_with_numpy(spark, data):
    d, mats, parts = data
    rows = [(k, i, [float(v) for v in r]) for k, m in mats.items() for i, r in enumerate(m)]
    df = spark.createDataFrame(rows, "subject_id long, row_idx int, x array<double>").repartition(parts)
    for method, cluster in (("wide", False), ("pairs", False), ("chunks", False), ("chunks", 3)):
        m_ = moments(df, "subject_id", d=d, method=method, cluster=cluster)
        got = {(r["subject_id"], r["i"], r["j"]): r["r"]
               for r in corr_from_moments(m_, "subject_id").collect()}
        for k, m in mats.items():
            sd = m.std(axis=0)
            with np.errstate(invalid="ignore", divide="ignore"):
                want = np.corrcoef(m, rowvar=False)
            for i in range(d):
                for j in range(d):
                    g = got[(k, i, j)]
                    if sd[i] == 0 or sd[j] == 0:
                        assert np.isnan(g), (method, k, i, j)
                    else:
                        assert abs(g - want[i, j]) < 1e-9, (method, k, i, j, g, want[i, j])
    cov = {(r["i"], r["j"]): r["value"]
           for r in zscored_stack_cov(moments(df, "subject_id", d=d), "subject_id").collect()}
    X = np.vstack([np_zscore(m) for m in mats.values()])
    C = np.cov(X.T)
    for (i, j), v in cov.items():
        assert abs(v - C[i, j]) < 1e-9
