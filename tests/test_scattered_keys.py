"""Subjects whose rows lie scattered over the table's partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmx.operators import moments as mo
from cohortmx.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query", ["subject_corr_pairwise_d15", "subject_corr_d15"])
def test_states_are_bounded_by_subjects_not_by_partitions(spark, tmp_path, monkeypatch, query):
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet").withColumn("l_suppkey", F.col("l_orderkey") % 50)
    li.repartition(32).write.parquet(str(tmp_path / "lineitem.parquet"))
    seen = []

    def spy(runs, keys, state):
        seen.append(runs.count())
        return merge(runs, keys, state)

    merge = mo.merge_runs
    monkeypatch.setattr(mo, "merge_runs", spy)
    out = QUERIES[query](spark, str(tmp_path))
    subjects = li.select("l_suppkey").distinct().count()
    assert out.count() == subjects * 17 * 17
    assert subjects <= seen[0] < subjects + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_clustered_pairwise_is_the_same_table(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), [None if rng.random() < 0.3 else float(v) for v in rng.normal(size=6)]) for k in rng.integers(0, 9, 600)]
    df = spark.createDataFrame(rows, "subject_id long, x array<double>").repartition(7)
    order = lambda m: sorted(map(tuple, m.collect()), key=lambda r: r[:3])
    a = order(mo.pairwise_moments(df, "subject_id", d=6, method="chunks"))
    b = order(mo.pairwise_moments(df, "subject_id", d=6, method="chunks", cluster=True))
    assert len(a) == len(b) == 9 * 21
    for p, q in zip(a, b):
        assert p[:4] == q[:4] and p[4:9] == pytest.approx(q[4:9], abs=1e-12) and p[9:] == q[9:]
