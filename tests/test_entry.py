import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 16
    assert df.columns == ["i", "j", "f_mean", "f_var", "n_subjects"]


def test_oracles_are_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_every_query_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() >= 1
    assert len(set(df.columns)) == len(df.columns)
