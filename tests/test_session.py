import os

from cohortmx import session


def test_scratch_tables_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_RUN", "only-this-test")
    kept = session.kept(spark.range(10))
    folder = os.path.dirname(session.scratch_path(spark, "x")).removeprefix("file:")
    assert kept.count() == 10 and os.listdir(folder)
    session.clear_scratch(spark)
    assert not os.path.exists(folder)
    session.clear_scratch(spark)
