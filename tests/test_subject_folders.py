"""Folders of subject text files, written and read back."""

import glob
import os

import numpy as np
from pyspark.sql import functions as F

from cohortmx.sources.sinks import write_matrix_dir
from cohortmx.sources.text import read_matrix_dir

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def test_scattered_subjects_get_few_files(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(int(k), [float(v) for v in rng.normal(size=3)]) for k in rng.integers(0, 40, 2000)]
    df = spark.createDataFrame(rows, "subject_id long, x array<double>").repartition(12)
    write_matrix_dir(df, str(tmp_path / "out"), 3)
    files = glob.glob(str(tmp_path / "out" / "sub=*" / "part-*"))
    assert 40 <= len(files) < 40 + int(spark.conf.get("spark.sql.shuffle.partitions"))
    was = spark.conf.get(LISTING, None)
    back = read_matrix_dir(spark, str(tmp_path / "out"), glob="*.txt", id_regex=r"sub=(\d+)", id_from="path", recursive=True, width=3)
    assert spark.conf.get(LISTING, None) == was
    assert sorted((r.subject_id, list(r.x)) for r in back.rows.collect()) == sorted(rows)
    assert back.rejects.count() == 0


def test_a_folder_is_in_row_order(spark, tmp_path):
    rows = [(k, i, [float(i)]) for k in range(5) for i in range(30)]
    df = spark.createDataFrame(rows, "subject_id long, row_idx int, x array<double>").orderBy(F.xxhash64("subject_id", "row_idx"))
    write_matrix_dir(df, str(tmp_path / "out"), 1)
    for k in range(5):
        files = sorted(glob.glob(str(tmp_path / "out" / f"sub={k:06d}" / "part-*")), key=os.path.basename)
        assert [float(v) for f in files for v in open(f)] == [float(i) for i in range(30)]
