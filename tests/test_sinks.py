import os
import uuid

import numpy as np

from cohortmx.session import scratch_path
from cohortmx.sources.sinks import read_matrix, write_arrays


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_write_arrays_names_suffix_and_special_values(spark):
    out = scratch_path(spark, f"sinks-{uuid.uuid4().hex}")
    a = np.array([[1.5, np.nan], [-np.inf, 0.25]])
    paths = write_arrays(spark, {"Fn": a, "CUGCtest": np.array([[3.0]])}, out, suffix="p5")
    assert paths == {"Fn": f"{out}/Fnp5.csv", "CUGCtest": f"{out}/CUGCtestp5.csv"}
    with open(_local(paths["Fn"])) as fh:
        assert fh.read().splitlines() == ["1.500000000000000000e+00,nan", "-inf,2.500000000000000000e-01"]
    with open(_local(paths["CUGCtest"])) as fh:
        assert fh.read().strip() == "3.000000000000000000e+00"
    back = {(r["i"], r["j"]): r["value"] for r in read_matrix(spark, paths["Fn"], 2).collect()}
    assert back[(0, 0)] == 1.5 and np.isnan(back[(0, 1)]) and back[(1, 0)] == -np.inf


def test_write_arrays_folder_layout(spark):
    out = scratch_path(spark, f"sinks-{uuid.uuid4().hex}")
    paths = write_arrays(spark, {"G": np.eye(2)}, out, single_files=False, fmt="%f")
    files = [f for f in os.listdir(_local(paths["G"])) if f.startswith("part-")]
    assert len(files) == 1
    with open(os.path.join(_local(paths["G"]), files[0])) as fh:
        assert fh.read().splitlines() == ["1.000000,0.000000", "0.000000,1.000000"]
