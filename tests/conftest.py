import os
import sys
import tempfile

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# FIXTURES.md section 2: six subjects; 211316 is in the second half by rank
# and in the first half by the id threshold 211316.
MAIN_IDS = [100307, 100408, 101107, 211316, 211417, 250427]
N_ROWS, WIDTH = 50, 4


def make_matrix(rng, n=N_ROWS, d=WIDTH):
    return np.round(rng.normal(size=(n, d)) @ rng.normal(size=(d, d)), 6)


def write_subject(path, mat, newline="\n", sep=" ", trailing=""):
    with open(path, "w", newline="") as fh:
        fh.write(newline.join(sep.join(f"{v:.6f}" for v in row) for row in mat) + trailing)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("cohortmx-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from cohortmx.session import checkpoint_dir

    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def main_dir():
    """The six main subjects as text files (fresh temporary directory)."""
    rng = np.random.default_rng(20180310)
    d = tempfile.mkdtemp(prefix="cohortmx-fixture-")
    mats = {}
    for sid in MAIN_IDS:
        mats[sid] = make_matrix(rng)
        write_subject(os.path.join(d, f"sub{sid}.txt"), mats[sid])
    return d, mats


def np_zscore(x, ddof=0):
    sd = x.std(axis=0, ddof=ddof)
    out = np.zeros_like(x)
    ok = sd > 0
    out[:, ok] = (x[:, ok] - x[:, ok].mean(axis=0)) / sd[ok]
    return out


def np_fisher(x):
    r = np.corrcoef(x, rowvar=False)
    with np.errstate(divide="ignore"):
        f = np.arctanh(np.clip(r, -1, 1))
    f[r >= 1] = 0.0
    np.fill_diagonal(f, 0.0)
    return r, f


def to_dense(rows, key_val=None, d=WIDTH, col="r", key="subject_id"):
    m = np.full((d, d), np.nan)
    for r in rows:
        if key_val is None or r[key] == key_val:
            m[r["i"], r["j"]] = r[col]
    return m
