"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
Each query runs to completion through the ``noop`` sink (nothing is
collected), three times after a warm-up on the sf0.001 tables; a query's
time is the median of its three wall times (build + run, including any
eager checkpoint jobs), and the value is the sum of those medians.
"""

from __future__ import annotations

import json
import os
import uuid
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cohortmx.operators.correlate import corr_from_moments  # noqa: E402
from cohortmx.operators.moments import moments  # noqa: E402
from cohortmx.plans import pipeline  # noqa: E402
from cohortmx.plans.queries import QUERIES  # noqa: E402
from cohortmx.session import scratch_path  # noqa: E402
from cohortmx.sources import sinks  # noqa: E402
from cohortmx.sources.tables import lineitem_measurement, lineitem_wide_measurement  # noqa: E402

REPEATS = 3

HEADLINE = [
    "fisher_mean_var",            # T1 + T2
    "fisher_mean_by_rank_split",  # T3
    "cov_train_test",             # T4 covariances
    "ug_closeness",               # T4 factorisation + distances
    "zscore_rows",                # N1 on every row
    "u_rows",                     # left factor, every train row
    "embedding_corr_wide",        # 64 regions, Arrow chunk moments
]


def corr15(method):
    def q(spark, sf):
        return corr_from_moments(moments(lineitem_wide_measurement(spark, sf), "subject_id", d=15, method=method), "subject_id")
    return q


def full_pipeline(spark, sf):
    res = pipeline.compute(lineitem_measurement(spark, sf), d=4)
    return res.tables["U"]


def text_pipeline(text_dir):
    """The reference's workload shape: subject text files in, the eleven
    CSV results out (parse, T1-T4, U written in order)."""
    def q(spark, sf):
        out = scratch_path(spark, f"bench-out-{uuid.uuid4().hex}")
        res = pipeline.run(spark, text_dir[sf], out, width=4)
        return res.tables["Fn"]
    return q


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("cohortmx-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    runs = {name: QUERIES[name] for name in HEADLINE}
    runs["corr_d15"] = corr15("auto")
    runs["pipeline_t1_t4"] = full_pipeline

    # untimed set-up: the lineitem measures as subject text folders
    text_dir = {}
    for d in {sf, os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")}:
        if os.path.isdir(d):
            text_dir[d] = scratch_path(spark, f"bench-text-{uuid.uuid4().hex}")
            sinks.write_subject_files(lineitem_measurement(spark, d), text_dir[d], 4)
    runs["pipeline_text_to_csv"] = text_pipeline(text_dir)

    # warm-up on the tiny tables: JVM, generated code, Python workers
    tiny = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(tiny):
        for fn in runs.values():
            fn(spark, tiny).write.format("noop").mode("overwrite").save()

    samples = {name: [] for name in runs}
    for _ in range(REPEATS):
        for name, fn in runs.items():
            t0 = time.time()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            samples[name].append(time.time() - t0)
    times = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
