"""Files read in splits, U written in order without sampling, kept input, 300 regions."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_matrix, np_zscore, to_dense, write_subject
from cohortmx import row_offsets
from cohortmx.operators.normalise import apply_zscore, zscore_params
from cohortmx.operators.moments import moments
from cohortmx.plans import pipeline
from cohortmx.session import kept
from cohortmx.sources import sinks
from cohortmx.sources.text import read_matrix_dir, split_file_lines, split_lines, whole_files


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "256")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def lines_of(df):
    return sorted((r["file_name"], r["row_idx"], r["line"]) for r in df.collect())


def test_split_lines_are_the_whole_files_lines(spark, tmp_path, small_splits):
    rng = np.random.default_rng(1)
    texts = {"sub100001.txt": "\n".join(f"{i} {rng.random()}" for i in range(2000)) + "\n",     # 45 kB: many splits
             "sub100002.txt": "1 2\r\n3 4\r\n\r\n5 6\r\n\r\n \r\n", "sub100003.txt": "1 2\n\n\n3 4", "sub100004.txt": "\n\n  \n",
             "sub100005.txt": "7 8", "sub100006.txt": "\n" * 3000 + "9 9\n" + "\n" * 3000}
    for name, text in texts.items():
        with open(tmp_path / name, "w", newline="") as fh:
            fh.write(text)
    whole = split_lines(whole_files(spark.read.text(str(tmp_path), wholetext=True)))
    split = split_file_lines(spark, str(tmp_path))
    assert lines_of(split) == lines_of(whole)
    tasks = split.where("file_name = 'sub100001.txt'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5


def test_a_large_file_is_read_in_splits_by_itself(spark, tmp_path, small_splits, monkeypatch):
    from cohortmx.sources import text

    rng = np.random.default_rng(2)
    mats = {100001: make_matrix(rng, 900), 100002: make_matrix(rng, 30)}
    for sid, mat in mats.items():
        write_subject(str(tmp_path / f"sub{sid}.txt"), mat)
    want = read_matrix_dir(spark, str(tmp_path), by_line=False).rows.orderBy("subject_id", "row_idx").collect()
    monkeypatch.setattr(text, "WHOLE_BYTES", 10_000)
    got = read_matrix_dir(spark, str(tmp_path))
    assert got.rows.orderBy("subject_id", "row_idx").collect() == want
    assert got.rows.rdd.getNumPartitions() > 5 and got.rejects.count() == 0


def test_two_files_with_one_id_are_refused(spark, tmp_path):
    rng = np.random.default_rng(3)
    for folder, name in (("a", "sub000001.txt"), ("b", "sub000001.txt"), ("a", "sub000002.txt")):
        os.makedirs(tmp_path / folder, exist_ok=True)
        write_subject(str(tmp_path / folder / name), make_matrix(rng, 5))
    with pytest.raises(ValueError, match="one subject id: 1: .*a/sub000001.txt.*b/sub000001.txt"):
        read_matrix_dir(spark, str(tmp_path), recursive=True)
    assert read_matrix_dir(spark, str(tmp_path / "a")).rows.count() == 10
    write_subject(str(tmp_path / "a" / "sub0000001.txt"), make_matrix(rng, 5))       # 0000001 is 1 too
    with pytest.raises(ValueError, match="one subject id"):
        read_matrix_dir(spark, str(tmp_path / "a"))


def test_row_offsets_are_running_sums(spark):
    rng = np.random.default_rng(4)
    ids = rng.permutation(500)[:200]
    n = rng.integers(1, 50, 200)
    got = {r["subject_id"]: r["offset"] for r in row_offsets(spark.createDataFrame([(int(i), int(c)) for i, c in zip(ids, n)], "subject_id long, n long"), partitions=7).collect()}
    order = np.argsort(ids)
    assert got == {int(ids[o]): int(b) for o, b in zip(order, np.concatenate([[0], np.cumsum(n[order])[:-1]]))}


def subjects(spark, sizes, d=4, seed=5):
    rng = np.random.default_rng(seed)
    mats = {sid: make_matrix(rng, n, d) for sid, n in sizes.items()}
    rows = [(sid, i, [float(v) for v in r]) for sid, m in mats.items() for i, r in enumerate(m)]
    return spark.createDataFrame(rows, "subject_id long, row_idx int, x array<double>").repartition(5), mats


def test_u_is_in_order_keyed_and_not_sampled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "PART_BYTES", 25 * 4 * 64)          # 64 rows a part
    rows, mats = subjects(spark, {3: 10, 1: 400, 7: 5, 2: 21, 9: 30, 8: 12})
    holes = rows.where("not (subject_id = 1 and row_idx % 10 = 3)")   # as rejected rows leave them
    res = pipeline.compute(holes, d=4, n_train=4)
    paths = pipeline.write(res, str(tmp_path), u_key=True)
    files = sorted(f for f in os.listdir(paths["U"]) if f.startswith("part-"))
    lines = [line.split(",") for f in files for line in open(os.path.join(paths["U"], f)).read().splitlines()]
    keys = [(int(a), int(b)) for a, b, *_ in lines]
    assert keys == sorted(keys) and keys == [(s, i) for s in (1, 2, 3, 7) for i in range(len(mats[s])) if not (s == 1 and i % 10 == 3)]
    assert max(sum(1 for _ in open(os.path.join(paths["U"], f))) for f in files) <= 64 + 64 and len(files) >= 6     # the hot subject too
    x = np.vstack([np_zscore(np.array([mats[s][i] for i in range(len(mats[s])) if not (s == 1 and i % 10 == 3)])) for s in (1, 2, 3, 7)])
    u = np.array([[float(v) for v in line[2:]] for line in lines])
    assert np.allclose(u @ res.factors.g, x, atol=1e-9)
    back = sinks.read_rows(spark, paths["U"], 4, {"subject_id": "long", "row_idx": "int"})
    assert sorted((r["subject_id"], r["row_idx"], tuple(r["u"])) for r in back.collect()) == [(*k, tuple(v)) for k, v in zip(keys, u.tolist())]
    plan = pipeline.in_row_order(res.z_train, res.n_train_rows, 4)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    bare = pipeline.write(res, str(tmp_path / "bare"))
    first = sorted(f for f in os.listdir(bare["U"]) if f.startswith("part-"))[0]
    assert len(open(os.path.join(bare["U"], first)).readline().split(",")) == 4


def test_rows_without_an_index_are_dealt_too(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "PART_BYTES", 25 * 4 * 20)
    rows, mats = subjects(spark, {1: 90, 2: 30, 3: 8})
    res = pipeline.compute(rows.drop("row_idx"), d=4, n_train=2)
    paths = pipeline.write(res, str(tmp_path), u_key=True)
    files = sorted(f for f in os.listdir(paths["U"]) if f.startswith("part-"))
    ids = [int(line.split(",")[0]) for f in files for line in open(os.path.join(paths["U"], f))]
    assert ids == [1] * 90 + [2] * 30 and len(files) >= 4


@pytest.mark.parametrize("keep", ["parquet", "buckets"])
def test_kept_input_gives_the_same_results(spark, main_dir, tmp_path, keep):
    d, _ = main_dir
    plain = pipeline.run(spark, d, str(tmp_path / "plain"))
    res = pipeline.run(spark, d, str(tmp_path / "kept"), keep=keep)
    for name in plain.arrays:
        assert np.allclose(res.arrays[name], plain.arrays[name], atol=1e-12), name


def test_buckets_are_joined_without_moving_rows(spark):
    rows, _ = subjects(spark, {i: 10 for i in range(12)})
    own = kept(rows, "subject_id", sort=("subject_id", "row_idx"))
    assert own.count() == rows.count() and not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]
    z = apply_zscore(own, zscore_params(moments(own, "subject_id", d=4), "subject_id").hint("merge"), "subject_id", d=4, broadcast=False)
    plan = z._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("SortMergeJoin"):]
    rows_side = below[:below.index("z_mean")] if "z_mean" in below else below
    assert "SortMergeJoin" in plan and "Exchange" not in rows_side.split(":- ")[1].split("+- ")[0]
    assert z.count() == rows.count()


def test_300_regions(spark, tmp_path):
    """T5's width through the whole pipeline, k = 8."""
    rows, mats = subjects(spark, {i: 40 + i for i in range(4)}, d=300)
    res = pipeline.compute(rows, d=300, k=8, factor="random")
    train, test = (np.vstack([np_zscore(mats[i]) for i in own]) for own in ((0, 1), (2, 3)))
    assert np.allclose(res.arrays["Ctrain"], np.cov(train.T), atol=1e-9) and np.allclose(res.arrays["Ctest"], np.cov(test.T), atol=1e-9)
    _, s, vt = np.linalg.svd(train, full_matrices=False)
    assert np.allclose(res.factors.s, s[:8], rtol=1e-6)
    p = vt[:8].T @ vt[:8]
    assert res.distances["CUG_Ctest"] == pytest.approx(np.linalg.norm(p @ np.cov(train.T) @ p - np.cov(test.T)), rel=1e-6)
    r = np.corrcoef(mats[0], rowvar=False)
    got = {(x["i"], x["j"]): x["c_ij"] / np.sqrt(x["c_ii"] * x["c_jj"]) for x in res.moments.where("subject_id = 0 and i < j").collect()}
    assert len(got) == 300 * 299 // 2 and max(abs(v - r[k]) for k, v in got.items()) < 1e-9
