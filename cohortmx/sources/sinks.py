"""K1-K5: named CSV outputs.

A d x d matrix becomes one headerless CSV file of d lines (pivot at the
sink only); the tall factor U becomes a directory of part files written in
``(subject_id, row_idx)`` order; scalars a one-line file.  Numbers are
written with ``%.18e`` (numpy's ``savetxt`` default) unless ``fmt`` says
otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.matrix import dense_rows

# fixed values: the output names of the task, in its order
OUTPUT_NAMES = ["Fn", "Fv", "Ftrain", "Ftest", "U", "G", "CUG", "Ctrain", "Ctest", "CUGCtest", "CtrainCtest"]


def _fmt(c, fmt: str | None):
    return F.format_string(fmt, c) if fmt else c.cast("string")


def write_matrix(m: DataFrame, path: str, d: int, fmt: str | None = "%.18e") -> None:
    """K1: long ``(i, j, value)`` -> dense CSV, one file, row ``i`` per line."""
    dense = dense_rows(m, d)
    cols = [_fmt(F.col(f"c{j}"), fmt).alias(f"c{j}") for j in range(d)]
    (dense.select(*cols).coalesce(1).write.mode("overwrite")
     .option("header", "false").csv(path))


def write_rows(df: DataFrame, path: str, order_by: Sequence[str], array_col: str, width: int,
               fmt: str | None = "%.18e", presorted: bool = False, keys: Sequence[str] = ()) -> None:
    """K2: tall results in key order, one CSV line per row, no header.

    The sort is a range-partitioned distributed sort; part files are
    numbered in key order.  ``presorted``: ``df`` is already globally sorted
    by a narrow plan above a sort (order-preserving maps only).  ``keys``:
    columns that begin each line.
    """
    cols = [*[F.col(k).cast("string") for k in keys], *[_fmt(F.col(array_col)[k], fmt).alias(f"c{k}") for k in range(width)]]
    src = df if presorted else df.orderBy(*order_by)
    src.select(*cols).write.mode("overwrite").option("header", "false").csv(path)


def read_rows(spark, path: str, width: int, keys: dict[str, str]) -> DataFrame:
    """Rows of :func:`write_rows` with ``keys`` (name: type), read back:
    the keys and ``u``, an array."""
    fields = [f"{k} {t}" for k, t in keys.items()] + [f"c{j} double" for j in range(width)]
    raw = spark.read.option("header", "false").option("mode", "FAILFAST").schema(", ".join(fields)).csv(path)
    return raw.select(*keys, F.array(*[F.col(f"c{j}") for j in range(width)]).alias("u"))


def write_scalar(value: DataFrame, path: str, fmt: str | None = "%.18e") -> None:
    """K4: a one-row ``value`` DataFrame as a one-line file."""
    value.select(_fmt(F.col("value"), fmt).alias("value")).coalesce(1).write.mode("overwrite") \
        .option("header", "false").csv(path)


def read_matrix(spark, path: str, d: int) -> DataFrame:
    """Read a :func:`write_matrix` output back as ``(i, j, value)``.

    The file has d lines in ``i`` order, recovered from the read order of
    the single file.
    """
    raw = spark.read.option("header", "false").schema(
        ", ".join(f"c{j} string" for j in range(d))).csv(path).coalesce(1)
    # d lines of one small file: a single-partition window is bounded by d
    raw = raw.withColumn("i", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) - 1)
    return raw.select(F.col("i").cast("int"), F.posexplode(F.array(*[F.col(f"c{j}").cast("double") for j in range(d)]))
                      .alias("j", "value")).select("i", F.col("j").cast("int"), "value")


def write_matrix_dir(meas: DataFrame, path: str, width: int, id_digits: int = 6,
                     one_file_per_subject: bool = False) -> None:
    """The inverse of ``read_matrix_dir``: rows as space-separated text under
    ``path/sub=NNNNNN/``, line order = ``row_idx`` within each file.

    Ids are padded to ``id_digits``, longer ones written whole.  By default rows
    are range-partitioned by subject, then ``row_idx`` (without one: the row's
    hash), so there are at most subjects + partitions files however scattered
    the rows lie: a subject that several partitions share gets several files in
    its folder, each numbered from 0.  ``one_file_per_subject`` reproduces the
    one-file layout with a hash shuffle by subject (each subject's rows then go
    through one task, as that format requires).  Doubles are written in
    Spark's shortest round-trip form.
    """
    if one_file_per_subject:
        meas = meas.repartition(F.col("subject_id"))
    else:
        # a file costs more than its rows: as many tasks as there may be, not few by their bytes
        n = int(meas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        meas = meas.repartitionByRange(n, F.col("subject_id"), F.col("row_idx") if "row_idx" in meas.columns else F.xxhash64("x"))
    line = F.concat_ws(" ", *[F.col("x")[k].cast("string") for k in range(width)])
    order = ["sub", "row_idx"] if "row_idx" in meas.columns else ["sub"]
    out = meas.select(F.lpad(F.col("subject_id").cast("string"),
                             F.greatest(F.length(F.col("subject_id").cast("string")), F.lit(id_digits)), F.lit("0")).alias("sub"),
                      *([F.col("row_idx")] if "row_idx" in meas.columns else []), line.alias("value"))
    (out.sortWithinPartitions(*order).select("sub", "value").write.mode("overwrite")
     .partitionBy("sub").text(path))


def _fs_rename(spark, src: str, dst: str) -> None:
    """Move a folder on the cluster file system (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(conf)
    if fs.exists(d):
        fs.delete(d, True)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"could not move {src} to {dst}")


def _write_named_lines(spark, lines: DataFrame, names, out_dir: str, suffix: str,
                       single_files: bool) -> dict[str, str]:
    """``(name, i, value)`` lines -> one file (or folder) per name, in one job.

    The lines of all small results are bounded by d^2, so they go through one
    task in ``(name, i)`` order; ``partitionBy(name)`` gives one part file
    per result, which is then moved to its name (metadata only).
    """
    base = out_dir.rstrip("/")
    tmp = f"{base}/_staging{suffix}"
    (lines.repartition(1).sortWithinPartitions("name", "i").select("name", "value")
     .write.mode("overwrite").partitionBy("name").text(tmp))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(tmp).getFileSystem(conf)
    paths = {}
    for name in names:
        if single_files:
            src = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{tmp}/name={name}/part-*"))
            if len(src) != 1:
                raise OSError(f"expected one part file for {name}, found {len(src)}")
            paths[name] = f"{base}/{name}{suffix}.csv"
            _fs_rename(spark, src[0].getPath().toString(), paths[name])
        else:
            paths[name] = f"{base}/{name}{suffix}"
            _fs_rename(spark, f"{tmp}/name={name}", paths[name])
    fs.delete(jvm.org.apache.hadoop.fs.Path(tmp), True)
    return paths


def write_small(named: dict, out_dir: str, suffix: str = "", fmt: str | None = "%.18e",
                single_files: bool = True) -> dict[str, str]:
    """K1/K4/K5 in one job: every small result (``name -> (long table, ncols)``)
    as a headerless CSV: ``out_dir/<name><suffix>.csv`` (``single_files``,
    the task's file names) or a folder ``out_dir/<name><suffix>``."""
    spark = next(iter(named.values()))[0].sparkSession
    parts = []
    for name, (m, ncols) in named.items():
        dense = dense_rows(m, ncols)
        line = F.concat_ws(",", *[_fmt(F.col(f"c{j}"), fmt) for j in range(ncols)])
        parts.append(dense.select(F.lit(name).alias("name"), "i", line.alias("value")))
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p)
    return _write_named_lines(spark, allrows, list(named), out_dir, suffix, single_files)


def write_arrays(spark, arrays: dict, out_dir: str, suffix: str = "", fmt: str | None = "%.18e",
                 single_files: bool = True) -> dict[str, str]:
    """As :func:`write_small` for results already on the driver as small
    numpy arrays (d x d matrices, scalars): the lines are formatted there
    (``fmt % v``, which writes ``nan``/``inf`` as numpy's ``savetxt`` does)
    and written by one job, with no pivot."""
    rows = []
    for name, a in arrays.items():
        for i, row in enumerate(np.atleast_2d(np.asarray(a, dtype=float))):
            rows.append((name, i, ",".join((fmt % v) if fmt else repr(float(v)) for v in row)))
    lines = spark.createDataFrame(rows, "name string, i int, value string")
    return _write_named_lines(spark, lines, list(arrays), out_dir, suffix, single_files)


def write_subject_files(meas: DataFrame, path: str, width: int, id_digits: int = 6) -> int:
    """The flat input layout itself: one ``path/subNNNNNN.txt`` per subject.

    Written with :func:`write_matrix_dir` (one file per subject) into a
    staging folder, then each part file is renamed (metadata only).
    Returns the number of files.  Used to build test and bench inputs.
    """
    spark = meas.sparkSession
    staging = path.rstrip("/") + "/_staging"
    write_matrix_dir(meas, staging, width, id_digits, one_file_per_subject=True)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(staging)
    fs = root.getFileSystem(conf)
    n = 0
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(staging + "/sub=*/part-*")):
        sub = st.getPath().getParent().getName().split("=", 1)[1]
        target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/sub{sub}.txt")
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(st.getPath(), target):
            raise OSError(f"could not move {st.getPath()} to {target}")
        n += 1
    fs.delete(root, True)
    return n
