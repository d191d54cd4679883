"""A directory of ``subNNNNNN.txt`` matrices as ``measurement``.

Each file holds one subject: one observation per line, the regions as
whitespace-separated numbers, no header.  The scan itself distributes the
files: small ones whole (``wholetext``, line order gives ``row_idx``), large
ones in splits whose lines are numbered by counting them first.  Every
parsing step is a built-in column expression.

Rows that do not parse to exactly ``width`` numbers are not silently
dropped: :func:`read_matrix_dir` returns them, with a reason, next to the
good rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

WHOLE_BYTES = 64 << 20     # a larger file is read in splits
SPLITS = 200_000           # of the table of splits: about 40 MB, broadcast; a larger one is joined by a shuffle


@dataclass
class MatrixDir:
    rows: DataFrame      # subject_id LONG, row_idx INT, x ARRAY<DOUBLE>
    rejects: DataFrame   # subject_id, file_name, row_idx, line, reason
    width: int


def whole_files(df: DataFrame) -> DataFrame:
    """``value`` (a whole file) of a text scan, batch or streaming, with its
    file name and path."""
    return df.select("value", F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_path").alias("file_path"))


def split_lines(raw: DataFrame) -> DataFrame:
    """One row per line with its position in the file."""
    # drop trailing whitespace (a final newline would give a phantom empty
    # row), then split on LF or CRLF
    content = F.regexp_replace("value", r"\s+$", "")
    return raw.select("file_name", "file_path",
                      F.posexplode(F.split(content, r"\r?\n")).alias("row_idx", "line"))


def _reader(spark: SparkSession, glob: str, recursive: bool):
    reader = spark.read.option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", "true") if recursive else reader


def split_file_lines(spark: SparkSession, path: str, glob: str = "sub*.txt", recursive: bool = False) -> DataFrame:
    """P1/P2 for files of any size: ``file_name, file_path, row_idx, line`` as
    :func:`split_lines` gives them, but a file is read by as many tasks as it
    has splits.

    A first pass counts the lines of each split (and finds the last one that
    isn't blank: blank lines at a file's end don't count); running sums of the
    counts, one row a split, number the lines of the second pass.  A file that
    changes between the passes raises.  A file of no bytes has no line.
    """
    raw = _reader(spark, glob, recursive).option("lineSep", "\n").text(path)
    # ids grow by one along a task's lines, so a split's first one makes positions of them
    lines = raw.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"),
                       F.regexp_replace("value", r"\r$", "").alias("line"))
    full = F.col("line").rlike(r"\S")
    splits = lines.groupBy("file_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"), F.max(F.when(full, F.col("_id"))).alias("_last"))
    of_file = Window.partitionBy("file_path")
    before = of_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    splits = materialize(splits.withColumn("_end", F.coalesce(F.max(F.col("_offset") + F.col("_last") - F.col("_first")).over(of_file), F.lit(0)))
                         .select("file_path", "_block", "_n", "_first", "_offset", "_end"))
    small = splits.count() <= SPLITS
    placed = lines.join(F.broadcast(splits) if small else splits, ["file_path", "_block"])
    at = F.col("_id") - F.col("_first")
    same = F.when((at >= 0) & (at < F.col("_n")), F.col("_offset") + at).otherwise(F.raise_error(F.concat(F.col("file_path"), F.lit(" has changed"))).cast("long"))
    return placed.withColumn("row_idx", same.cast("int")).where(F.col("row_idx") <= F.col("_end")).select("file_name", "file_path", "row_idx", "line")


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by as many tasks as there are shuffle partitions:
    by default by one task each, up to 10,000, that take longer to start than to run."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    was = spark.conf.get(name, None)
    spark.conf.set(name, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, was)


def _lines(spark: SparkSession, path: str, glob: str, recursive: bool, by_line: bool | str = False) -> DataFrame:
    if by_line == "auto":
        largest = _reader(spark, glob, recursive).format("binaryFile").load(path).agg(F.max("length")).first()[0]
        by_line = (largest or 0) > WHOLE_BYTES
    if by_line:
        return split_file_lines(spark, path, glob, recursive)
    return split_lines(whole_files(_reader(spark, glob, recursive).text(path, wholetext=True)))


def _refuse_shared_ids(spark: SparkSession, path: str, glob: str, recursive: bool, sid) -> None:
    """Raises if two files have one subject id: their rows would mix."""
    files = (_reader(spark, glob, recursive).format("binaryFile").load(path)
             .select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name")))
    shared = (files.select(sid.alias("id"), "file_path").where("id IS NOT NULL").groupBy("id")
              .agg(F.min("file_path").alias("a"), F.max("file_path").alias("b")).where("a < b").orderBy("id").limit(3).collect())
    if shared:
        raise ValueError("files with one subject id: " + "; ".join(f"{r['id']}: {r['a']}, {r['b']}" for r in shared))


def read_matrix_dir(spark: SparkSession, path: str, glob: str = "sub*.txt", id_regex: str = r"(\d{6,})",
                    width: int | None = None, id_from: str = "file_name", recursive: bool = False,
                    id_slice: tuple[int, int] | None = None, strict: bool = False, gaps: tuple[str, ...] = (),
                    by_line: bool | str = "auto") -> MatrixDir:
    """Read every matching file below ``path``.

    ``id_regex``'s first group, matched against the file name (P5), is the
    subject id (by default the whole first run of six digits or more);
    ``id_from="path"`` matches the whole path instead.  ``id_slice=(3, 9)``
    takes the id from fixed positions of the file name instead (P6, Python
    slice convention); a name whose digits go on after the slice has no id.
    ``strict`` raises on the first row that does not parse, in the same pass,
    instead of leaving it to ``rejects``.  ``width`` (regions per row)
    defaults to the token count of the first line read.  A token of ``gaps``
    (``("NA",)``) is a missing value: NULL in ``x``, for pairwise complete
    statistics; without it such a line doesn't parse.  ``by_line`` reads files
    in splits (:func:`split_file_lines`), not whole: by default if one is larger
    than WHOLE_BYTES.  Two files whose names give one id raise.
    """
    if id_from == "file_name":
        with _listing(spark):
            _refuse_shared_ids(spark, path, glob, recursive, _subject_id(id_regex, id_from, id_slice))
    with _listing(spark):
        lines = _lines(spark, path, glob, recursive, by_line)
    return parse_lines(lines, path, glob, width, id_regex, id_from, id_slice, strict, gaps)


def _subject_id(id_regex: str, id_from: str, id_slice: tuple[int, int] | None):
    """The subject id by a file's name or path, NULL where it has none."""
    if id_slice is not None:
        start, stop = id_slice
        goes_on = F.substring(F.col("file_name"), stop + 1, 1).rlike(r"\d")
        sid = F.when(goes_on, F.lit("")).otherwise(F.substring(F.col("file_name"), start + 1, stop - start))
    else:
        sid = F.regexp_extract(F.col("file_name") if id_from == "file_name" else F.col("file_path"), id_regex, 1)
    return F.when(sid != "", sid).try_cast("long")


def parse_lines(lines: DataFrame, path: str = "", glob: str = "", width: int | None = None,
                id_regex: str = r"(\d{6,})", id_from: str = "file_name",
                id_slice: tuple[int, int] | None = None, strict: bool = False, gaps: tuple[str, ...] = ()) -> MatrixDir:
    """P3-P6 on :func:`split_lines` output; ``width`` is required for a
    streaming input (no first row to look at)."""
    # Trim, split on any run of whitespace; P4: cast the whole array
    # (generated code), a token that is not a number becomes NULL
    tokens = F.split(F.regexp_replace("line", r"^\s+|\s+$", ""), r"\s+")
    parsed = lines.select(
        _subject_id(id_regex, id_from, id_slice).alias("subject_id"),
        "file_name", F.col("row_idx").cast("int").alias("row_idx"), "line",
        tokens.try_cast(T.ArrayType(T.DoubleType())).alias("x"), tokens.alias("tokens"))
    if width is None:
        first = parsed.where(F.length(F.trim("line")) > 0).select(F.size("x")).first()
        if first is None:
            raise ValueError(f"no data lines under {path!r} matching {glob!r}")
        width = int(first[0])
    numbers = (F.forall(F.arrays_zip("x", "tokens"), lambda e: e["x"].isNotNull() | e["tokens"].isin(*gaps)) if gaps
               else F.forall("x", lambda v: v.isNotNull()))
    ok = F.col("subject_id").isNotNull() & (F.size("x") == width) & numbers & (F.length(F.trim("line")) > 0)
    reason = (F.when(F.col("subject_id").isNull(), F.lit("no subject id in name"))
              .when(F.length(F.trim("line")) == 0, F.lit("empty line"))
              .when(F.size("x") != width, F.lit("wrong number of values"))
              .otherwise(F.lit("not a number")))
    if strict:
        where = F.concat(F.col("file_name"), F.lit(", row "), F.col("row_idx"), F.lit(": "), reason)
        rows = parsed.select("subject_id", "row_idx", F.when(ok, F.col("x")).otherwise(F.raise_error(where)).alias("x"))
    else:
        rows = parsed.where(ok).select("subject_id", "row_idx", "x")
    rejects = parsed.where(~ok).select("subject_id", "file_name", "row_idx", "line", reason.alias("reason"))
    return MatrixDir(rows=rows, rejects=rejects, width=width)


def read_delimited(spark: SparkSession, path: str, width: int, sep: str = " ", glob: str = "sub*.txt",
                   id_regex: str = r"(\d{6,})") -> DataFrame:
    """S3 when row order is not needed: a splittable CSV scan (large files
    split across tasks), ``row_idx`` left NULL.  Only for statistics that
    ignore order (all but U's row identity).  Raises on a line that does not
    hold ``width`` numbers and on a file name without an id."""
    schema = T.StructType([T.StructField(f"c{k}", T.DoubleType(), True) for k in range(width)])
    df = (spark.read.option("pathGlobFilter", glob).option("sep", sep).option("ignoreLeadingWhiteSpace", "true")
          .option("ignoreTrailingWhiteSpace", "true").option("mode", "FAILFAST").schema(schema).csv(path))
    sid = F.regexp_extract(F.col("_metadata.file_name"), id_regex, 1)
    x = F.array(*[F.col(f"c{k}") for k in range(width)])
    return df.select(F.when(sid != "", sid.cast("long")).otherwise(F.raise_error(F.lit("no subject id in name"))).alias("subject_id"),
                     F.lit(None).cast("int").alias("row_idx"),
                     F.when(F.forall(x, lambda v: v.isNotNull()), x)
                     .otherwise(F.raise_error(F.lit(f"a line does not hold {width} numbers"))).alias("x"))
