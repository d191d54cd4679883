"""Entrywise statistics over subjects, and the ordered train/test split.

The subject dimension (one row per subject) is the only table ranked; the
rank is computed without a single-partition window: subjects are
range-partitioned by id, each partition is sorted and numbered locally, and
partition offsets (one row per partition) are added back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .moments import _keys, mirror


SPLIT_ROWS = 1_000_000   # of the split table: about 40 MB


def entry_stats(table: DataFrame, by=(), value: str = "f", ddof: int = 0, skip_undefined: bool = False,
                upper: bool = False) -> DataFrame:
    """A2-A5: ``by..., i, j, mean, var, n`` of ``value`` over all subjects.

    ``ddof=0`` is the population variance (numpy's default), ``ddof=1`` the
    sample variance (R's ``var``).  ``upper=True``: the input holds only
    i <= j (symmetric matrices); the d x d result is mirrored after the
    aggregation, so each subject contributes d(d+1)/2 rows, not d^2.
    """
    by = _keys(by) if by else []
    v = F.col(value)
    if skip_undefined:
        table = table.where(~F.isnan(v))
    var = F.var_pop(v) if ddof == 0 else F.var_samp(v)
    out = table.groupBy(*by, "i", "j").agg(
        F.avg(v).alias("mean"), var.alias("var"), F.count(F.lit(1)).alias("n"))
    return mirror(out, by, ["mean", "var", "n"]) if upper else out


def subject_dim(table: DataFrame, key: str = "subject_id") -> DataFrame:
    """Distinct subjects of any keyed table."""
    return table.select(key).distinct()


def rank_subjects(subjects: DataFrame, key: str = "subject_id", partitions: int | None = None) -> DataFrame:
    """``key, rank, n_subjects`` with rank 1..N in ascending key order.

    ``subjects`` must hold each key once.  Range partitioning spreads the
    subjects over ``partitions`` tasks; the only single-task step is the
    running sum over one count per partition.
    """
    spark = subjects.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _dealt(subjects, key, p)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid")
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("n_subjects"))
    # one row per partition: bounded by the partition count, safe to broadcast
    return (ordered.join(F.broadcast(offsets), "_pid")
            .select(key, (F.col("_off") + F.col("_pos") + 1).alias("rank"), "n_subjects"))


def _dealt(subjects: DataFrame, key: str, partitions: int) -> DataFrame:
    """``subjects`` in ranges of ``key``, with the range (_pid) and the place in it (_pos)."""
    ordered = (subjects.repartitionByRange(partitions, key).sortWithinPartitions(key)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)))
    # numbered once: a second range exchange could sample other bounds
    return materialize(ordered)


def row_offsets(sizes: DataFrame, key: str = "subject_id", n: str = "n", partitions: int | None = None) -> DataFrame:
    """O1: ``sizes`` (a row per subject, ``n`` rows each) with ``offset``: how many
    rows the subjects before it in key order have.  Only one sum per range of
    subjects goes through a single task."""
    p = partitions or int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = _dealt(sizes, key, p)
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = (ordered.groupBy("_pid").agg(F.sum(n).alias("_sum"))
              .select("_pid", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_off")))
    own = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return (ordered.withColumn("_own", F.coalesce(F.sum(n).over(own), F.lit(0))).join(F.broadcast(before), "_pid")
            .withColumn("offset", F.col("_off") + F.col("_own")).drop("_pid", "_pos", "_off", "_own"))


def split_by_rank(subjects: DataFrame, key: str = "subject_id", n_train: int | None = None) -> DataFrame:
    """the first ``n_train`` subjects by id are 'train', the rest 'test'.

    Default ``n_train`` is half the subjects, rounded down.
    """
    ranked = rank_subjects(subjects, key)
    cut = F.lit(n_train) if n_train is not None else F.floor(F.col("n_subjects") / 2)
    return ranked.select(key, "rank",
                         F.when(F.col("rank") <= cut, F.lit("train")).otherwise(F.lit("test")).alias("split"))


def split_by_threshold(subjects: DataFrame, cut, key: str = "subject_id") -> DataFrame:
    """``key <= cut`` is 'train', the rest 'test'."""
    return subjects.select(key, F.when(F.col(key) <= F.lit(cut), F.lit("train"))
                           .otherwise(F.lit("test")).alias("split"))


def attach_split(table: DataFrame, splits: DataFrame, key: str = "subject_id") -> DataFrame:
    """Label every row of ``table`` with its subject's split.

    Inner equi-join on the subject id: the split table (one row per subject)
    is broadcast up to SPLIT_ROWS counted rows, beyond that both sides are
    shuffled; the subjects x d^2 side is never broadcast.
    """
    own = splits.select(key, "split")
    small = own.limit(SPLIT_ROWS + 1).count() <= SPLIT_ROWS
    return table.join(F.broadcast(own) if small else own.hint("merge"), key)
