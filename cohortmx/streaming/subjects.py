"""T1 one file at a time: a streaming file source of ``subNNNNNN.txt``.

Each new file is one complete subject (``wholetext``), so the moments of a
micro-batch are final for its subjects and need no streaming state.  Every
micro-batch is mapped to ``(subject_id, i, j, r, f, n)`` rows (upper
triangle) and written under ``<table>/epoch=<id>`` with overwrite, so a
retried epoch replaces its own output (exactly once).  Fn/Fv and the
train/test means are ordinary batch aggregates over that table at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.correlate import corr_from_moments, fisher_z
from ..operators.moments import moments
from ..operators.summarise import (attach_split, entry_stats, split_by_rank, split_by_threshold,
                                   subject_dim)
from ..sources.text import parse_lines, split_lines, whole_files


def _rejects_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}-rejects"


def fisher_stream(spark: SparkSession, input_dir: str, table_path: str, checkpoint_path: str, width: int,
                  glob: str = "sub*.txt", available_now: bool = True, method: str = "auto",
                  strict: bool = True) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    A row that does not parse, or a file without an id, ends the stream
    (``strict``) and its micro-batch writes nothing; with ``strict=False`` it
    is left out and written, with a reason, under ``<table>-rejects/epoch=<id>``
    (:func:`stream_rejects`).
    """
    src = (spark.readStream.format("text").option("wholetext", "true")
           .option("pathGlobFilter", glob).load(input_dir))
    lines = split_lines(whole_files(src))

    def batch(df: DataFrame, epoch_id: int) -> None:
        src = parse_lines(df, width=width, strict=strict)
        if not strict:
            src.rejects.write.mode("overwrite").parquet(f"{_rejects_path(table_path)}/epoch={epoch_id}")
        m = moments(src.rows, "subject_id", d=width, method=method)
        fz = fisher_z(corr_from_moments(m, "subject_id", keep_n=True, full=False))
        fz.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/epoch={epoch_id}")

    w = lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def fisher_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The per-subject upper-triangle F rows written so far.  A subject that
    came in several batches (a file replaced, or sent again) counts once, by
    the newest one."""
    rows = spark.read.parquet(table_path)
    newest = rows.groupBy("subject_id").agg(F.max("epoch").alias("epoch"))
    return rows.join(newest, ["subject_id", "epoch"], "left_semi").drop("epoch")


def stream_rejects(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows left out so far by a stream with ``strict=False``:
    subject_id, file_name, row_idx, line, reason."""
    return spark.read.parquet(_rejects_path(table_path)).drop("epoch")


def running_stats(spark: SparkSession, table_path: str, ddof: int = 0) -> DataFrame:
    """Fn / Fv over all subjects received so far (full d x d grid)."""
    return entry_stats(fisher_table(spark, table_path), ddof=ddof, upper=True)


def running_split_stats(spark: SparkSession, table_path: str, n_train: int | None = None,
                        cut=None, ddof: int = 0) -> DataFrame:
    """Ftrain / Ftest over the subjects received so far: the rank split
    (first ``n_train`` ids, default half) or, with ``cut``, the id threshold."""
    f = fisher_table(spark, table_path)
    subjects = subject_dim(f)
    splits = split_by_threshold(subjects, cut) if cut is not None else split_by_rank(subjects, n_train=n_train)
    return entry_stats(attach_split(f, splits), by="split", ddof=ddof, upper=True)
