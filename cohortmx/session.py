"""Session helpers.

The library never chooses the master or the cluster size: callers (a cluster
submit, the tests, ``bench.py``) do.  ``builder`` only adds the settings the
operators rely on; ``checkpoint_dir`` reads the shared folder the cluster
names in ``spark.checkpoint.dir`` and only invents one when it is unset
(local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.  AQE re-plans joins and shuffle
# partition counts at run time; skew-join splits hot subjects in the one
# row-level join (z-scoring rows for U).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # checkpointed tables are small but many; drop them once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def builder(app_name: str = "cohortmx", master: str | None = None, shuffle_partitions: int | None = None,
            extra: dict | None = None) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a fresh local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    else:
        # Only reached in local runs without cluster configuration (tests).
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortmx-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and survives executor loss.

    Used only on small derived tables (per-subject moments, the subject
    dimension) that several later steps read.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bucketed(df: DataFrame, key: str, n: int | None = None, sort: tuple[str, ...] = (), dealt: bool = False) -> DataFrame:
    """``df`` written into the shared scratch folder in ``n`` buckets of ``key``
    (by default as many as shuffle partitions), each sorted by ``sort``:
    later joins and groups by ``key`` read it without a shuffle.

    All rows of a key are in one bucket, which one task reads, so ``key`` must
    have no value with a large share of the rows.  ``dealt``: the rows lie by
    ``key`` already.  The table's name goes as soon as it is resolved: what is
    returned knows its files and buckets.
    """
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"buckets_{uuid.uuid4().hex}"
    writer = (df if dealt else df.repartition(n, key)).write.bucketBy(n, key)
    if sort:
        writer = writer.sortBy(*sort)
    writer.option("path", scratch_path(spark, name)).saveAsTable(name)
    out = spark.table(name)
    out.schema          # resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return out


def kept(df: DataFrame, key: str | None = None, sort: tuple[str, ...] = ()) -> DataFrame:
    """K6: rows that later steps read again, written once: as Parquet as they
    lie, or with ``key`` in buckets (see :func:`bucketed`)."""
    if key is not None:
        return bucketed(df, key, sort=sort)
    path = scratch_path(df.sparkSession, f"kept-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_RUN = uuid.uuid4().hex     # of this driver's scratch folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables, under the checkpoint dir."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", _RUN, name)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables that this driver has written.  Only once
    no DataFrame made from them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint_dir(spark), "tables", _RUN))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
