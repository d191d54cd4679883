"""Jump consistent hashing of stable keys to shards, in Spark columns only.

The key draws a fixed sequence of jumps: from shard b the next one is at
floor((b + 1) / u), u uniform from a hash of key and step.  The last jump
below the number of shards is the key's shard, so one more shard takes over
exactly the keys whose next jump is that shard, and no ring table is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortmx.llm.common import written

SHARDS = 16
FIRST_STEPS = 32     # a key takes about ln(shards) jumps; beyond these the rest of the steps follow


def _jumps(key: F.Column, shards: int, begin: F.Column, first: int, last: int) -> F.Column:
    def step(state: F.Column, i: F.Column) -> F.Column:
        draw = F.shiftrightunsigned(F.xxhash64(key, i), 33) + 1                       # 1 to 2**31
        there = F.floor((state["j"] + 1) * (F.lit(float(1 << 31)) / draw.cast("double")))
        return F.when(state["j"] < shards, F.struct(state["j"].alias("b"), there.cast("long").alias("j"))).otherwise(state)

    return F.aggregate(F.sequence(F.lit(first), F.lit(last)), begin, step)


def jump(key: F.Column, shards: int) -> F.Column:
    """struct<b, j>: the key's shard among 0..shards-1, and the next jump,
    ``shards`` or more: the number from which the key will move there."""
    begin = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    some = _jumps(key, shards, begin, 1, min(shards, FIRST_STEPS))
    if shards <= FIRST_STEPS:       # every jump goes up by one at least
        return some
    return F.when(some["j"] >= shards, some).otherwise(_jumps(key, shards, some, FIRST_STEPS + 1, shards))


def with_shard(df: DataFrame, key: str, shards: int = SHARDS) -> DataFrame:
    """``df`` with shard and grown_shard (with one shard more) by ``key``, any
    type that hashes; equal keys and null keys go together.  Columns of these
    names are replaced."""
    at = df.drop("shard", "grown_shard").withColumn("_jump", jump(F.col(key), shards))
    return (at.withColumn("shard", F.col("_jump.b").cast("int"))
            .withColumn("grown_shard", F.when(F.col("_jump.j") == shards, shards).otherwise(F.col("_jump.b")).cast("int")).drop("_jump"))


def write_shards(df: DataFrame, key: str, path: str, shards: int = SHARDS) -> None:
    """The rows of ``df`` as Parquet under path/shard=0, path/shard=1, ...: each
    task writes the shards it holds, so a shard may be as large as it likes."""
    with_shard(df, key, shards).drop("grown_shard").write.partitionBy("shard").parquet(path)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    A null text has size 1 and the crc32 of the empty string; null ids share a
    shard; repeated rows are placed each.  Slots count a shard's rows by part
    (a hash of the row) and within it by doc_id, crc32 and size: a shard is
    numbered in as many parts as there are shuffle partitions.  No rows: no
    rows.  Other columns are ignored.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = written(with_shard(rows, "doc_id", shards).withColumn("_part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts))))
    order = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return (placed.withColumn("_row", F.row_number().over(order) - 1).join(first, ["shard", "_part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_first") + F.col("_row")).cast("long").alias("slot"), "grown_shard"))
