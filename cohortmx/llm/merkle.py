"""Merkle manifest of a dataset, climbed by a recursive query.

Rows become leaves, leaves of a source become a tree of fan-out 16, and the
roots of the sources become one more tree, whose root stands for the dataset.

``build`` numbers the leaves (ranges of source and id, so that a source with
most of all rows is numbered by many tasks) and writes one table a level: a
node is a run of at most 16 digests, its own digest, and a link to the node
above.  ``climb`` is one ``WITH RECURSIVE`` query that starts at the leaves
and ascends by that link until it finds none.  At each node every leaf folds
its own (perhaps tampered) hash into the run, and the run's other digests are
appended to its siblings.  The leaves of a run share all that lies above it, so
a row of the recursion holds the up to 16 leaves of a run side by side (ids,
and their hashes in a row) and the siblings above once: that is 70 bytes a leaf
and 30 more a level, where a row for each leaf would take half a kilobyte a level.

Digests are kept as 32 bytes and hashed as lower-case hex text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortmx.llm.common import written

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
BROADCAST_NODES = 100_000     # of at most 600 bytes: 60 MB; more are joined by a shuffle
TOP = -1             # number of the tree over the sources' roots
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def framed(value: F.Column) -> F.Column:
    """``-`` for a null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(**columns: F.Column) -> F.Column:
    """Digest (binary) of a row by the framed FIELDS; ``columns`` replace fields."""
    return F.unhex(F.sha2(F.concat(*[framed(columns.get(f, F.col(f))) for f in FIELDS]).cast("binary"), 256))


def tampered_id(doc_id: F.Column) -> F.Column:
    """Ids whose rows the manifest is tested with; null ids aren't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))


def digest_of(run: F.Column) -> F.Column:
    """Digest (binary) of digests in a row, hashed as lower-case hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(run)).cast("binary"), 256))


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, tampered (the hash of the row with A-Z lower-cased, null where it isn't tampered with), _row."""
    changed = leaf_hash(text=F.translate(F.col("text"), UPPER, LOWER))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf_hash().alias("leaf"),
                       F.when(tampered_id(F.col("doc_id")), changed).alias("tampered"), F.monotonically_increasing_id().alias("_row"))


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with at (its place in its group by ``order``, from 0), n (rows of
    the group) and tree (the group's number by value, null first).

    Rows are dealt by ranges of group and order, so a large group is numbered in
    as many parts as its size takes; only counts of (group, part) are windowed.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(parts, group, *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    mine = Window.partitionBy(group)
    before = mine.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = written(counts.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"), F.sum("_n").over(mine).alias("n")))
    # groups by number: one row a group, dealt by range again, numbered by the counts of the parts
    heads = written(first.where("_first = 0").select(group).repartitionByRange(parts, group).withColumn("_range", F.spark_partition_id()))
    sizes = heads.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))              # a row a range
    offset = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    trees = (heads.join(F.broadcast(offset), "_range")
             .select(F.col(group).alias("_group"), (F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(group)) - 1).alias("tree")))
    first = first.join(trees, first[group].eqNullSafe(trees["_group"])).select(F.col(group).alias("_group"), F.col("_part").alias("_at"), "_first", "n", "tree")
    own = dealt.withColumn("_i", F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)) - 1)
    return (own.join(first, own[group].eqNullSafe(first["_group"]) & (own["_part"] == first["_at"]))
            .withColumn("at", F.col("_first") + F.col("_i")).drop("_group", "_part", "_at", "_first", "_i"))


def _runs(nodes: DataFrame, level: int, leaves: bool = False) -> DataFrame:
    """Nodes (tree, at, n, digest) in runs of 16: tree, level, run, digests, digest, n (of the level above)."""
    entry = F.struct("at", "digest", *(["doc_id", "tampered"] if leaves else []))
    runs = nodes.groupBy("tree", F.shiftright("at", 4).alias("run")).agg(F.sort_array(F.collect_list(entry)).alias("_e"), F.max("n").alias("_n"))
    digests = F.aggregate(F.transform("_e", lambda e: e["digest"]), F.lit("").cast("binary"), lambda a, d: F.concat(a, d))
    runs = runs.withColumn("digests", digests)
    # a lone leaf is its tree's root as it is
    return runs.select("tree", F.lit(level).alias("level"), "run", "digests", F.when(F.col("_n") == 1, F.col("digests")).otherwise(digest_of(F.col("digests"))).alias("digest"),
                       F.floor((F.col("_n") + (FAN_OUT - 1)) / FAN_OUT).cast("long").alias("n"),
                       *([F.col("_e.doc_id").alias("ids"), F.col("_e.tampered").alias("tampered")] if leaves else []))


def _levels(runs: DataFrame) -> list[DataFrame]:
    """The written levels above ``runs``: a pass over each while a tree has more than one node."""
    levels = []
    while (most := runs.agg(F.max("n")).collect()[0][0]) and most > 1:
        nodes = runs.where("n > 1").select("tree", F.col("run").alias("at"), "n", "digest")
        levels.append(runs := written(_runs(nodes, len(levels) + 1)))
    return levels


def _linked(runs: DataFrame, several: bool) -> DataFrame:
    """``runs`` with the node above: of the same tree, or of the tree over the sources, or none."""
    inside = F.col("n") > 1
    over = (F.col("tree") != TOP) & F.lit(several)
    to = lambda own, top: F.when(inside, own).when(over, top)
    return runs.select(*[c for c in runs.columns if c != "n"], (~inside).alias("is_root"),
                       to(F.col("tree"), F.lit(TOP)).cast("long").alias("up_tree"), to(F.col("level") + 1, F.lit(0)).cast("int").alias("up_level"),
                       to(F.shiftright("run", 4), F.shiftright("tree", 4)).alias("up_run"),
                       to(F.col("run"), F.col("tree")).bitwiseAND(15).cast("int").alias("up_pos"))


def build(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs of leaves, nodes above them), both written and linked by up_tree, up_level, up_run."""
    leaves = numbered(written(leaves_of(docs)), "source", ["doc_id", "leaf", "_row"]).withColumnRenamed("leaf", "digest")
    bottom = written(_runs(leaves, 0, leaves=True))
    levels = _levels(bottom)
    roots = reduce(DataFrame.unionByName, [r.where("n = 1").select("tree", "digest") for r in (bottom, *levels)])
    n = roots.count()
    if n > 1:
        top = written(_runs(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(n).cast("long").alias("n"), "digest"), 0))
        levels += [top, *_levels(top)]
    else:
        levels.append(bottom.drop("ids", "tampered").where("false"))
    return _linked(bottom, n > 1), reduce(DataFrame.unionByName, [_linked(r, n > 1) for r in levels])


# every leaf of a run (number i, its hash {mine}) folded into the run's digests at {at}
_FOLD = ("unhex(array_join(transform(sequence(0, size(ids) - 1), i -> sha2(lower(hex(concat("
         "substring({run}, 1, 32 * {at}), {mine}, substring({run}, 32 * {at} + 33)))), 256)), ''))")

CLIMB = f"""
WITH RECURSIVE climb (ids, folded, own, above, subroot, digest, up_tree, up_level, up_run, up_pos) AS (
  SELECT ids, CASE WHEN digest = digests THEN coalesce(tampered[0], digests)
                   ELSE {_FOLD.format(run="digests", at="i", mine="coalesce(tampered[i], substring(digests, 32 * i + 1, 32))")} END,
         digests, CAST('' AS BINARY), CASE WHEN is_root THEN digest END, digest, up_tree, up_level, up_run, up_pos
  FROM {{bottom}}
  UNION ALL
  SELECT c.ids, {_FOLD.format(run="n.digests", at="c.up_pos", mine="substring(c.folded, 32 * i + 1, 32)")},
         c.own, concat(c.above, substring(n.digests, 1, 32 * c.up_pos), substring(n.digests, 32 * c.up_pos + 33)),
         coalesce(c.subroot, CASE WHEN n.is_root THEN n.digest END), n.digest, n.up_tree, n.up_level, n.up_run, n.up_pos
  FROM climb c JOIN {{nodes}} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_run = n.run)
SELECT subroot, digest AS root, own, above, folded, posexplode(ids) AS (i, doc_id) FROM climb WHERE up_tree IS NULL
"""


def climb(bottom: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, siblings, folded_root (all digests binary)
    of every leaf.  Lifts the session's row limit of recursive queries, which
    counts the rows of all iterations (results don't depend on it)."""
    spark = bottom.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    small = nodes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    ends = spark.sql(CLIMB, bottom=bottom, nodes=F.broadcast(nodes) if small else nodes)
    at = F.col("i") * 32
    return ends.select("doc_id", F.substring(F.col("own"), at + 1, F.lit(32)).alias("leaf"), "subroot", "root",
                       F.concat(F.substring(F.col("own"), F.lit(1), at), F.substring(F.col("own"), at + 33, F.lit(1 << 20)), F.col("above")).alias("siblings"),
                       F.substring(F.col("folded"), at + 1, F.lit(32)).alias("folded_root"))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    Nulls are leaves' fields like any other (``-``): null sources make a tree
    of their own, the first one; null ids come first in it and are never
    tampered with.  Rows with equal ids are ordered by leaf, equal rows have
    leaves of their own.  Texts are hashed whole.  No rows: no rows.  Other
    columns are ignored.
    """
    ends = climb(*build(docs))
    as_hex = lambda c: F.lower(F.hex(c)).alias(c)
    return ends.select("doc_id", as_hex("leaf"), as_hex("subroot"), as_hex("root"),
                       F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
                       as_hex("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))
