"""Document fingerprints by winnowing, in Spark columns only.

A text's words (lower case, runs of letters and digits) give a hash for every
run of GRAM words; of every window of WINDOW such hashes the smallest is
chosen, the rightmost of equal ones, with its position.  Two texts that share
a run of GRAM + WINDOW - 1 words share a chosen hash, and none comes from a
shared run of fewer than GRAM words.  A text of fewer words has one hash, of
all of them; a text without words has no fingerprint.

A hash (32 bits) and its position are kept in one long, hash in front and the
position counted down, so that the smallest number is the rightmost smallest
hash, and windows are minima of minima over 1, 2, 4, ... neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortmx.llm.common import written

GRAM, WINDOW = 5, 8          # the window is a power of two
LAST = (1 << 31) - 1
ROWS_A_RANGE = 2_000         # rows of one range of doc_ids, so that a window's rows fit in memory
MAX_RANGES = 4_096


def words(text: F.Column) -> F.Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams(word_hashes: F.Column, gram: int = GRAM) -> F.Column:
    """(hash, position counted down) of every run of ``gram`` hashes."""
    n = F.size(word_hashes)

    def packed(h: F.Column, i: F.Column) -> F.Column:
        return F.shiftleft(F.shiftrightunsigned(h, 32), 31) + (F.lit(LAST).cast("long") - i)

    runs = F.transform(F.sequence(F.lit(0), n - gram), lambda i: packed(F.xxhash64(*[F.get(word_hashes, i + j) for j in range(gram)]), i))
    return (F.when(n >= gram, runs)
            .when(n > 0, F.array(packed(F.xxhash64(word_hashes), F.lit(0).cast("long"))))
            .otherwise(F.array().cast("array<bigint>")))


def winnow(df: DataFrame, column: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with ``out``, the chosen (hash, position) longs of ``column`` by position."""
    df = df.withColumn("_h", F.transform(words(F.col(column)), lambda w: F.xxhash64(w)))
    df = df.withColumn("_m", grams(F.col("_h"), gram)).drop("_h")
    least, reach = df.withColumn("_all", F.array_min("_m")).withColumn("_n", F.size("_m")), 1
    while reach < window:
        shifted = F.slice("_m", reach + 1, F.greatest(F.size("_m") - reach, F.lit(0)))
        least = least.withColumn("_m", F.zip_with("_m", shifted, lambda a, b: F.least(a, b)))
        reach *= 2
    whole = F.slice("_m", 1, F.greatest(F.col("_n") - (window - 1), F.lit(0)))    # full windows only
    chosen = F.when(F.col("_n") == 0, F.array().cast("array<bigint>")).when(F.col("_n") < window, F.array("_all")).otherwise(F.array_distinct(whole))
    return least.withColumn(out, chosen).drop("_m", "_all", "_n")


def hashes_of(chosen: F.Column) -> F.Column:
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 31)))


def positions_of(chosen: F.Column) -> F.Column:
    return F.transform(chosen, lambda x: F.lit(LAST).cast("long") - x.bitwiseAND(F.lit(LAST).cast("long")))


def as_text(chosen: F.Column) -> F.Column:
    """hash:position, comma-joined, by position."""
    return F.array_join(F.transform(chosen, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, 31))), F.lit(":"), (F.lit(LAST).cast("long") - x.bitwiseAND(F.lit(LAST).cast("long"))).cast("string"))), ",")


def likeness(a: F.Column, b: F.Column) -> F.Column:
    """Jaccard similarity of two fingerprints' hashes (1 if both are empty)."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes, positions of the fingerprint of every row's text."""
    out = winnow(docs.select("doc_id", "text"), "text", "_c", gram, window)
    return out.select("doc_id", F.transform("_c", lambda x: F.shiftright(x, 31)).alias("hashes"), positions_of(F.col("_c")).alias("positions"))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``docs`` (doc_id, text, carried ...) with next_<column> of the next row
    by doc_id (equal ids: by text), after the last row the first one.

    Rows are dealt by ranges of doc_id, each range gets a copy of the first row
    of the next one behind its own rows, and the next row is looked up within
    the range.  Null ids come first.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    n = docs.count()
    ranges = max(1, min(MAX_RANGES, n // ROWS_A_RANGE))
    cuts = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        found = docs.agg(F.percentile_approx(key, shares, 10 * ranges).alias("cuts")).collect()[0]["cuts"]
        cuts = sorted(set(found))
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    dealt = docs.withColumn("_key", key).withColumn("_range", F.size(F.filter(bounds, lambda c: c < F.col("_key"))))
    firsts = dealt.groupBy("_range").agg(F.min("_key").alias("_key"))            # at most MAX_RANGES rows
    ring = Window.orderBy("_range")
    before = written(firsts.withColumn("_to", F.lag("_range").over(ring))
                     .withColumn("_to", F.coalesce("_to", F.max("_range").over(Window.partitionBy()))).select("_key", "_to"))
    copies = dealt.join(F.broadcast(before), "_key").withColumn("_range", F.col("_to")).drop("_to")
    both = dealt.withColumn("_copy", F.lit(False)).unionByName(copies.withColumn("_copy", F.lit(True)))
    order = Window.partitionBy("_range").orderBy("_copy", "_key", "text")
    for c in carried:
        both = both.withColumn(f"next_{c}", F.lead(c).over(order))
    return both.where(~F.col("_copy")).drop("_key", "_range", "_copy")


def edited_pairs(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row: its last quarter is replaced by as
    much of the beginning of the next text, and the fingerprints compared.

    Null texts count as empty, and two empty fingerprints are alike (1).
    Repeated rows are rows of their own; a null id stays null.  No rows: no
    rows.  Other columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    marked = with_next(own, ["text"])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = marked.withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))"),
                                                  F.substring(F.col("next_text"), F.lit(1), quarter)))
    for column, out in (("text", "_own"), ("edited", "_edited"), ("next_text", "_next")):
        edited = winnow(edited, column, out, gram, window)
    return edited.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"), as_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(hashes_of(F.col("_own")), hashes_of(F.col("_edited"))).alias("near_edited"),
        likeness(hashes_of(F.col("_own")), hashes_of(F.col("_next"))).alias("near_next"))
