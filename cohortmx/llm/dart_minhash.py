"""Near-duplicate classes by DartMinHash.

A document is a weighted set: its five-word shingles, each of weight 1 + ln(n)
if it occurs n times (so that one phrase said hundreds of times doesn't make
documents alike).  Every unit of weight of every shingle is a region into
which darts are thrown as a Poisson process over rank: dart s of a unit has
the rank of dart s-1 plus an exponential step drawn from a hash of (shingle,
unit, s), and a coordinate and a height within the unit drawn likewise (of a
part of a unit, only darts below its height count), so two documents get the
same darts on the weight that they share.  Darts up to a rank of (k ln k + 2k) / weight are
thrown, more only if a coordinate stays empty; the earliest dart of each
coordinate is the signature.  Two signatures agree in a coordinate with a
probability of the weighted Jaccard similarity.

Bands of the signature are joined to find candidates, whose exact weighted
Jaccard similarity decides (0.8 or more).  Equal texts are one class before
that.  Within a bucket nobody meets everybody: each member is compared with
the bucket's first one, and only members that this leaves open go on (see
``near_classes``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmx.llm.common import GOLDEN, mix64, only_ids, shingles, text_slices, word_hashes, written
from cohortmx.llm.components import components

K_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5        # a pair at 0.8 shares no band with a probability of (1 - 0.8**5)**25 = 5e-5
MAYBE = 0.65               # share of equal coordinates below which no pair at 0.8 is expected (4 standard deviations)
FEW, BLOCK = 8, 128        # members of a bucket that are paired by a join; members of a block's side beyond
BLOCK_SHINGLES = 1 << 18   # shingles of a block's side (2 MB)


def weight_of(n: np.ndarray) -> np.ndarray:
    """The weight of a shingle that occurs ``n`` times (0: none)."""
    return np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0.0)


def weighted_units(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The units of weight of each document's shingles: a key (the shingle's
    hash mixed with the unit's number), the document, and how much of the unit
    there is (1, but for the last unit of a weight)."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    run = np.flatnonzero(new)
    weight = weight_of(np.diff(np.append(run, len(h))))
    units = np.ceil(weight).astype(np.int64)
    nth = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
    share = np.minimum(np.repeat(weight, units) - nth, 1.0)
    return mix64(np.repeat(h[run], units) + nth.astype(np.uint64) * GOLDEN), np.repeat(d[run], units), share


def signatures(keys: np.ndarray, doc: np.ndarray, share: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """(n_docs, k) ranks of the earliest darts as float32 bits (0: no weight)."""
    sig = np.zeros((n_docs, k), np.uint32)
    weight = np.bincount(doc, share, n_docs)
    reach = np.where(weight > 0, (k * math.log(k) + 2 * k) / np.maximum(weight, 1.0), 0.0)
    todo = weight > 0
    while todo.any():
        at = np.flatnonzero(todo[doc])
        row = (np.cumsum(todo) - 1)[doc[at]]
        key, limit, height = keys[at], reach[doc[at]], share[at]
        rank, s, cells = np.zeros(len(at)), 0, []
        while len(key):
            s += 1
            draw = mix64(key + np.uint64(s * int(GOLDEN) % 2**64))
            rank = rank - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53))
            hit = rank < limit
            key, rank, limit, row, draw, height = key[hit], rank[hit], limit[hit], row[hit], draw[hit], height[hit]
            coord = mix64(draw ^ key)
            cell = (row * k + (coord % np.uint64(k)).astype(np.int64)).astype(np.uint64)
            dart = (cell << np.uint64(32)) | rank.astype(np.float32).view(np.uint32).astype(np.uint64)
            cells.append(dart[(height >= 1) | ((mix64(coord) >> np.uint64(11)).astype(np.float64) / float(1 << 53) < height)])
        thrown = np.sort(np.concatenate(cells))
        cell = (thrown >> np.uint64(32)).astype(np.int64)
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        got = np.zeros((int(todo.sum()), k), np.uint32)
        got.reshape(-1)[cell[first]] = (thrown[first] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        rows = np.flatnonzero(todo)
        full = (got > 0).all(axis=1)
        sig[rows[full]] = got[full]
        todo[rows[full]] = False
        reach = np.where(todo, 2 * reach, reach)
    return sig


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.broadcast_to(np.arange(bands, dtype=np.uint64) * GOLDEN, (len(sig), bands)).copy()
    for j in range(rows):
        acc = mix64(acc * np.uint64(31) + sig[:, j::rows][:, :bands].astype(np.uint64) + GOLDEN)
    return acc.view(np.int64)


def band_table(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, k_words: int = K_WORDS) -> DataFrame:
    """doc_id, two 64-bit hashes of the text, its band hashes and signature (null: no words)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                texts = b.column("text")
                hashes, ends = word_hashes(texts)
                found, doc, _ = shingles(hashes, ends, k_words)
                keys, doc, share = weighted_units(found, doc)
                sig = signatures(keys, doc, share, len(b), bands * rows)
                has = np.bincount(doc, minlength=len(b)) > 0

                def lists(values: np.ndarray) -> pa.Array:
                    ends = pa.array(np.concatenate([[0], np.cumsum(has * values.shape[1])]).astype(np.int32), mask=np.append(~has, False))
                    return pa.ListArray.from_arrays(ends, pa.array(values[has].reshape(-1)))

                digests = [xxhash.xxh3_128_intdigest(t or "") for t in texts.to_pylist()]
                h1 = np.array([d & (2**64 - 1) for d in digests], np.uint64).view(np.int64)
                h2 = np.array([d >> 64 for d in digests], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(h1), pa.array(h2), lists(band_hashes(sig, bands, rows)), lists(sig.view(np.int32))],
                                                 ["doc_id", "h1", "h2", "bands", "sig"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(sign, "doc_id long, h1 long, h2 long, bands array<long>, sig array<int>"))


def similarities(pairs: DataFrame, docs: DataFrame, k_words: int = K_WORDS) -> DataFrame:
    """``pairs`` (a, b) with their exact weighted Jaccard similarity over whole texts."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id")))
    texts = only_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text_b"):
                both = []
                for name in ("text_a", "text_b"):
                    hashes, ends = word_hashes(b.column(name))
                    both.append(shingles(hashes, ends, k_words)[:2])
                h = np.concatenate([both[0][0], both[1][0]])
                pair = np.concatenate([both[0][1], both[1][1]])
                side = np.repeat([0, 1], [len(both[0][0]), len(both[1][0])])
                order = np.lexsort((h, pair))
                h, pair, side = h[order], pair[order], side[order]
                run = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (pair[1:] != pair[:-1])])) if len(h) else np.zeros(0, int)
                in_b = np.add.reduceat(side, run) if len(run) else run
                in_a = np.diff(np.append(run, len(h))) - in_b
                least = np.bincount(pair[run], weight_of(np.minimum(in_a, in_b)), len(b)) if len(run) else np.zeros(len(b))
                most = np.bincount(pair[run], weight_of(np.maximum(in_a, in_b)), len(b)) if len(run) else np.zeros(len(b))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(least / np.maximum(most, 1))], ["a", "b", "sim"])

    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return with_b.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long, sim double")


def shingle_lists(docs: DataFrame, k_words: int = K_WORDS) -> DataFrame:
    """doc_id, the sorted hashes of all its shingles (one that occurs n times is there n times)."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                found, doc, _ = shingles(*word_hashes(b.column("text")), k_words)
                order = np.lexsort((found, doc))
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(b)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(found[order].view(np.int64)))],
                                                 ["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lists, "doc_id long, shingles array<long>")


def near_classes(members: DataFrame, signed: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, k_words: int = K_WORDS) -> DataFrame:
    """(node, component) of the documents that links of similarity >=
    threshold within buckets connect.

    ``members``: bucket, doc_id (one per distinct text); ``signed``: doc_id,
    sig.  First every member is compared with its bucket's smallest one, the
    hub, which connects most that belong together.  Then, in buckets whose
    other members are still in several components, those outside the hub's
    component are compared with everybody in another component than theirs: in
    buckets of at most FEW by signature, and exactly where the signatures agree
    in MAYBE of their coordinates; in larger ones exactly, in blocks (see
    ``_links_in_blocks``).  So no link between components is missed, and
    members that are connected already don't meet.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("hub"))
    star = written(members.join(sizes.where("n > 1"), "bucket").where("doc_id <> hub").select("bucket", "hub", "doc_id", "n"))
    pairs = written(star.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = written(similarities(pairs, docs, k_words).where(F.col("sim") >= threshold).select("a", "b"))
    found = written(components(links))
    names = found.select(F.col("node").alias("doc_id"), "component")
    of = (star.where("n > 2").join(names, "doc_id", "left").withColumn("own", F.coalesce("component", "doc_id")).drop("component")
          .join(names.select(F.col("doc_id").alias("hub"), F.col("component").alias("main")), "hub", "left")
          .select("bucket", "doc_id", "own", (F.col("own") != F.coalesce("main", "hub")).alias("outside")))
    mixed = of.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("low"), F.max("own").alias("high")).where("low < high")
    open_ = written(of.join(mixed.select("bucket", "n"), "bucket"))
    if open_.isEmpty():
        return found
    close = written(_close_by_signature(open_.where(F.col("n") <= FEW), signed).join(pairs, ["a", "b"], "left_anti"))
    more = written(similarities(close, docs, k_words).where(F.col("sim") >= threshold).select("a", "b"))
    wide = written(_links_in_blocks(open_.where(F.col("n") > FEW), docs, threshold, k_words))
    return written(components(links.union(more).union(wide)))


def _close_by_signature(open_: DataFrame, signed: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of a member outside the hub's component and one
    of another component in its bucket, whose signatures agree enough."""
    sigs = only_ids(signed.select("doc_id", "sig"), open_)
    one = open_.select("bucket", F.col("doc_id").alias("a"), F.col("own").alias("own_a"), F.col("outside").alias("out_a"))
    other = open_.select("bucket", F.col("doc_id").alias("b"), F.col("own").alias("own_b"), F.col("outside").alias("out_b"))
    near = (one.join(other, "bucket").where("a < b and own_a <> own_b and (out_a or out_b)").select("a", "b").distinct()
            .join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b"))
    agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda x: x)) / F.size("sig_a")
    return near.where(agree >= MAYBE).select("a", "b").distinct()


def _links_in_blocks(open_: DataFrame, docs: DataFrame, threshold: float, k_words: int) -> DataFrame:
    """Links (a < b) that connect, bucket by bucket, what members outside the
    hub's component and members of other components connect.

    Every outside member meets every member, in blocks that hold about BLOCK
    members and BLOCK_SHINGLES shingles on either side (a longer document is
    alone there).  A block compares by the exact weighted similarity and
    returns only links between what it hasn't connected yet: at most one less
    than it has members, whatever its pairs.
    """
    lists = written(shingle_lists(only_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), open_), k_words).distinct())
    sized = open_.join(lists.select("doc_id", F.size("shingles").cast("long").alias("size")), "doc_id")

    def parts(number: F.Column, size: F.Column) -> F.Column:
        return F.greatest(F.ceil(number / BLOCK), F.ceil(size / BLOCK_SHINGLES)).cast("int")

    out = F.col("outside").cast("long")
    shape = (sized.groupBy("bucket").agg(parts(F.sum(out), F.sum(out * F.col("size"))).alias("rows"), parts(F.count(F.lit(1)), F.sum("size")).alias("cols"))
             .where("rows > 0"))
    wide = open_.drop("n").join(shape, "bucket").join(lists, "doc_id")      # lists meet members by document, never by bucket

    def place(salt: int, among: str) -> F.Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col(among)).cast("int")

    base = ["bucket", "doc_id", "own", "shingles"]
    left = wide.where("outside").select(*base, place(1, "rows").alias("row"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("col"), F.lit(True).alias("asks"))
    right = wide.select(*base, F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), place(2, "cols").alias("col"), F.lit(False).alias("asks"))
    blocks = left.unionByName(right)

    def link(group: pa.Table) -> pa.Table:
        asks, ids = group.column("asks").to_numpy(), group.column("doc_id").to_numpy()
        part = np.unique(group.column("own").to_numpy(), return_inverse=True)[1]
        shingled = group.column("shingles").combine_chunks()
        hashes = shingled.flatten().to_numpy().view(np.uint64)
        doc = np.repeat(np.arange(len(ids)), shingled.value_lengths().to_numpy())
        # the nth of a shingle is an element of its own, which adds to the weight what it adds to 1 + ln(n)
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        nth = np.arange(len(hashes)) - np.flatnonzero(new)[np.cumsum(new) - 1] + 1
        weight = weight_of(nth) - weight_of(nth - 1)
        element = np.unique(mix64(hashes + nth.astype(np.uint64) * GOLDEN), return_inverse=True)[1]
        total = np.bincount(doc, weight, len(ids))
        starts = np.searchsorted(doc, np.arange(len(ids) + 1))
        y = np.flatnonzero(~asks)
        of_y = ~asks[doc]
        to, of, adds = (np.cumsum(~asks) - 1)[doc[of_y]], element[of_y], weight[of_y]
        found, mark = [], np.zeros(len(element) + 1, bool)
        for i in np.flatnonzero(asks):
            apart = part[y] != part[i]
            if not (apart & (np.minimum(total[y], total[i]) >= threshold * np.maximum(total[y], total[i]))).any():
                continue
            own = element[starts[i]:starts[i + 1]]
            mark[own] = True
            at = mark[of]
            mark[own] = False
            shared = np.bincount(to[at], adds[at], len(y))
            for j in y[apart & (shared >= threshold * (total[y] + total[i] - shared))]:
                if part[i] != part[j]:
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    part[part == part[j]] = part[i]
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": both[:, 0], "b": both[:, 1]})

    return blocks.groupBy("bucket", "row", "col").applyInArrow(link, "a long, b long").distinct()


def _unambiguous(docs: DataFrame, bands: int, rows: int, k_words: int) -> tuple[DataFrame, DataFrame, bool]:
    """(``docs``, its written band table, False) if every doc_id stands for one
    text.  Else each text of an id that stands for several gets a number of its
    own, below all ids: (``docs`` with that as doc_id and the id in _doc_id,
    its band table, True)."""
    signed = written(band_table(docs, bands, rows, k_words))
    named = signed.where(F.col("doc_id").isNotNull())
    several = written(named.groupBy("doc_id").agg((F.min("h1") < F.max("h1")).alias("several")).where("several").select("doc_id"))
    if several.isEmpty():
        return docs, signed, False
    low = min(named.agg(F.min("doc_id")).collect()[0][0], 0)
    own = docs.withColumn("_doc_id", F.col("doc_id").cast("long")).withColumn("_text", F.xxhash64("text"))
    texts = only_ids(own.select(F.col("_doc_id").alias("doc_id"), "_text"), several).distinct()
    numbers = written(texts.withColumn("_number", F.lit(low - 1) - F.monotonically_increasing_id()).withColumnsRenamed({"doc_id": "_doc_id"}))
    marked = own.join(numbers, ["_doc_id", "_text"], "left").withColumn("doc_id", F.coalesce("_number", "_doc_id")).drop("_number", "_text")
    return marked, written(band_table(marked, bands, rows, k_words)), True


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    k_words: int = K_WORDS) -> DataFrame:
    """One row per document: doc_id, text_id, class_id, n_rows.

    ``text_id`` is the smallest doc_id with the same text, ``class_id`` the
    smallest doc_id of the near-duplicate class (equal texts, and texts
    connected by links), ``n_rows`` how many rows the doc_id has in ``docs``
    with that text (1 unless rows repeat; such rows are one result row each).

    A text without any word (null, empty, punctuation only) is a class with
    its equals if it is not empty, else by itself.  A row with a null doc_id
    can't be named: its text_id and class_id are null and nothing is compared
    with it.  If a doc_id stands for several texts, each of these is a document
    of its own: for it, text_id and class_id use a number that no doc_id has.
    No rows: no rows.  Other columns of ``docs`` are ignored.
    """
    marked, signed, renamed = _unambiguous(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), bands, rows, k_words)
    out = _classes(marked, signed, threshold, k_words)
    if not renamed:
        return out
    ids = marked.where("doc_id <> _doc_id").select("doc_id", "_doc_id").distinct()
    return out.join(ids, "doc_id", "left").select(F.coalesce("_doc_id", "doc_id").alias("doc_id"), "text_id", "class_id", "n_rows")


def _classes(docs: DataFrame, signed: DataFrame, threshold: float, k_words: int) -> DataFrame:
    """``near_duplicates`` of documents whose ids stand for one text each, from their band table."""
    empty = xxhash.xxh3_128_intdigest("")
    lone = (F.col("h1") == _signed(empty & (2**64 - 1))) & (F.col("h2") == _signed(empty >> 64))
    named = signed.where(F.col("doc_id").isNotNull())
    texts = written(named.where(~lone).groupBy("h1", "h2").agg(F.min("doc_id").alias("text_id")))
    firsts = written(only_ids(named.where(F.col("bands").isNotNull()).select("doc_id", "bands", "sig"), texts.select(F.col("text_id").alias("doc_id")))
                     .dropDuplicates(["doc_id", "bands"]))
    rows_of = firsts.select(F.explode("bands").alias("bucket"), "doc_id")
    shared = rows_of.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = written(rows_of.join(shared, "bucket").distinct())
    found = near_classes(members, firsts, docs, threshold, k_words)
    classes = (texts.join(found, texts["text_id"] == found["node"], "left")
               .select("h1", "h2", "text_id", F.coalesce("component", "text_id").alias("class_id")))
    per_row = named.groupBy("doc_id", "h1", "h2").agg(F.count(F.lit(1)).alias("n_rows"))
    known = (per_row.join(classes, ["h1", "h2"], "left")
             .select("doc_id", "h1", "h2", F.coalesce("text_id", "doc_id").alias("text_id"),
                     F.coalesce("class_id", "doc_id").alias("class_id"), "n_rows"))
    null_ids = signed.where(F.col("doc_id").isNull()).select(
        "doc_id", "h1", "h2", F.lit(None).cast("long").alias("text_id"), F.lit(None).cast("long").alias("class_id"), F.lit(1).cast("long").alias("n_rows"))
    return known.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))).drop("_n").union(null_ids).drop("h1", "h2")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, k_words: int = K_WORDS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, all columns as
    they are.  Rows with a null doc_id stay; of rows that repeat a doc_id and
    its text one stays; different texts under one doc_id are different documents."""
    marked, signed, renamed = _unambiguous(docs, bands, rows, k_words)
    classes = written(_classes(marked, signed, threshold, k_words))
    kept = classes.where("doc_id = class_id")
    n_kept = kept.select("doc_id").distinct()
    nameless = docs.where(F.col("doc_id").isNull())
    stay = marked.join(n_kept, "doc_id", "left_semi")
    if not kept.where("n_rows > 1").isEmpty():
        stay = stay.dropDuplicates(["doc_id"])       # repeated rows
    if renamed:
        stay = stay.withColumn("doc_id", F.col("_doc_id").cast(docs.schema["doc_id"].dataType))
    return stay.select(*docs.columns).union(nameless)
