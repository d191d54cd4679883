"""Benchmark decontamination by SimHash over item-sized windows.

A document is contaminated by a benchmark item if a window of the document as
many words long as the item has a weighted-shingle similarity of 0.8 or more
to it (five-word shingles; weight: count times rarity among the items).  An
item of fewer than five words is no passage: it only contaminates a document
that is the same few words.

Every window that shares at least one shingle with an item gets a 64-bit
SimHash; windows that share none have similarity 0, so nothing is lost by
leaving them out.  A multi-index of 8 blocks of 8 bits finds every item within
RADIUS = 23 bits: of 8 blocks one differs in at most 2 bits then, and the
index lists the items under every block value up to 2 bits away.  A pair at
similarity 0.8 differs in about 10 bits.  The exact similarity decides.

The benchmark is taken in blocks of at most BLOCK_ITEMS items and about
BLOCK_BYTES of text, each an index of bounded size that is broadcast.  With
several blocks the documents are not read once for each: a Bloom filter of all
items' shingles (at most BLOOM_BITS bits) picks the documents that may share a
shingle with any item, these are written, and only they meet every block; what
the filter lets through in vain is dropped there.  Rarity is counted once over
all items, so results don't depend on the blocks: shingles of a single item
weigh as much as unknown ones, and those of two items or more (12 bytes each)
are broadcast beside the blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmx.llm.common import shingles, text_slices, word_hashes, written

K_WORDS = 5
THRESHOLD = 0.8
BITS, BLOCKS, RADIUS = 64, 8, 23
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 64 << 20
BLOOM_BITS = 1 << 29       # 64 MB; 16 bits a shingle up to 32 million shingles


def _bits(h: np.ndarray) -> np.ndarray:
    """The 64 bits of each hash as +1 and -1."""
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64) * 2 - 1


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] numbers), first[1], ..."""
    return np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class MultiIndex:
    """Fingerprints by the values of their blocks, each listed under every
    value up to RADIUS // BLOCKS bits away."""

    FLIPS = np.array([sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1) for c in itertools.combinations(range(BITS // BLOCKS), r)])

    def __init__(self, items: np.ndarray, prints: np.ndarray):
        self.items, self.prints, self.lists = items, prints, []
        for block in range(BLOCKS):
            under = (self._value(prints, block)[:, None] ^ self.FLIPS).reshape(-1)
            order = np.argsort(under, kind="stable")
            starts = np.searchsorted(under[order], np.arange(257))
            self.lists.append((order // len(self.FLIPS), starts))

    @staticmethod
    def _value(prints: np.ndarray, block: int) -> np.ndarray:
        return ((prints >> np.uint64(8 * block)) & np.uint64(255)).astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, item, distance) of every item within RADIUS of each fingerprint."""
        pairs = []
        for block, (order, starts) in enumerate(self.lists):
            value = self._value(prints, block)
            n = starts[value + 1] - starts[value]
            pairs.append(np.repeat(np.arange(len(prints)), n) * len(self.items) + order[_ranges(starts[value], n)])
        pair = np.unique(np.concatenate(pairs))
        q, i = pair // len(self.items), pair % len(self.items)
        apart = np.bitwise_count(prints[q] ^ self.prints[i]).astype(np.int64)
        ok = apart <= RADIUS
        return q[ok], self.items[i[ok]], apart[ok]


class Rarity:
    """Weights of shingles by all items: log(1 + items / items with the
    shingle), in units of 2**-16 so that sums are exact."""

    def __init__(self, items: int, known: np.ndarray, df: np.ndarray):
        """``known``: the shingles that two items or more have, ``df``: how many."""
        order = np.argsort(known)
        self.known = known[order]
        self.rarity = np.rint(65536 * np.log1p(items / df[order])).astype(np.int32)
        self.unknown = int(np.rint(65536 * np.log1p(items)))

    def weight(self, h: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(h), self.unknown, np.int64)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.rarity[at], self.unknown).astype(np.int64)


def _rarity(items: DataFrame, n: int, k_words: int) -> Rarity:
    """Rarity over the ``n`` rows of ``items``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                h, item, _ = shingles(*word_hashes(b.column("text")), k_words)
                own = np.unique(np.stack([h, item.astype(np.uint64)]), axis=1)
                known, df = np.unique(own[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(df.astype(np.int64))], ["shingle", "df"])

    counted = (items.select("text").mapInArrow(count, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df"))
               .where("df > 1").toArrow())
    return Rarity(n, counted["shingle"].to_numpy().view(np.uint64), counted["df"].to_numpy())


class ItemIndex:
    """Shingles and SimHash multi-indexes (one for each window size) of a block of items."""

    def __init__(self, ids: list[int], texts: list[str], rarity: Rarity, k_words: int = K_WORDS):
        hashes, ends = word_hashes(pa.array(texts, pa.string()))
        h, item, _ = shingles(hashes, ends, k_words)
        self.ids, self.k, self.words = np.array(ids, np.int64), k_words, np.diff(ends, prepend=0)
        self.spans = np.maximum(self.words - k_words + 1, 1)
        order = np.argsort(h, kind="stable")
        self.h, self.item = h[order], item[order]
        self.bloom = np.zeros(1 << 22, bool)
        self.bloom[(h & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        at = np.searchsorted(item, np.arange(len(ids) + 1))
        self.own = [np.unique(h[at[i]:at[i + 1]], return_counts=True) for i in range(len(ids))]
        prints = self.simhash(h, at[:-1], self.spans, rarity)
        self.by_span = {int(m): MultiIndex(np.flatnonzero(self.spans == m), prints[self.spans == m]) for m in np.unique(self.spans)}

    def simhash(self, h: np.ndarray, first: np.ndarray, span: np.ndarray, rarity: Rarity) -> np.ndarray:
        """Fingerprints of the runs of ``span`` shingles from ``first`` on: the
        sign of the weighted sum of each bit, from running sums over the
        shingles that any run covers."""
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, first, 1)
        np.add.at(cover, first + span, -1)
        inside = np.cumsum(cover)[:-1] > 0
        part = h[inside]
        sums = np.zeros((len(part) + 1, BITS), np.int64)
        np.cumsum(_bits(part) * rarity.weight(part)[:, None], axis=0, out=sums[1:])
        at = (np.cumsum(inside) - inside)[first]
        return np.concatenate([np.packbits(sums[at[a:a + 20_000] + span[a:a + 20_000]] > sums[at[a:a + 20_000]], axis=1).view("<u8").reshape(-1)
                               for a in range(0, len(at), 20_000)]).astype(np.uint64)

    def similarity(self, window: np.ndarray, i: int, rarity: Rarity) -> float:
        h, n = np.unique(window, return_counts=True)
        own, m = self.own[i]
        at = np.minimum(np.searchsorted(own, h), len(own) - 1)
        weight = rarity.weight(h)
        shared = int((np.where(own[at] == h, np.minimum(n, m[at]), 0) * weight).sum())
        return shared / (int((n * weight).sum()) + int((m * rarity.weight(own)).sum()) - shared)

    def hits(self, texts: pa.Array, threshold: float, rarity: Rarity) -> list[tuple[int, int, int, int, int, float]]:
        """(text number, item id, first word, words, distance, similarity): for
        each text and item the most similar window (of ties the first)."""
        hashes, ends = word_hashes(texts)
        length = np.diff(ends, prepend=0)
        h, doc, pos = shingles(hashes, ends, self.k)
        maybe = np.flatnonzero(self.bloom[(h & np.uint64((1 << 22) - 1)).astype(np.int64)])
        left = np.searchsorted(self.h, h[maybe], "left")
        n = np.searchsorted(self.h, h[maybe], "right") - left
        if not n.sum():
            return []
        seed = np.repeat(maybe, n)
        count = np.maximum(length - self.k + 1, 1)               # shingles of each text
        base = np.cumsum(count * (length > 0)) - count           # and its first one
        span = np.minimum(self.spans[self.item[_ranges(left, n)]], count[doc[seed]])
        span, seed = np.unique(np.stack([span, seed]), axis=1)   # items of one size look at the same windows
        low = base[doc[seed]]
        first = np.maximum(seed - span + 1, low)
        n = np.minimum(seed, low + count[doc[seed]] - span) - first + 1
        span, first = np.unique(np.stack([np.repeat(span, n), _ranges(first, n)]), axis=1)
        prints = self.simhash(h, first, span, rarity)
        whole = span == count[doc[first]]
        best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
        for m, index in self.by_span.items():
            # a text shorter than the item is one window
            asked = np.flatnonzero((span == m) | (whole & (span < m)))
            if not len(asked):
                continue
            for q, i, apart in zip(*index.near(prints[asked])):
                w = asked[q]
                d = int(doc[first[w]])
                sim = self.similarity(h[first[w]:first[w] + span[w]], i, rarity)
                found = (sim, -int(pos[first[w]]), -int(apart), int(min(self.words[i], length[d])))
                if sim >= threshold and found > best.get((d, int(i)), (0.0,)):
                    best[d, int(i)] = found
        return [(d, int(self.ids[i]), -at, words, -apart, sim) for (d, i), (sim, at, apart, words) in sorted(best.items())]


def _items(benchmark: DataFrame) -> DataFrame:
    """The items that have an id and a word, written."""
    return written(benchmark.where(F.col("item_id").isNotNull() & F.col("text").rlike(r"[\p{L}\p{N}_]"))
                   .select(F.col("item_id").cast("long").alias("item_id"), "text"))


def _n_blocks(items: DataFrame, block_items: int) -> tuple[int, int]:
    """(items, blocks that hold them)."""
    n, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).collect()[0]
    return n, max(-(-n // block_items), -(-(size or 0) // BLOCK_BYTES))


def _indexes(items: DataFrame, n: int, blocks: int, k_words: int) -> Iterator[tuple[Broadcast, Broadcast]]:
    """An index for each block of the items, and the rarity by all of them."""
    sc = items.sparkSession.sparkContext
    rarity = _rarity(items, n, k_words) if n else None
    shared = sc.broadcast(rarity)
    for i in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i) if blocks > 1 else items
        rows = sorted(block.collect(), key=lambda r: (r["item_id"], r["text"]))
        if rows:
            yield sc.broadcast(ItemIndex([r["item_id"] for r in rows], [r["text"] for r in rows], rarity, k_words)), shared


def _probes(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two places of a Bloom filter for each hash."""
    return [((h >> np.uint64(s)) % np.uint64(bits)).astype(np.int64) for s in (0, 17)]


def shingle_filter(items: DataFrame, k_words: int = K_WORDS, most: int = BLOOM_BITS) -> np.ndarray:
    """Bloom filter (bytes) of the items' shingles: 16 bits for each, at most ``most``.

    Set places are collected as words of 64 bits, merged by Spark: never more
    of them than the filter has."""

    def shingled(batches: Iterator[pa.RecordBatch], bits: int | None) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                h = np.unique(shingles(*word_hashes(b.column("text")), k_words)[0])
                if bits is None:
                    yield pa.RecordBatch.from_arrays([pa.array([len(h)], pa.int64())], ["n"])
                    continue
                place = np.unique(np.concatenate(_probes(h, bits)))
                word, first = np.unique(place >> 6, return_index=True)
                mask = np.bitwise_or.reduceat(np.uint64(1) << (place & 63).astype(np.uint64), first) if len(place) else place
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(mask.view(np.int64), pa.int64())], ["word", "mask"])

    texts = items.select("text")
    n = texts.mapInArrow(lambda b: shingled(b, None), "n long").agg(F.sum("n")).collect()[0][0] or 1
    bits = min(most, max(1 << 10, 1 << (16 * n - 1).bit_length()))
    out = np.zeros(bits >> 6, np.uint64)
    found = texts.mapInArrow(lambda b: shingled(b, bits), "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return out


def _may_share(bloom: Broadcast, k_words: int):
    """Whether a text may have a shingle of the filter."""

    @F.arrow_udf("boolean")
    def may(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0, bool)]
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            h, doc, _ = shingles(*word_hashes(part.column("text")), k_words)
            hit = np.ones(len(h), bool)
            for place in _probes(h, len(bloom.value) << 6):
                hit &= (bloom.value[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            out.append(np.bincount(doc[hit], minlength=len(part)) > 0)
        return pa.array(np.concatenate(out))

    return may


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, k_words: int = K_WORDS,
                  block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, first_word, n_words, hamming, similarity: the most
    similar window for each document row and item at ``threshold`` or more.

    Null and empty texts and items have no hits; a document shorter than an
    item is one window.  Repeated rows are reported each, a null doc_id as
    null.  No documents or no items: no rows.  Other columns are ignored.
    """
    schema = "doc_id long, item_id long, first_word long, n_words long, hamming long, similarity double"
    spark = docs.sparkSession

    def pass_over(index, rarity):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in text_slices(whole):
                    hits = index.value.hits(b.column("text"), threshold, rarity.value)
                    ids = b.column("doc_id").take(pa.array([x[0] for x in hits], pa.int64()))
                    rest = [pa.array([x[j] for x in hits], pa.float64() if j == 5 else pa.int64()) for j in range(1, 6)]
                    yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "item_id", "first_word", "n_words", "hamming", "similarity"])
        return scan

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = _items(benchmark)
    n, blocks = _n_blocks(items, block_items)
    if blocks > 1:
        texts = written(texts.where(_may_share(spark.sparkContext.broadcast(shingle_filter(items, k_words)), k_words)(F.col("text"))))
    found = [texts.mapInArrow(pass_over(*x), schema) for x in _indexes(items, n, blocks, k_words)]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, k_words: int = K_WORDS,
                      block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``docs`` without the rows that any item contaminates, all columns as they are."""
    def clean(index, rarity):
        @F.arrow_udf("boolean")
        def is_clean(texts: pa.Array) -> pa.Array:
            out = []
            for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"])):
                ok = np.ones(len(part), bool)
                ok[[x[0] for x in index.value.hits(part.column("text"), threshold, rarity.value)]] = False
                out.append(ok)
            return pa.array(np.concatenate(out) if out else np.zeros(0, bool))
        return is_clean

    items = _items(benchmark)
    n, blocks = _n_blocks(items, block_items)
    untouched = None
    if blocks > 1:
        may = _may_share(docs.sparkSession.sparkContext.broadcast(shingle_filter(items, k_words)), k_words)
        untouched, docs = docs.where(~may(F.col("text"))), written(docs.where(may(F.col("text"))))
    for x in _indexes(items, n, blocks, k_words):
        docs = docs.where(clean(*x)(F.col("text")))
    return docs if untouched is None else untouched.union(docs)
