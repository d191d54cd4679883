"""Helpers that the operators of this folder share.

Work on texts runs in Arrow batches inside Spark tasks.  A batch is cut into
slices of bounded text size first (``text_slices``), so that a run of very
long documents doesn't have to fit in memory at once.  The Arrow batches
themselves are bounded by bytes (``small_batches``): Spark's 64 MB are held
several times over by each Python worker and by the JVM that feeds it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmx.session import scratch_path

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20        # of an Arrow batch between the JVM and Python
BROADCAST_ROWS = 2_000_000   # ids: 16 MB

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)   # fixed values: splitmix64
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches to BATCH_BYTES (results don't depend on it)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared scratch folder: lineage ends there,
    and every later step reads the same rows."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{scratch_path(spark, 'llm')}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def fold(doc_id: F.Column, parts: int) -> F.Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def only_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids``: by broadcast up to
    BROADCAST_ROWS counted ids, by a shuffled semi join beyond."""
    ids = ids.select(key).distinct()
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if small else ids.hint("merge"), key, "left_semi")


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.cumsum(size) // limit
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(size)]):
        if b > a:
            yield batch.slice(a, b - a)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_BASE = int(mix64(np.array([7], np.uint64))[0]) | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse ** i modulo 2**64, for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x, np.uint64)])) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and each text's end in them (a null has none)."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(offsets, wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends[1:] - ends[0]


def _in_word(raw: np.ndarray) -> np.ndarray:
    """Bytes of letters, digits and underscores: of ASCII these; of the rest all
    but the signs of Latin-1, general punctuation and CJK punctuation."""
    table = np.zeros(256, bool)
    table[[*b"0123456789abcdefghijklmnopqrstuvwxyz_", *range(0x80, 256)]] = True
    ok = table[raw]
    for lead, second, third in ((0xC2, range(0xA0, 0xC0), False), (0xE2, (0x80, 0x81), True), (0xE3, (0x80,), True)):
        at = np.flatnonzero(raw[:-1] == lead)
        at = at[np.isin(raw[at + 1], np.array([x for x in second if (lead, x) not in ((0xC2, 0xAA), (0xC2, 0xB5), (0xC2, 0xBA))], np.uint8))]
        for j in range(3 if third else 2):
            ok[at + j] = False
    return ok


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words (maximal runs of letters, digits
    and underscores) of all texts in a row, and each text's end in it.

    Null and empty texts have no words.  A word's hash is a polynomial of its
    bytes, taken from running sums over the whole slice.
    """
    raw, ends = utf8(pc.utf8_lower(texts))
    ok = _in_word(raw)
    begins = ok.copy()
    begins[1:] &= ~ok[:-1]
    cuts = ends[:-1][ends[:-1] < len(raw)]
    begins[cuts] = ok[cuts]                              # a text's first byte begins a word
    first = np.flatnonzero(begins)
    stops = ok.copy()
    stops[:-1] &= ~ok[1:]
    last = ends[(ends > 0)] - 1
    stops[last] = ok[last]
    end = np.flatnonzero(stops) + 1
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:-1], out=sums[1:])
    hashes = mix64((sums[end] - sums[first]) * inverse[first] + (end - first).astype(np.uint64))
    return hashes, np.searchsorted(first, ends)


def shingles(hashes: np.ndarray, ends: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each text, in order: (hash, text
    number, position).  A text of 1 to k-1 words has one shingle, all its words.
    """
    n_texts = len(ends)
    starts = np.concatenate([[0], ends[:-1]]) if n_texts else np.zeros(0, np.int64)
    length = ends - starts
    n = len(hashes)
    doc = np.repeat(np.arange(n_texts), length)
    pos = np.arange(n) - starts[doc] if n else np.zeros(0, np.int64)
    room = length[doc] - pos if n else np.zeros(0, np.int64)
    first = (room >= k) | (pos == 0)
    at = np.flatnonzero(first)
    size = np.minimum(room[at], k)
    acc = np.zeros(len(at), np.uint64)
    for j in range(k):
        ok = size > j
        acc[ok] = mix64(acc[ok] * np.uint64(31) + hashes[at[ok] + j] + GOLDEN)
    return acc, doc[at], pos[at]
