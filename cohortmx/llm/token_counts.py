"""Exact token-length histogram of a corpus.

Texts are encoded in Spark tasks and aggregated to the number of documents of
each encoded length.  Suffix sums over that small table answer, for every
context limit at once, how many documents are longer, how many tokens the
corpus has if each is cut there, and any quantile.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortmx.llm.common import text_slices, written

RANGE = 1_024            # lengths of one range of the suffix sums
# white space as the tokenizer's pattern has it, in runs that its matcher has no stack for
_LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}+")
_ENCODINGS: dict[str, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoding(path: str):
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def count_tokens(encoding, text: str) -> int:
    """Tokens of ``text``, as ``encoding`` counts them.

    A very long run of white space is taken out first and encoded as what the
    pattern makes of it: one piece, without its last character if more text follows.
    """
    n, at = 0, 0
    for run in _LONG_BLANK.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        n += len(encoding.encode_ordinary(text[at:run.start()])) + len(encoding._encode_single_piece(text[run.start():end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:] if at else text))


def token_lengths(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens of every row's whole text (a null or empty text: 0)."""
    path = tokenizer or default_tokenizer()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for whole in batches:
            for b in text_slices(whole):
                n = [count_tokens(encoding, t) if t else 0 for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """A row for each length that occurs: n_tokens, n_docs, and for a context
    limit of that length n_longer (documents that are longer), tokens_kept (of
    all documents, each cut at the limit), tokens_cut, total_tokens, and the
    share of documents that are not longer (quantile).

    Suffix sums are taken in ranges of RANGE lengths, so no task sees more of
    the table than one range (and one row a range).  No documents: no rows.
    """
    counts = written(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
                     .withColumn("_range", F.floor(F.col("n_tokens") / RANGE)))
    tokens = F.col("n_tokens") * F.col("n_docs")
    ranges = counts.groupBy("_range").agg(F.sum("n_docs").alias("_d"), F.sum(tokens).alias("_t"))
    above = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranges = ranges.select("_range", F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_docs_above"),
                           F.coalesce(F.sum("_t").over(above), F.lit(0)).alias("_tokens_above"),
                           F.sum("_d").over(everything).alias("_docs"), F.sum("_t").over(everything).alias("total_tokens"))
    higher = Window.partitionBy("_range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = F.col("_docs_above") + F.coalesce(F.sum("n_docs").over(higher), F.lit(0))
    longer_tokens = F.col("_tokens_above") + F.coalesce(F.sum(tokens).over(higher), F.lit(0))
    out = counts.join(ranges, "_range").withColumn("n_longer", longer).withColumn("tokens_cut", longer_tokens - longer * F.col("n_tokens"))
    return out.select("n_tokens", "n_docs", "n_longer", (F.col("total_tokens") - F.col("tokens_cut")).alias("tokens_kept"),
                      "tokens_cut", "total_tokens", (1 - F.col("n_longer") / F.col("_docs")).alias("quantile"))


def at_limit(histogram: DataFrame, limit: int) -> tuple[int, int]:
    """(documents longer than ``limit``, tokens kept if each is cut there), for any limit."""
    row = histogram.agg(F.sum(F.when(F.col("n_tokens") > limit, F.col("n_docs"))).alias("longer"),
                        F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")).alias("kept")).collect()[0]
    return row["longer"] or 0, row["kept"] or 0


def quantile(histogram: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents don't exceed."""
    row = histogram.where(F.col("quantile") >= share - 1e-12).agg(F.min("n_tokens").alias("n")).collect()[0]
    return row["n"]
