"""Language identification by rank-order n-gram profiles (out-of-place distance).

Texts are folded to lower-case letters with one space for any run of other
characters, and a space at both ends.  The n-grams of 1 to 3 characters that
hold a letter are counted; a language's profile ranks its PROFILE most
frequent ones over all training texts, a document's profile its own PROFILE
most frequent ones (ties by code points).  The distance is the sum of rank
differences, with PROFILE for an n-gram that the language's profile lacks;
the nearest language is predicted (ties: the first by name).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortmx.llm.common import fold, text_slices, written

PROFILE = 400
MAX_LANGUAGES = 2_000      # bounds the profiles that are broadcast
FLUSH = 1_000_000          # distinct n-grams that a task gathers before it emits them
UNKNOWN = "und"
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    if not _FOLD:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts, each between spaces, and the text number of each."""
    raw = np.frombuffer("".join(f" {t or ''} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t or "") + 2 for t in texts])
    folded = _fold_table()[raw]
    keep = np.ones(len(folded), bool)
    if len(folded):
        keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32) | (doc[1:] != doc[:-1])
    return folded[keep], doc[keep]


def compact(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The distinct characters, each point as one of the numbers from 1 on that
    stand for them (in their order), and the bits that a number takes."""
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    symbols = np.flatnonzero(seen)
    small = np.zeros(0x110000, np.int64)
    small[symbols] = np.arange(1, len(symbols) + 1)
    return symbols, small[points], max(len(symbols).bit_length(), 1)


def expand(code: np.ndarray, symbols: np.ndarray, bits: int) -> np.ndarray:
    """n-grams of compact numbers as n-grams of code points, 21 bits each, so
    that a key is one n-gram everywhere and keys sort by code points."""
    gram = np.zeros(len(code), np.int64)
    for j in (2, 1, 0):
        c = (code >> (j * bits)) & ((1 << bits) - 1)
        gram = (gram << 21) | np.where(c > 0, symbols[np.maximum(c - 1, 0)], 0)
    return gram


def ngrams(code: np.ndarray, doc: np.ndarray, space: int, bits: int) -> list[np.ndarray]:
    """The n-grams of 1, 2 and 3 characters that hold a letter, the text's number in front."""
    text_no = doc.astype(np.int64) << (3 * bits)
    letter = code != space
    keys = [(text_no | code)[letter]]
    for n in (2, 3):
        m = len(code) - n + 1
        if m > 0:
            key, any_letter = code[:m], letter[:m]
            for j in range(1, n):
                key = (key << bits) | code[j:j + m]
                any_letter = any_letter | letter[j:j + m]
            keys.append((text_no[:m] | key)[any_letter & (doc[:m] == doc[n - 1:])])
    return keys


def total_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts together and how often each occurs."""
    points, doc = letters(texts)
    symbols, code, bits = compact(points)
    space = int(np.searchsorted(symbols, 32)) + 1
    keys = ngrams(code, doc, space, bits)
    whole = [k & ((1 << (3 * bits)) - 1) for k in keys]
    if 3 * bits <= 22:
        n = sum(np.bincount(k, minlength=1 << (3 * bits)) for k in whole)
        found = np.flatnonzero(n)
        return expand(found, symbols, bits), n[found]
    found, n = counted(np.concatenate(whole))
    return expand(found, symbols, bits), n


def counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(key)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[new], np.diff(np.append(new, len(key)))


def ngram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all texts of ``docs`` (text, lang not null)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in held[lang]]), return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([n for _, n in held[lang]])).astype(np.int64)

        def out(lang: str) -> pa.RecordBatch:
            keys, n = merged(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["lang", "gram", "n"])

        for whole in batches:
            for b in text_slices(whole):
                names = np.array(b.column("lang").to_pylist(), object)
                texts = b.column("text").to_pylist()
                for lang in sorted(set(names)):
                    own = [texts[i] for i in np.flatnonzero(names == lang)]
                    held.setdefault(lang, []).append(total_counts(own))
                    held[lang] = [merged(lang)]
                    if len(held[lang][0][0]) > FLUSH:
                        yield out(lang)
                        del held[lang]
        for lang in held:
            yield out(lang)

    return (docs.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Each non-null lang's ``size`` most frequent n-grams, most frequent first
    (a language without any letter has none)."""
    ranked = written(ngram_counts(docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= size))
    languages = ranked.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")
    found: dict[str, list[tuple[int, int]]] = {}
    for r in ranked.collect():
        found.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(rows)], np.int64) for lang, rows in sorted(found.items())}


def distances(texts: list[str | None], grams: np.ndarray, ranks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, language) out-of-place distances and each text's number of ranked
    n-grams.  ``grams``: sorted n-grams of any profile; ``ranks``: (n-gram,
    language) ranks from 0, or -1."""
    points, doc = letters(texts)
    symbols, code, bits = compact(points)
    keys = ngrams(code, doc, int(np.searchsorted(symbols, 32)) + 1, bits)
    packed, n = counted(np.concatenate(keys))
    # most frequent first within a text, ties by the n-gram
    d = packed >> (3 * bits)
    first = np.searchsorted(d, np.arange(len(texts)))
    nth = np.arange(len(d)) - first[d]
    wide, long = int(n.max(initial=0)).bit_length(), int(nth.max(initial=0)).bit_length()
    if wide + long + len(texts).bit_length() <= 62:
        order = np.sort((d << (wide + long)) | (((1 << wide) - n) << long) | nth)
        order = first[d] + (order & ((1 << long) - 1))
    else:
        order = np.lexsort((nth, -n, d))
    top = nth < size
    packed, d, rank = packed[order[top]], d[top], nth[top]
    gram = expand(packed, symbols, bits)
    where = np.minimum(np.searchsorted(grams, gram), max(len(grams) - 1, 0))
    known = grams[where] == gram if len(grams) else np.zeros(len(gram), bool)
    total = np.zeros((len(texts), ranks.shape[1]))
    for lang in range(ranks.shape[1]):
        theirs = np.where(known, ranks[where, lang], -1) if len(grams) else np.full(len(gram), -1)
        total[:, lang] = np.bincount(d, np.where(theirs >= 0, np.abs(theirs - rank), size), len(texts))
    return total, np.bincount(d, minlength=len(texts))


def identify(docs: DataFrame, learned: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """``docs`` with lang_pred and score.

    score is 1 - distance / largest possible distance (1: ranks agree).  A
    null text, or one without a letter, is 'und' with score 0; so is every
    text if nothing was learned.  Columns of these names are replaced, all
    others and repeated rows are kept.
    """
    names = list(learned)
    grams = np.unique(np.concatenate([*learned.values(), np.zeros(0, np.int64)])) if names else np.zeros(0, np.int64)
    ranks = np.full((len(grams), len(names)), -1, np.int64)
    for j, lang in enumerate(names):
        ranks[np.searchsorted(grams, learned[lang]), j] = np.arange(len(learned[lang]))
    shared = docs.sparkSession.sparkContext.broadcast((names, grams, ranks))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        names, grams, ranks = shared.value
        pred: list[str] = []
        score: list[float] = []
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            total, n = distances(part.column("text").to_pylist(), grams, ranks, size)
            best = total.argmin(axis=1) if names else np.zeros(len(part), int)
            for i in range(len(part)):
                known = n[i] > 0 and names
                pred.append(names[best[i]] if known else UNKNOWN)
                score.append(1 - total[i, best[i]] / (n[i] * size) if known else 0.0)
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    out = docs.drop("lang_pred", "score").withColumn("_predicted", predict(F.col("text")))
    return out.select(*[c for c in out.columns if c != "_predicted"], "_predicted.lang_pred", "_predicted.score")


def held_out(doc_id: F.Column) -> F.Column:
    return fold(doc_id, 4) == 2
