"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digits and signs that stand for letters)
and an Aho-Corasick automaton finds the lexicon's terms, words and stems of
words, in one pass, whatever their number.  A term that lies within an
exception phrase ("trash can") does not count.  The score is a logistic
function of the largest weight found and of the found weight per word.

Terms, weights and exceptions are learned from labelled rows: a word's weight is the
logarithm of its odds among toxic against other documents.  A word counts once
per document, and once per pair of neighbouring words over all documents, so
that copies of one document don't make its words look toxic.  The first
letters that several such words share are judged together, as a stem.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmx.llm.common import fold, only_ids, text_slices, written

SAMPLE_ROWS = 50_000       # labelled rows that are learned from at most
MIN_EVIDENCE = 3.0         # standard deviations by which a term's toxic share must exceed a half
STEMS, STEM_WORDS = range(4, 9), 3      # letters of a stem; words that must share it
MIN_LETTERS = 2            # of a word that may be a term; single letters are no words
FLAG_AT = 0.3

# fixed values: letters that look like Latin ones, and signs written for letters
HOMOGLYPHS = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
              "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ɡ": "g", "ı": "i", "ο": "o", "α": "a",
              "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\S+")
# from the begin of a run on, so that a run is looked at once whatever its length
_MIXED = re.compile(r"(?<![A-Za-z0-9@$!|])(?:[A-Za-z]++[0-9@$!|]|[0-9@$!|]++[A-Za-z])[A-Za-z0-9@$!|]*+")
PHRASE_REACH = 80          # characters around a term that its neighbouring words are looked for in
_BEFORE = re.compile(r"([^\W\d_]*)[\W\d_]*?(?<![^\W\d_])([^\W\d_]+) $")
_AFTER = re.compile(r" ([^\W\d_]+)[\W\d_]*([^\W\d_]*)")


def _fold_char(c: int) -> str:
    ch = chr(c)
    base = unicodedata.normalize("NFKC", ch).lower()
    base = HOMOGLYPHS.get(base, base)
    return base if len(base) == 1 else ch


class _FoldTable(dict):
    def __missing__(self, c: int) -> str:
        self[c] = out = _fold_char(c)
        return out


_TABLE = _FoldTable()


def fold_text(text: str) -> str:
    """Lower case, look-alike letters as Latin ones, and in words that mix
    letters with digits or signs (but for trailing ones) the letters these
    stand for.  Zero-width characters go."""
    if not text.isascii():
        text = text.replace("​", "").replace("‍", "").replace("­", "").translate(_TABLE)
    return _MIXED.sub(_letters, text).lower()


def _letters(found: re.Match) -> str:
    word = found.group()
    core = word.rstrip("!|$@")
    if core.isalpha():                        # only trailing signs: punctuation
        return word
    return "".join(DIGITS.get(c, c) for c in core) + word[len(core):]


@dataclass
class Lexicon:
    """Folded terms with weights (a stem ends with *), exception phrases, and the score's coefficients."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = ()
    intercept: float = -3.0
    found: float = 0.5
    density: float = 0.5
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def matcher(self):
        if self._automaton is None:
            import ahocorasick

            auto = ahocorasick.Automaton()
            for phrase in self.exceptions:
                auto.add_word(fold_text(phrase), (0.0, len(fold_text(phrase)), False, True))
            for term, weight in self.terms.items():
                stem = term.rstrip("*")
                auto.add_word(stem, (weight, len(stem), stem != term, False))
            auto.make_automaton()
            self._automaton = auto
        return self._automaton

    def weights_of(self, folded: str) -> list[float]:
        """The weights of the terms in a folded text."""
        return [h[2] for h in self.hits(folded)] if self.terms else []

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(begin, end, weight) of the terms in a folded text that no exception phrase covers."""
        hits: list[tuple[int, int, float]] = []
        excused: list[tuple[int, int]] = []
        for last, (weight, length, is_stem, is_exception) in self.matcher().iter(folded):
            first, end = last - length + 1, last + 1
            if (first and folded[first - 1].isalnum()) or (not is_stem and end < len(folded) and folded[end].isalnum()):
                continue
            if is_exception:
                excused.append((first, end))
            else:
                hits.append((first, end, weight))
        if not excused:
            return hits
        excused.sort()
        begins = [a for a, _ in excused]
        reach = list(accumulate((b for _, b in excused), max))         # the furthest end of the phrases that begin no later
        return [(a, b, w) for a, b, w in hits if not (i := bisect_right(begins, a)) or reach[i - 1] < b]

    def features(self, text: str | None) -> tuple[float, float, int]:
        """(largest weight found, log of 1 + weight per 100 words, number found)."""
        weights = self.weights_of(fold_text(text)) if text else []
        if not weights:
            return 0.0, 0.0, 0
        return max(weights), math.log1p(100 * sum(weights) / (text.count(" ") + text.count("\n") + 1)), len(weights)

    def score(self, text: str | None) -> tuple[float, int]:
        largest, density, n = self.features(text)
        return 1 / (1 + math.exp(-(self.intercept + self.found * largest + self.density * density))), n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: F.Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, ``label`` of the labelled rows outside ``held_out``: all of
    them up to ``rows``, else the ``rows`` with the smallest hash of the id."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out)
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias(label))
             .groupBy("doc_id").agg(F.max(label).alias(label)))
    chosen = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return only_ids(own, chosen).join(F.broadcast(chosen), "doc_id")


def word_evidence(sample: DataFrame, label: str) -> DataFrame:
    """word, n, n_toxic: in how many different neighbourhoods each folded word
    of MIN_LETTERS or more stands, one a document, and how many are toxic."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                words: list[str] = []
                around: list[int] = []
                toxic: list[int] = []
                for text, flag in zip(b.column("text").to_pylist(), b.column(label).to_pylist()):
                    own = _WORD.findall(fold_text(text or ""))
                    first: dict[str, int] = {}
                    for i, w in enumerate(own):
                        if len(w) >= MIN_LETTERS and w not in first:
                            first[w] = i
                    for w, i in first.items():
                        words.append(w)
                        around.append(xxhash.xxh3_64_intdigest(" ".join(own[max(0, i - 1):i] + ["|"] + own[i + 1:i + 2])) >> 1)
                        toxic.append(flag)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(around, pa.int64()), pa.array(toxic, pa.int32())], ["word", "around", "toxic"])

    places = sample.select("text", F.col(label)).mapInArrow(emit, "word string, around long, toxic int")
    return (places.groupBy("word", "around").agg(F.avg("toxic").alias("t"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("n_toxic")))


def learn(docs: DataFrame, labels: DataFrame, held_out: F.Column, label: str = "toxic", rows: int = SAMPLE_ROWS,
          exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Lexicon, exception phrases and score coefficients from a bounded sample of labelled rows.

    A word is a term if the lower confidence bound of its toxic share is over
    a half, and a term with a neighbouring word an exception ("trash can") if
    that of the phrase's clean share is; ``exceptions`` adds phrases to those
    learned.  Without labels of both kinds the lexicon is empty.
    """
    sample = written(labelled_sample(docs, labels, label, held_out, rows))
    n_all = sample.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("t")).collect()[0]
    total, toxic = n_all["n"], n_all["t"] or 0
    lexicon = Lexicon({}, exceptions)
    if not toxic or toxic == total:
        return lexicon
    base = math.log(toxic / (total - toxic))
    lexicon.terms = _terms(written(word_evidence(sample, label)), base)
    lexicon.exceptions = tuple(sorted({*exceptions, *_exceptions(phrase_evidence(sample, label, lexicon))}))
    # coefficients: logistic regression over counts of rows by rounded features
    counts = (sample.select(measure(lexicon)(F.col("text")).alias("m"), F.col(label))
              .groupBy(F.round("m.largest", 2).alias("largest"), F.round("m.density", 1).alias("density")).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("t")).collect())
    if lexicon.terms:
        x = np.array([[1.0, r["largest"], r["density"]] for r in counts])
        n, t = np.array([r["n"] for r in counts], float), np.array([r["t"] for r in counts], float)
        lexicon.intercept, lexicon.found, lexicon.density = _logistic(x, n, t)
    else:
        lexicon.intercept, lexicon.found, lexicon.density = base, 0.0, 0.0
    return lexicon


def _terms(words: DataFrame, base: float) -> dict[str, float]:
    """Stems and words whose toxic share has a lower confidence bound over a
    half; of stems within each other the one with the highest bound, of words
    those without a stem.  A term takes at least MIN_EVIDENCE ** 2 toxic places in
    the bounded sample, which bounds how many there are."""
    z2 = MIN_EVIDENCE ** 2
    share = (F.col("n_toxic") + z2 / 2) / (F.col("n") + z2)
    spread = MIN_EVIDENCE * F.sqrt(F.col("n_toxic") * (F.col("n") - F.col("n_toxic")) / F.col("n") + z2 / 4) / (F.col("n") + z2)
    stems = (words.where(F.length("word") > STEMS[0])
             .select(F.explode(F.array(*[F.when(F.length("word") > k, F.substring("word", 1, k)) for k in STEMS])).alias("word"), "n", "n_toxic")
             .where(F.col("word").isNotNull())
             .groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"), F.sum((F.col("n_toxic") * 2 > F.col("n")).cast("int")).alias("of"))
             .where(F.col("of") >= STEM_WORDS))
    found: dict[str, float] = {}
    begun: set[str] = set()          # beginnings of the stems found
    for rows, mark in ((stems, "*"), (words, "")):
        for r in (rows.withColumn("low", F.round(share - spread, 9)).where(F.col("low") >= 0.5)
                  .orderBy(F.desc("low"), F.length("word"), "word").collect()):
            word = r["word"]
            inside = any(word[:k] + "*" in found for k in STEMS if k <= len(word))
            if not inside and not (mark and word in begun):
                begun.update(word[:k] for k in range(1, len(word) + 1) if mark)
                found[word + mark] = math.log((r["n_toxic"] + 0.5) / (r["n"] - r["n_toxic"] + 0.5)) - base
    return found


def phrase_evidence(sample: DataFrame, label: str, lexicon: Lexicon) -> DataFrame:
    """phrase, n, n_toxic of each term found with the word before or after it
    (one blank between): in how many neighbourhoods, one a document, and how
    many are toxic."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                rows: list[tuple[str, int, int]] = []
                for text, flag in zip(b.column("text").to_pylist(), b.column(label).to_pylist()):
                    folded = fold_text(text or "")
                    seen: set[str] = set()
                    for first, end, _ in shared.value.hits(folded) if shared.value.terms else ():
                        while end < len(folded) and folded[end].isalpha():           # a stem: to the end of its word
                            end += 1
                        before, after = _BEFORE.search(folded[max(0, first - PHRASE_REACH):first]), _AFTER.match(folded[end:end + PHRASE_REACH])
                        term = folded[first:end]
                        phrases = [(f"{before[2]} {term}", before[1])] if before else []
                        phrases += [(f"{term} {after[1]}", after[2])] if after else []
                        for phrase, side in phrases:
                            if phrase not in seen:
                                seen.add(phrase)
                                rows.append((phrase, xxhash.xxh3_64_intdigest(side) >> 1, flag))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())],
                                                 ["phrase", "around", "toxic"])

    places = sample.select("text", F.col(label)).mapInArrow(emit, "phrase string, around long, toxic int")
    return (places.groupBy("phrase", "around").agg(F.avg("toxic").alias("t"))
            .groupBy("phrase").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("n_toxic")))


def _exceptions(phrases: DataFrame) -> list[str]:
    """Phrases whose clean share has a lower confidence bound over a half."""
    z2, clean = MIN_EVIDENCE ** 2, F.col("n") - F.col("n_toxic")
    low = (clean + z2 / 2 - MIN_EVIDENCE * F.sqrt(clean * F.col("n_toxic") / F.col("n") + z2 / 4)) / (F.col("n") + z2)
    return [r["phrase"] for r in phrases.where(F.round(low, 9) >= 0.5).collect()]


def _logistic(x: np.ndarray, n: np.ndarray, t: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Ridge logistic regression of t of n by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (t - n * p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def measure(lexicon: Lexicon):
    @F.arrow_udf("struct<largest: double, density: double>")
    def measured(texts: pa.Array) -> pa.Array:
        rows = [lexicon.features(t) for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"])) for t in part.column("text").to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[j] for r in rows], pa.float64()) for j in (0, 1)], ["largest", "density"])
    return measured


def score_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with score (0 to 1) and n_terms; a null or empty text has the
    score of a text without terms.  Columns of these names are replaced, all
    others and repeated rows are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("struct<score: double, n_terms: long>")
    def scored(texts: pa.Array) -> pa.Array:
        score: list[float] = []
        n: list[int] = []
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            for text in part.column("text").to_pylist():
                s, k = shared.value.score(text)
                score.append(s)
                n.append(k)
        return pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(n, pa.int64())], ["score", "n_terms"])

    out = docs.drop("score", "n_terms").withColumn("_scored", scored(F.col("text")))
    return out.select(*[c for c in out.columns if c != "_scored"], "_scored.score", "_scored.n_terms")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, flag_at: float = FLAG_AT) -> DataFrame:
    """``docs`` without the rows that score ``flag_at`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("boolean")
    def is_clean(texts: pa.Array) -> pa.Array:
        parts = text_slices(pa.RecordBatch.from_arrays([texts], ["text"]))
        return pa.array([shared.value.score(t)[0] < flag_at for part in parts for t in part.column("text").to_pylist()], pa.bool_())

    return docs.where(is_clean(F.col("text")))


def held_out(doc_id: F.Column) -> F.Column:
    return fold(doc_id, 4) == 2
