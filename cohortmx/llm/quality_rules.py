"""Quality classifier: a sparse rule ensemble.

Statistics of the whole text feed shallow random-forest trees; every path from
a root is a rule, the conjunction of its conditions.  A lasso logistic
regression over the rules keeps few of them, and these are compiled into one
Spark column expression over the statistics.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmx.llm.common import fold, text_slices, utf8, word_hashes, written
from cohortmx.llm.toxicity import labelled_sample

SAMPLE_ROWS = 20_000       # labelled rows that are learned from at most
TREES, DEPTH = 20, 3
LASSO = 0.002
GOOD_AT = 0.3

STATISTICS = ["n_words", "word_length", "upper", "digits", "signs", "spaces", "lines", "pipes", "repeated_word",
              "distinct_words", "distinct_lines", "short_words"]
_SCHEMA = "struct<" + ", ".join(f"{name}: double" for name in STATISTICS) + ">"


def text_statistics(texts: pa.Array) -> pa.StructArray:
    """STATISTICS of each text (null: empty): its number of words (log) and
    their mean bytes; shares of its bytes that are upper-case letters, digits,
    signs, white space, line ends and bars; shares of its words that repeat
    the word before, that are distinct, that have one or two bytes; share of
    lines that are distinct.  Shares of nothing are 0."""
    raw, ends = utf8(texts)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    size = np.maximum(ends - starts, 1)

    def per_text(flag: np.ndarray, marks: np.ndarray = ends) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag)])
        return sums[marks] - sums[np.concatenate([[0], marks[:-1]])] if len(marks) else np.zeros(0)

    upper = (raw >= 65) & (raw <= 90)
    upper[:-1] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    letter = (raw >= 128) | ((raw | 32) >= 97) & ((raw | 32) <= 122)
    digit, white, line = (raw >= 48) & (raw <= 57), (raw == 32) | (raw == 10), raw == 10
    hashes, word_ends = word_hashes(texts)
    n_words = np.diff(word_ends, prepend=0)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    some = np.maximum(n_words, 1)
    distinct_lines = []
    for t in texts.to_pylist():
        rows = (t or "").split("\n")
        distinct_lines.append(len(set(rows)) / len(rows))
    short = pc.count_substring_regex(pc.fill_null(texts, ""), r"\b\w{1,2}\b").to_numpy(zero_copy_only=False)
    columns = [np.log1p(n_words), per_text(letter | digit) / some, per_text(upper) / size, per_text(digit) / size,
               per_text(~(letter | digit | white)) / size, per_text(white) / size, per_text(line) / size, per_text(raw == 124) / size,
               per_text(again, word_ends) / some, np.bincount(d, fresh, len(n_words)) / some, np.array(distinct_lines), short / some]
    return pa.StructArray.from_arrays([pa.array(np.asarray(c, np.float64)) for c in columns], STATISTICS)


def statistics(text: F.Column) -> F.Column:
    @F.arrow_udf(_SCHEMA)
    def of_texts(texts: pa.Array) -> pa.Array:
        parts = [text_statistics(b.column("text")) for b in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]))]
        return pa.concat_arrays(parts) if parts else text_statistics(pa.array([], pa.string()))

    return of_texts(text)


Condition = tuple[str, bool, float]        # statistic, whether it is at most the value, value


def rules_of(model) -> list[tuple[Condition, ...]]:
    """The distinct paths of all trees of a forest, each as its conditions."""
    found: dict[tuple[Condition, ...], None] = {}
    line = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    for tree in model.trees:
        path: list[tuple[int, Condition]] = []
        for text in tree.toDebugString.splitlines():
            m = line.match(text)
            if m:
                depth = len(m[1])
                path = [p for p in path if p[0] < depth]
                path.append((depth, (STATISTICS[int(m[3])], m[4] == "<=", float(m[5]))))
                found.setdefault(tuple(sorted({c for _, c in path})))
    return list(found)


def rule_column(rule: tuple[Condition, ...], prefix: str = "") -> F.Column:
    """The rule as a Spark column: 1.0 where all its conditions hold, else 0.0."""
    out = F.lit(True)
    for name, below, value in rule:
        out = out & ((F.col(prefix + name) <= value) if below else (F.col(prefix + name) > value))
    return out.cast("double")


def learn(docs: DataFrame, labels: DataFrame, held_out: F.Column, label: str = "quality", rows: int = SAMPLE_ROWS,
          trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 7) -> tuple[float, list[tuple[float, tuple[Condition, ...]]]]:
    """(intercept, [(weight, rule), ...]) from a bounded sample of labelled
    rows.  Without labels of both kinds no rule is kept, and the intercept is
    that of the only kind (no labels: 0)."""
    sample = written(labelled_sample(docs, labels, label, held_out, rows)
                     .select(statistics(F.col("text")).alias("s"), F.col(label).cast("double").alias("label"))
                     .select("s.*", "label"))
    n, ones = sample.agg(F.count(F.lit(1)), F.sum("label")).collect()[0]
    if not n or ones in (0, n):
        return (math.log((ones + 0.5) / (n - ones + 0.5)) if n else 0.0), []
    data = sample.select(array_to_vector(F.array(*STATISTICS)).alias("features"), "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", maxBins=64).fit(data)
    rules = rules_of(forest)
    if not rules:
        return math.log(ones / (n - ones)), []
    hits = written(sample.select(array_to_vector(F.array(*[rule_column(r) for r in rules])).alias("features"), "label"))
    fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=200).fit(hits)
    return float(fit.intercept), [(float(w), r) for w, r in zip(fit.coefficients.toArray(), rules) if w != 0.0]


def score_column(model: tuple[float, list[tuple[float, tuple[Condition, ...]]]], prefix: str = "") -> F.Column:
    """The whole ensemble as one Spark column."""
    total = F.lit(model[0])
    for weight, rule in model[1]:
        total = total + F.lit(weight) * rule_column(rule, prefix)
    return 1 / (1 + F.exp(-total))


def score_texts(docs: DataFrame, model: tuple[float, list[tuple[float, tuple[Condition, ...]]]]) -> DataFrame:
    """``docs`` with score (0 to 1, higher: better).  Null texts count as
    empty; a column of this name is replaced, all others and repeated rows are kept."""
    stats = docs.drop("score").withColumn("_stats", statistics(F.col("text")))
    return stats.withColumn("score", score_column(model, "_stats.")).drop("_stats")


def held_out(doc_id: F.Column) -> F.Column:
    return fold(doc_id, 5) == 0
