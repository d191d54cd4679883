"""Recall of near-duplicate classes and of decontamination against brute force:
all rows whose id is divisible by 20 against all rows (or all items).

usage: python tests/llm/measure_recall.py [sf_dir]
"""

import os
import re
import sys
from collections import Counter, defaultdict

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def shingles(text, k=5):
    words = re.findall(r"\w+", (text or "").lower())
    return [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []


def weight(n):
    return 1 + np.log(n) if n else 0.0


def near_pairs(texts, threshold=0.8):
    """(query, other) pairs of exact weighted similarity, by an inverted list of shingles."""
    sets = {i: Counter(shingles(t)) for i, t in texts.items()}
    total = {i: sum(weight(n) for n in c.values()) for i, c in sets.items()}
    where = defaultdict(list)
    for i, c in sets.items():
        for s in c:
            where[s].append(i)
    for q in (i for i in texts if i % 20 == 0):
        shared = defaultdict(float)
        for s, n in sets[q].items():
            for o in where[s]:
                if o != q:
                    shared[o] += weight(min(n, sets[o][s]))
        for o, both in shared.items():
            if both >= threshold * (total[q] + total[o] - both) - 1e-9:
                yield q, o


def leaks(texts, items, threshold=0.8):
    """(query, item) pairs of which some window as long as the item is that similar, by rarity among the items."""
    own = {i: shingles(t) for i, t in items.items() if re.search(r"\w", t or "")}
    df = Counter(s for c in own.values() for s in set(c))
    rare = lambda s: np.log1p(len(own) / max(df.get(s, 1), 1))
    where = defaultdict(set)
    for i, c in own.items():
        for s in c:
            where[s].add(i)
    for q, text in texts.items():
        if q % 20:
            continue
        all_ = shingles(text)
        for i in {i for s in all_ for i in where.get(s, ())}:
            span = min(len(own[i]), len(all_))
            item = Counter(own[i])
            whole = sum(n * rare(s) for s, n in item.items())
            hit = [p for p, s in enumerate(all_) if s in item]
            starts = {p for h in hit for p in range(max(0, h - span + 1), min(h, len(all_) - span) + 1)}
            for p in starts:
                window = Counter(all_[p:p + span])
                both = sum(min(n, item[s]) * rare(s) for s, n in window.items() if s in item)
                if both >= threshold * (whole + sum(n * rare(s) for s, n in window.items()) - both) - 1e-9:
                    yield q, i
                    break


def main():
    from pyspark.sql import SparkSession

    from cohortmx.llm import dart_minhash, decontaminate
    from cohortmx.llm.common import documents, table

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    docs, bench = documents(spark, sf), table(spark, sf, "benchmark")
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    classes = {r["doc_id"]: r["class_id"] for r in dart_minhash.near_duplicates(docs).collect()}
    want = list(near_pairs(texts))
    print("near duplicates: pairs", len(want), "in one class", sum(classes[a] == classes[b] for a, b in want))
    want = set(leaks(texts, {r["item_id"]: r["text"] for r in bench.collect()}))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contamination(docs, bench).collect() if r["doc_id"] % 20 == 0}
    print("leaks: pairs", len(want), "found", len(want & got), "others found", len(got - want))


if __name__ == "__main__":
    main()
