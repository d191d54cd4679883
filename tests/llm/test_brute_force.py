"""Rule ensemble, toxic lexicon, winnowing and language profiles against plain Python."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortmx.llm import language_id, quality_rules, toxicity, winnowing

from .conftest import prose

# ------------------------------------------------------------------ op2

TEXTS = ["", "one", "Two two TWO words, words", "a | b | c\na | b\na | b", "  \n\n ", "x1 22 333 !!", "Ünï Ärger straße 42%", prose(3, 200) + "\n" + prose(4, 50), "A" * 300]


def statistics_by_hand(text):
    raw = text.encode()
    words = re.findall(r"\w+", text.lower())
    some, size = max(len(words), 1), max(len(raw), 1)
    lines = text.split("\n")
    upper = sum(c.isascii() and c.isupper() or "À" <= c <= "Þ" and c != "×" for c in text)
    # letters count by bytes beyond ASCII, as signs and blanks do
    letters = sum(b >= 128 or chr(b).isalpha() for b in raw)
    digits = sum(48 <= b <= 57 for b in raw)
    white = sum(b in (32, 10) for b in raw)
    return {"n_words": math.log1p(len(words)), "word_length": (letters + digits) / some, "upper": upper / size, "digits": digits / size,
            "signs": (len(raw) - letters - digits - white) / size, "spaces": white / size, "lines": raw.count(10) / size, "pipes": raw.count(124) / size,
            "repeated_word": sum(a == b for a, b in zip(words, words[1:])) / some, "distinct_words": len(set(words)) / some,
            "distinct_lines": len(set(lines)) / len(lines), "short_words": len(re.findall(r"\b\w{1,2}\b", text, re.A)) / some}


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_by_hand(text):
    got = quality_rules.text_statistics(pa.array([text, None])).to_pylist()
    want = statistics_by_hand(text)
    if not text.isascii():
        want.pop("short_words")      # counted by the pattern's own idea of a word
        got[0].pop("short_words")
    assert got[0] == pytest.approx(want, abs=1e-12)
    assert got[1] == quality_rules.text_statistics(pa.array([""])).to_pylist()[0]


def holds(rule, stats):
    return all((stats[n] <= v) if below else (stats[n] > v) for n, below, v in rule)


def test_rules_are_the_paths_and_scores_their_sum(spark, make_docs):
    rng = random.Random(5)
    texts = [prose(i, 20 + i % 60) if rng.random() < 0.5 else (prose(i, 30).upper() + " | " * (i % 9)) + "9 " * (i % 5) for i in range(200)]
    stats = quality_rules.text_statistics(pa.array(texts)).to_pylist()
    flags = [float(s["upper"] < 0.3 or s["pipes"] > 0.02) for s in stats]
    flags = [1 - f if rng.random() < 0.1 else f for f in flags]
    data = spark.createDataFrame([([s[n] for n in quality_rules.STATISTICS], f) for s, f in zip(stats, flags)], "a array<double>, label double")
    forest = RandomForestClassifier(numTrees=6, maxDepth=3, seed=1).fit(data.select(array_to_vector("a").alias("features"), "label"))

    def paths(node, path):
        if node.getClass().getSimpleName() != "InternalNode":
            return []
        split = node.split()
        name, value = quality_rules.STATISTICS[split.featureIndex()], split.threshold()
        left, right = [*path, (name, True, value)], [*path, (name, False, value)]
        return [left, right, *paths(node.leftChild(), left), *paths(node.rightChild(), right)]

    def rounded(rule):
        return tuple(sorted({(n, b, round(v, 9)) for n, b, v in rule}))

    want = {rounded(p) for tree in forest.trees for p in paths(tree._call_java("rootNode"), [])}
    rules = quality_rules.rules_of(forest)
    assert {rounded(r) for r in rules} == want and len(rules) == len(want)

    docs = make_docs(list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(f)) for i, f in enumerate(flags)], "doc_id long, quality int")
    model = quality_rules.learn(docs, labels, F.lit(False))
    assert model[1]
    got = {r.doc_id: r.score for r in quality_rules.score_texts(docs, model).collect()}
    for i, s in enumerate(stats):
        total = model[0] + sum(w for w, rule in model[1] if holds(rule, s))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


# ------------------------------------------------------------------ op3

def hits_by_hand(folded, terms, exceptions):
    covered = [(m.start(), m.start() + len(e)) for e in exceptions for m in re.finditer(f"(?={re.escape(e)})", folded)
               if not (m.start() and folded[m.start() - 1].isalnum()) and not folded[m.start() + len(e):m.start() + len(e) + 1].isalnum()]
    out = []
    for term, weight in terms.items():
        stem = term.rstrip("*")
        for m in re.finditer(f"(?={re.escape(stem)})", folded):
            a, b = m.start(), m.start() + len(stem)
            if (a and folded[a - 1].isalnum()) or (stem == term and folded[b:b + 1].isalnum()) or any(x <= a and b <= y for x, y in covered):
                continue
            out.append((a, b, weight))
    return sorted(out)


def test_matcher_by_hand():
    rng = random.Random(2)
    terms = {"bad": 1.0, "badly": 2.0, "ugl*": 3.0, "not bad": 0.5, "é": 0.25}
    exceptions = ("so bad it is good", "ugly duckling", "bad hair")
    lexicon = toxicity.Lexicon(terms, exceptions)
    words = ["bad", "badly", "ugly", "uglier", "duckling", "not", "so", "it", "is", "good", "hair", "xbad", "bad1", "é", "ok", "!", "-"]
    for _ in range(500):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "", ", "]) for _ in range(rng.randrange(16)))
        assert sorted(lexicon.hits(text)) == hits_by_hand(text, terms, exceptions), text


def folded_by_hand(text):
    import unicodedata

    out = ""
    for c in text:
        if c not in "​‍­":
            low = c if c.isascii() else unicodedata.normalize("NFKC", c).lower()
            low = toxicity.HOMOGLYPHS.get(low, low)
            out += low if len(low) == 1 else c

    def word(m):
        w = m[0]
        core = w.rstrip("!|$@")
        mixed = re.search("[A-Za-z]", w) and re.search("[0-9@$!|]", w)
        return "".join(toxicity.DIGITS.get(c, c) for c in core) + w[len(core):] if mixed and not core.isalpha() else w

    return re.sub(r"[A-Za-z0-9@$!|]+", word, out).lower()


def test_folding_by_hand():
    rng = random.Random(3)
    signs = list("aZ0134578@$!|9 .-é") + ["ІD", "о", "ß", "​", "ﬁ", "日", "ı"]
    for _ in range(2000):
        text = "".join(rng.choices(signs, k=rng.randrange(14)))
        assert toxicity.fold_text(text) == folded_by_hand(text), repr(text)


def test_evidence_and_terms_by_hand(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        flag = int(i % 3 == 0)
        words = [rng.choice(["alpha", "beta", "gamma", "of", "x", "delta"]) for _ in range(12)]
        if flag or rng.random() < 0.05:
            words.insert(rng.randrange(12), rng.choice(["vequation", "vequible", "vequous", "moron", "dolt"]))
        rows.append((" ".join(words), flag))
    rows += rows[:3] * 50           # copies show a word in no more places
    sample = spark.createDataFrame(rows, "text string, toxic int").repartition(4)
    places = {}
    for text, flag in rows:
        words = text.split()
        for w in set(words):
            if len(w) >= toxicity.MIN_LETTERS:
                i = words.index(w)
                places.setdefault((w, words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None), []).append(flag)
    want = {}
    for (w, *_), flags in places.items():
        n, t = want.get(w, (0, 0.0))
        want[w] = n + 1, t + sum(flags) / len(flags)
    evidence = toxicity.word_evidence(sample, "toxic")
    got = {r.word: (r.n, r.n_toxic) for r in evidence.collect()}
    assert got.keys() == want.keys()
    for w in want:
        assert got[w] == pytest.approx(want[w], abs=1e-9), w

    def low(n, t, z=toxicity.MIN_EVIDENCE):
        return (t + z * z / 2 - z * math.sqrt(t * (n - t) / n + z * z / 4)) / (n + z * z)

    terms = toxicity._terms(evidence, 0.0)
    stems = collections.defaultdict(list)
    for w, (n, t) in want.items():
        for k in toxicity.STEMS:
            if len(w) > k:
                stems[w[:k]].append((n, t))
    good = {s: low(sum(n for n, _ in v), sum(t for _, t in v)) for s, v in stems.items() if sum(2 * t > n for n, t in v) >= toxicity.STEM_WORDS}
    good = {s: b for s, b in good.items() if b >= 0.5}
    assert any(s.startswith("vequ") for s in good)
    chosen = [t.rstrip("*") for t in terms if t.endswith("*")]
    assert chosen and max(good, key=lambda s: (round(good[s], 9), -len(s))) in chosen
    assert not any(a != b and a.startswith(b) for a in chosen for b in chosen)
    for w, (n, t) in want.items():
        assert (w in terms) == (low(n, t) >= 0.5 and not any(w.startswith(c) for c in chosen)), w


# ------------------------------------------------------------------ op5

def chosen_by_hand(packed, window):
    """(hash, position) pairs: of each full window the smallest hash, the rightmost of equal ones."""
    if not packed:
        return []
    pairs = [(h, i) for i, h in enumerate(packed)]
    windows = [pairs[i:i + window] for i in range(len(pairs) - window + 1)] or [pairs]
    out = []
    for w in windows:
        best = min(w, key=lambda p: (p[0], -p[1]))
        if best not in out:
            out.append(best)
    return out


def test_winnowing_by_hand_with_ties(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in (0, 1, 4, 5, 6, 12, 13, 40, 200)] + ["la " * 60, prose(1, 120), None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    hashed = rows.withColumn("_h", F.transform(winnowing.words(F.col("text")), lambda w: F.xxhash64(w)))
    raw = {r.doc_id: r.g for r in hashed.select("doc_id", winnowing.grams(F.col("_h")).alias("g")).collect()}
    for r in winnowing.fingerprints(rows).collect():
        hashes = [g >> 31 for g in raw[r.doc_id]]
        assert all(0 <= h < 1 << 32 for h in hashes)
        assert [winnowing.LAST - (g & winnowing.LAST) for g in raw[r.doc_id]] == list(range(len(hashes)))
        assert list(zip(r.hashes, r.positions)) == chosen_by_hand(hashes, winnowing.WINDOW), texts[r.doc_id]
        n = len((texts[r.doc_id] or "").split())
        assert len(hashes) == (max(1, n - winnowing.GRAM + 1) if n else 0)
    ties = next(r for r in winnowing.fingerprints(rows).collect() if texts[r.doc_id] == "la " * 60)
    assert len(set(ties.hashes)) == 1 and ties.positions == list(range(7, 56))       # always the rightmost


def test_edited_and_next_by_hand(spark):
    texts = [prose(i, 30 + 7 * i) for i in range(12)] + [None, "", "äé" * 9, prose(3, 51)]
    rows = [(3 * i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in winnowing.edited_pairs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    own = [t or "" for t in texts]
    edited = [t[:len(t) - len(t) // 4] + own[(i + 1) % len(own)][:len(t) // 4] for i, t in enumerate(own)]
    prints = {r.doc_id: r.hashes for r in winnowing.fingerprints(spark.createDataFrame(
        [(i, t) for i, t in enumerate(own)] + [(100 + i, t) for i, t in enumerate(edited)], "doc_id long, text string")).collect()}

    def likeness(a, b):
        a, b = set(a), set(b)
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, t in enumerate(own):
        r = got[3 * i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(prints[i], prints[100 + i]))
        assert r.near_next == pytest.approx(likeness(prints[i], prints[(i + 1) % len(own)]))
        parts = [p.split(":") for p in r.fingerprint.split(",") if p]
        assert [int(h, 16) for h, _ in parts] == list(prints[i]) if len(set(prints[i])) == len(prints[i]) else True
        assert [int(p) for _, p in parts] == sorted(int(p) for _, p in parts)


# ------------------------------------------------------------------ op10

def test_profiles_are_ranked_counts(spark):
    texts = {"x": [prose(1, 80), "Été 12 ÉTÉ", None], "y": [prose(2, 90), "日本 日本語", "aa"], None: ["zzz"], "empty": ["12 !"]}
    rows = [(t, lang) for lang, own in texts.items() for t in own]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = language_id.profiles(docs, 60)
    want = {}
    for lang in ("x", "y"):
        grams = collections.Counter()
        for t in texts[lang]:
            s = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in f" {t or ''} ")
            s = re.sub(" +", " ", s)
            grams.update(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n].strip())
        code = {g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g)) for g in grams}
        want[lang] = [code[g] for g in sorted(grams, key=lambda g: (-grams[g], code[g]))][:60]
        counts = {r.gram: r.n for r in language_id.ngram_counts(docs.where(F.col("lang") == lang)).collect()}
        assert counts == {code[g]: n for g, n in grams.items()}
    assert {k: v.tolist() for k, v in got.items()} == want
    assert np.array_equal(language_id.profiles(docs.repartition(1), 60)["x"], got["x"])


# ------------------------------------------------------------------ op8

@pytest.mark.parametrize("shards", [1, 2, 16, 32, 200])
def test_jumps_by_hand(spark, shards):
    """3,000 keys: the last jump below the number of shards, from the same draws."""
    from cohortmx.llm import jump_shards

    steps = 60
    keys = spark.range(3000).select((F.col("id") * 7919 - 5000).alias("doc_id"))
    drawn = keys.select("doc_id", F.array(*[F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(i)), 33) + 1 for i in range(1, steps + 1)]).alias("draws"),
                        jump_shards.jump(F.col("doc_id"), shards).alias("jump"), jump_shards.jump(F.col("doc_id"), shards + 1)["b"].alias("more")).collect()
    counts = collections.Counter()
    for r in drawn:
        b, j = -1, 0
        for draw in r.draws:
            if j >= shards:
                break
            b, j = j, math.floor((j + 1) * ((1 << 31) / draw))
        assert j >= shards and (r.jump["b"], r.jump["j"]) == (b, j)
        assert r.more == (shards if j == shards else b)          # one shard more takes only what comes to it
        counts[b] += 1
    assert len(counts) == shards and max(counts.values()) < 2 * 3000 / shards + 30
