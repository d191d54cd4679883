import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cohortmx.llm import dart_minhash, decontaminate
from cohortmx.llm.common import shingles, word_hashes
from cohortmx.llm.components import components

from .conftest import WORDS, prose


def bag(text):
    w = re.findall(r"\w+", (text or "").lower())
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def weighted_jaccard(a, b):
    """Shingles that occur n times weigh 1 + ln(n)."""
    most = sum(1 + np.log(n) for n in (a | b).values())
    return sum(1 + np.log(n) for n in (a & b).values()) / most if most else 0.0


def changed(text, n, seed):
    rng = random.Random(seed)
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = rng.choice(WORDS)
    return " ".join(w)


def family_rows():
    """Copies, near copies of several strengths, a chain, texts with repeats and lone texts."""
    rows, n = [], 100
    for base in range(12):
        text = prose(base, 220)
        rows += [(n + i, changed(text, k, 7 * base + i)) for i, k in enumerate((0, 0, 1, 2, 4, 5, 6, 8, 12))]
        n += 20
    chain = prose(77, 200).split()
    for i in range(12):
        rows.append((n + i, " ".join(chain)))
        chain[i * 15:i * 15 + 3] = ["x%d" % i, "y%d" % i, "z%d" % i]
    n += 20
    rows += [(n + i, "la " * (30 + i)) for i in range(8)]
    n += 20
    rows += [(n + i, prose(1000 + i, 150)) for i in range(40)]
    return rows


def brute_classes(rows):
    bags, first = {}, {}
    for d, t in rows:
        bags[d] = bag(t)
        if t:
            first.setdefault(t, d)
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(x, y):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)

    for d, t in rows:
        if t:
            join(d, first[t])
    ids = sorted(set(first.values()))
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if weighted_jaccard(bags[a], bags[b]) >= 0.8:
                join(a, b)
    return {d: find(d) for d, _ in rows}


def test_classes_match_brute_force(make_docs):
    rows = family_rows()
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(make_docs(rows)).collect()}
    assert got == brute_classes(rows)


@pytest.mark.parametrize("few,block", [(8, 64), (1, 4), (1000, 64)])
def test_one_large_bucket(spark, make_docs, monkeypatch, few, block):
    """All documents in one bucket: the hub, then blocks or a join, find every class."""
    monkeypatch.setattr(dart_minhash, "FEW", few)
    monkeypatch.setattr(dart_minhash, "BLOCK", block)
    rows = [r for r in family_rows() if r[0] < 190 or r[0] >= 340][:60]
    texts = {}
    for d, t in rows:
        texts.setdefault(t, d)
    docs = make_docs([(d, t) for t, d in texts.items()])
    members = docs.selectExpr("1L as bucket", "doc_id")
    signed = dart_minhash.band_table(docs)
    found = {r.node: r.component for r in dart_minhash.near_classes(members, signed, docs).collect()}
    want = brute_classes([(d, t) for t, d in texts.items()])
    assert {d: found.get(d, d) for d in want} == want


def test_signature_estimates_weighted_jaccard():
    texts = [prose(5, 300), changed(prose(5, 300), 10, 1), prose(5, 150) + " la la la la la la la" * 9, prose(6, 300)]
    h, ends = word_hashes(pa.array(texts))
    sig = dart_minhash.signatures(*dart_minhash.weighted_units(*shingles(h, ends)[:2]), 4, 2000)
    assert (sig > 0).all()
    for i in range(4):
        for j in range(i):
            assert np.mean(sig[i] == sig[j]) == pytest.approx(weighted_jaccard(bag(texts[i]), bag(texts[j])), abs=0.05)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (300, 300)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_duplicates_odd_rows(odd, odd_rows, nothing):
    rows = dart_minhash.near_duplicates(odd).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(d for d, _ in odd_rows)
    classes = {r.doc_id: r.class_id for r in rows}
    assert classes == {None: None, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9, 10: 10, 11: 10}
    kept = dart_minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert dart_minhash.near_duplicates(nothing).count() == 0 and dart_minhash.drop_near_duplicates(nothing).count() == 0


def brute_hits(rows, items):
    """Best item-sized window of each document and item (an item of under five
    words: the whole document); rarity over the items."""
    bags = {i: bag(t) for i, t in items}
    n, df = len(items), collections.Counter(s for b in bags.values() for s in b)
    weight = lambda s: np.log1p(n / df[s]) if df[s] else np.log1p(n)
    out = {}
    for d, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        for i, text in items:
            size = len(re.findall(r"\w+", text.lower()))
            best = 0.0
            for at in range(max(1, len(w) - size + 1) if size >= 5 or len(w) == size else 0):
                b = bag(" ".join(w[at:at + size]))
                most = sum(weight(s) * c for s, c in (b | bags[i]).items())
                best = max(best, sum(weight(s) * c for s, c in (b & bags[i]).items()) / most if most else 0.0)
            if best >= 0.8:
                out[d, i] = best
    return out


def leak_case():
    items = [(i, prose(500 + i, 12 + 5 * i)) for i in range(8)] + [(8, "tiny item"), (9, prose(500, 12))]
    rows = [(1, prose(1, 120)), (2, prose(2, 60) + " " + items[3][1] + " " + prose(3, 60)), (3, items[5][1]),
            (4, items[6][1] + " " + changed(items[7][1], 1, 4)), (5, "x " + items[0][1].upper().replace(" ", ", ") + "."),
            (6, " ".join(items[7][1].split()[:-3])), (7, prose(9, 40) + " tiny item " + prose(10, 40)), (8, changed(items[7][1], 12, 2)), (9, None), (10, "")]
    return rows, items


@pytest.mark.parametrize("block", [20_000, 4])
def test_leaks_match_brute_force(spark, make_docs, block, monkeypatch):
    rows, items = leak_case()
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contamination(make_docs(rows), table, block_items=block).collect()}
    want = brute_hits(rows, items)
    if block > len(items):
        assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-4) for k in want)
    exact = {k for k, v in want.items() if v == 1.0}
    assert exact <= set(got) and {k for k, v in got.items() if v == 1.0} == exact
    kept = decontaminate.drop_contaminated(make_docs(rows), table, block_items=block)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def blocked_case():
    """Items with a common opening, and documents that mix passages of several
    items, so that weights count: similarities on both sides of 0.8."""
    opening = prose(600, 14)
    items = [(i, (opening + " " if i % 3 else "") + prose(620 + i, 17 + 2 * i)) for i in range(6)]
    rows = []
    for i, text in items:
        w, other = text.split(), items[(i + 1) % 6][1].split()
        rows += [(100 * i + k, prose(i, 3) + " " + " ".join(w[:len(w) - k] + other[:k]) + " " + prose(40 + i, 3)) for k in range(1, 7)]
    return rows, items


@pytest.mark.parametrize("block", [20_000, 2])
def test_leaks_do_not_depend_on_blocks(spark, make_docs, block):
    rows, items = blocked_case()
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contamination(make_docs(rows), table, block_items=block).collect()}
    want = brute_hits(rows, items)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-4) for k in want)
    assert min(want.values()) < 0.85 and len(want) < len(rows)
    kept = decontaminate.drop_contaminated(make_docs(rows), table, block_items=block)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**63, 300, dtype=np.uint64)
    index = decontaminate.MultiIndex(np.arange(300), prints)
    asked = prints.copy()
    for i in range(300):
        for bit in rng.choice(64, i % 30, replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(bit)
    q, item, apart = index.near(asked)
    want = {(a, b) for a in range(300) for b in range(300) if int(asked[a] ^ prints[b]).bit_count() <= decontaminate.RADIUS}
    assert set(zip(q.tolist(), item.tolist())) == want
    assert all(int(asked[a] ^ prints[b]).bit_count() == c for a, b, c in zip(q, item, apart.tolist()))


def test_leaks_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "one"), (2, None), (3, ""), (None, "one two"), (4, prose(1, 50)), (4, prose(1, 50))], "item_id long, text string")
    hits = decontaminate.contamination(odd, items).collect()
    assert {(r.doc_id, r.item_id) for r in hits} == {(5, 1), (6, 1), (7, 4)}
    assert decontaminate.drop_contaminated(odd, items).columns == odd.columns
    for docs, benchmark in ((nothing, items), (odd, items.where("false"))):
        assert decontaminate.contamination(docs, benchmark).count() == 0
    assert decontaminate.drop_contaminated(odd, items.where("false")).count() == odd.count()


def test_filter_of_shingles_lets_all_documents_through_that_share_one(spark, make_docs):
    import numpy as np
    import pyarrow as pa

    from cohortmx.llm.common import shingles, word_hashes

    items = spark.createDataFrame([(i, prose(900 + i, 4 + 3 * i)) for i in range(30)] + [(50, "two words")], "item_id long, text string").repartition(3)
    own = {int(h) for r in items.collect() for h in shingles(*word_hashes(pa.array([r.text])))[0]}
    for most in (1 << 29, 1 << 12):
        bloom = decontaminate.shingle_filter(items, most=most)
        assert len(bloom) * 64 <= most
        for place in decontaminate._probes(np.array(sorted(own), np.uint64), len(bloom) << 6):
            assert (bloom[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).all()
    texts = [prose(905, 19) + " and more", "two words", "two words more", prose(1, 50), "", None]
    docs = make_docs(list(enumerate(texts)))
    bloom = decontaminate.shingle_filter(items)
    may = {r.doc_id for r in docs.where(decontaminate._may_share(spark.sparkContext.broadcast(bloom), 5)(docs["text"])).collect()}
    assert {0, 1} <= may and not {4, 5} & may and may <= {0, 1, 2, 3}
