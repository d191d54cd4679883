"""The whole pipeline on a small corpus: each stage against brute force on its
own input, and run() against the stages one by one."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortmx.llm import secret_crf

from .conftest import prose

HEX = "".join(random.Random(9).choice("0123456789abcdef") for _ in range(40))


def corpus():
    """(rows of documents, labels, benchmark items)."""
    rng = random.Random(11)
    rows, labels, items = [], [], [(i, prose(5000 + i, 14)) for i in range(8)]
    for i in range(300):
        text = prose(i, 60 + i % 50)
        words = text.split(" ")
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "dratted")
        elif i % 6 == 1 and i > 6:                               # a copy of the clean one before it, or almost
            words = rows[i - 2][1].split(" ") if rows[i - 2][1] else words
            if i % 12 == 1:
                words = [*words[:-1], "changed"]
        elif i % 30 == 2:
            at = len(words) // 2
            words[at:at] = items[i % 8][1].split(" ")
        elif i % 30 == 3:
            words.insert(len(words) // 2, f'token = "{HEX[:20 + i % 7]}{i:04x}{HEX[24:]}"')
        rows.append((i, " ".join(words), "en", f"s{i % 4}", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(300, None, "en", "s0", 0), (301, "", None, None, None), (302, "long " + prose(77, 9000), "en", "s1", 0), (4, rows[4][1], "en", "s0", 0)]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s, _ in rows], labels, items


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def shingled(text):
    words = re.findall(r"\w+", (text or "").lower())
    grams = [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    return {g: 1 + np.log(n) for g, n in Counter(grams).items()}


def alike(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / max(sum(max(a.get(k, 0), b.get(k, 0)) for k in keys), 1e-9)


def test_stages_and_run(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{i}")
        out = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append((name, docs.collect(), out.collect()))
        if i < 4:
            assert out.columns == columns
        docs = out
    assert [s[0] for s in seen] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]

    # toxicity: the documents with the word go, all others stay
    _, before, after = seen[0]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if "dratted" not in (r.text or ""))

    # near duplicates: one of each connected group of similarity 0.8 or more, exactly
    _, before, after = seen[1]
    texts = {r.doc_id: r.text for r in before}
    sets = {i: shingled(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and group[a] != group[b] and (texts[a] == texts[b] or alike(sets[a], sets[b]) >= 0.8):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if v == old else v for k, v in group.items()}
    assert sorted(r.doc_id for r in after) == sorted(set(group.values()))
    assert len(after) < len(before) - 20

    # decontamination: the documents that hold an item go, all others stay
    _, before, after = seen[2]
    items = [t for _, t in corpus()[2]]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not any(t in (r.text or "") for t in items))
    assert len(after) < len(before)

    # secrets: every row stays, base spans are masked, other texts stay as they are
    _, before, after = seen[3]
    was = {r.doc_id: r for r in before}
    assert sorted(was) == sorted(r.doc_id for r in after)
    for r in after:
        spans = secret_crf.base_spans(was[r.doc_id].text or "")
        if spans:
            a, b = min(s[0] for s in spans), max(s[1] for s in spans)
            assert r.text == was[r.doc_id].text[:a] + "[SECRET]" + was[r.doc_id].text[b:] and r.n_chars == len(r.text)
        else:
            assert r.text == was[r.doc_id].text and r.n_chars == (None if r.text is None else len(r.text))
    assert any("[SECRET]" in (r.text or "") for r in after)

    # packing: every token of every document once, in order; sequences full of pieces without gaps
    _, before, after = seen[4]
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in before:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for p, a in enumerate(range(0, len(ids), 4096)):
            piece = np.array(ids[a:a + 4096], "<u4")
            want.append((r.doc_id, p, a, len(piece), zlib.crc32(piece.tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == sorted(want)
    rooms = []
    for length in sorted((w[3] for w in want), reverse=True):      # best fit decreasing by hand
        fits = [j for j, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= length
        else:
            rooms.append(4096 - length)
    filled = {}
    for r in after:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(filled) == len(rooms)
    for pieces in filled.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096

    got = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, got.collect())) == sorted(want)


def test_an_empty_corpus_passes(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    with pytest.warns(UserWarning, match="nothing to learn from"):
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
