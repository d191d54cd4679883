"""Texts without blanks or of nothing else, ids that stand for several texts,
secrets of forms that no pattern knows, exceptions that labels show."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortmx.llm import common, dart_minhash, language_id, packing, secret_crf, token_counts, toxicity, winnowing, word_bpe

from .conftest import prose

BLANKS = [" ", "\n", " \n", "\t", "　"]
RUNS = ["好", "x-", "=", "a1", "a", "7", "trash can ", *BLANKS]


# ------------------------------------------------------------------ long runs

def test_folding_takes_time_in_proportion():
    def seconds(n):
        begin = time.perf_counter()
        for unit in RUNS:
            toxicity.fold_text(unit * n)
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(400_000) < 40 * max(seconds(40_000), 0.01)


def test_exception_phrases_by_the_thousand():
    lexicon = toxicity.Lexicon({"trash": 1.0}, ("trash can", "the trash can"))
    begin = time.perf_counter()
    assert len(lexicon.weights_of("the trash can trash " * 50_000)) == 50_000
    assert time.perf_counter() - begin < 10


@pytest.mark.parametrize("unit", RUNS)
def test_long_runs_are_counted(unit):
    encoding = token_counts._encoding(token_counts.default_tokenizer())
    assert token_counts.count_tokens(encoding, unit * 2_000_000) > 0


def test_long_blanks_are_counted_as_short_ones(monkeypatch):
    import re

    encoding = token_counts._encoding(token_counts.default_tokenizer())
    monkeypatch.setattr(token_counts, "_LONG_BLANK", re.compile(token_counts._LONG_BLANK.pattern.replace("100000", "3")))
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "'s", " ", "  ", "\n", "\t", "　", "1", "=", "é", "\x1c", "\r\n", "    "]) for _ in range(rng.randrange(14)))
        assert token_counts.count_tokens(encoding, text) == len(encoding.encode_ordinary(text)), repr(text)


def test_a_megabyte_without_blanks_passes_every_operator(make_docs):
    """300,000 to 1,000,000 characters a text, in seconds for each operator."""
    docs = make_docs([(i, unit * (1_000_000 // len(unit.encode()))) for i, unit in enumerate(["好", "x-", "=", " ", "a1"])], extra=False)
    lexicon = toxicity.Lexicon({"trash": 1.0})
    field = secret_crf.Field([__import__("numpy").zeros((n, 3)) for n in secret_crf.SIZES.values()], __import__("numpy").zeros((3, 3)))
    field.tables[0][:, secret_crf.OUT] = 5.0
    english = language_id.profiles(make_docs([(1, prose(1, 300)), (2, prose(2, 300))], extra=False))
    for name, run in {
        "op1": lambda: token_counts.token_lengths(docs).agg(F.sum("n_tokens")),
        "op3": lambda: toxicity.score_texts(docs, lexicon).agg(F.sum("score")),
        "op4": lambda: secret_crf.scan(docs, field).agg(F.count("spans")),
        "op5": lambda: winnowing.fingerprints(docs).agg(F.sum(F.size("hashes"))),
        "op6": lambda: packing.best_fit_pack(docs).agg(F.sum("length")),
        "op7": lambda: dart_minhash.band_table(docs).agg(F.count("bands")),
        "op10": lambda: language_id.identify(docs.select("doc_id", "text"), english).agg(F.count("lang_pred")),
    }.items():
        begin = time.perf_counter()
        assert run().collect()[0][0] is not None, name
        assert time.perf_counter() - begin < 60, name


# ------------------------------------------------------------------ one id, several texts

def test_different_texts_under_one_id_are_documents_of_their_own(make_docs):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    near_b = b + " more"
    rows = [(5, a), (5, b), (6, near_b), (7, c), (7, c), (8, a), (5, None), (9, c + " tail"), (None, a)]
    docs = make_docs(rows)
    got = dart_minhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "text_id", "class_id", "n_rows"] and got.count() == len(rows)
    found = got.collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    classes = {}
    for r in found:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    classes.pop(None)
    # a twice (5, 8), b and near_b (5, 6), the null text of 5, c three times
    assert sorted(sorted(v) for v in classes.values()) == [[5], [5, 6], [5, 8], [7, 7, 9]]
    kept = dart_minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    texts = [r.text for r in kept.where("doc_id is not null").collect()]
    assert len(texts) == 4 and None in texts
    for group in ((a,), (b, near_b), (c, c + " tail")):
        assert sum(t in group for t in texts) == 1
    assert kept.where("doc_id is null").count() == 1


# ------------------------------------------------------------------ secrets

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
FORMS = {
    "pwd": lambda r: ("pwd: ", r(12), ""), "bearer": lambda r: ("Authorization: Bearer ", f"eyJ{r(17)}.{r(30)}.{r(20)}", ""),
    "prefixed": lambda r: ("", "ghp_" + r(36), ""), "credential": lambda r: ("credential = ", r(16), ""), "AUTH": lambda r: ("AUTH=", r(14), ""),
    "private_key": lambda r: ("private_key '", r(40), "'"), "key": lambda r: ("key = ", "sk-" + r(32), ""),
}


def test_the_field_finds_forms_that_no_pattern_knows(make_docs):
    """Learned from documents whose only secrets are hex strings behind ``token``."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        text = prose(i, 60)
        if i % 10 == 0:
            value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            text = text[:150] + f' token = "{value}" ' + text[150:]
        elif i % 3 == 0:
            text += f" call 555-{rng.randrange(1000, 9999)} or {rng.randrange(10**15, 10**16)} the key is here, auth: none"
        rows.append((i, text))
    field = secret_crf.learn(make_docs(rows, extra=False))
    random_value = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    for name, form in FORMS.items():
        texts, values = [], []
        for i in range(60):
            words = prose(10_000 + i, 60).split(" ")
            at = rng.randrange(len(words))
            before, value, after = form(random_value)
            left = " ".join(words[:at]) + " " + before
            texts.append(left + value + after + " " + " ".join(words[at:]))
            values.append((len(left), len(left) + len(value)))
        assert not any(a < e and s < b for t, (s, e) in zip(texts, values) for a, b, _ in secret_crf.base_spans(t)), name
        found = 0
        for spans, (s, e) in zip(secret_crf.find(texts, field), values):
            found += sum(max(0, min(b, e) - max(a, s)) for a, b, _ in spans) >= 0.9 * (e - s)
        assert found >= 0.8 * len(texts), (name, found)
    clean = [prose(20_000 + i, 60) + (" the password is important, key: value, token 42" if i % 5 == 0 else "") for i in range(2000)]
    assert sum(len(s) for s in secret_crf.find(clean, field)) <= 2


def test_altered_examples_leave_the_patterns():
    text = prose(1, 40) + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + prose(2, 40)
    spans = secret_crf.base_spans(text)
    made = list(secret_crf.examples(text, spans[0]))
    assert sum(m[3] for m in made) >= 3 and sum(not m[3] for m in made) == secret_crf.NEAR_MISSES
    for changed, start, end, secret in made:
        assert changed.startswith(text[:150]) and changed.endswith(text[-100:])
        assert not any(a < end and b > start for a, b, _ in secret_crf.base_spans(changed)) or not secret
    assert made == list(secret_crf.examples(text, spans[0]))


def test_nothing_to_learn_from_is_said(make_docs):
    with pytest.warns(UserWarning, match="nothing to learn from"):
        assert secret_crf.learn(make_docs([(1, "no secret here"), (2, None)])) is None


def test_gradient_of_the_field_is_that_of_its_likelihood():
    """After fitting, no small change of a weight makes the penalised likelihood better."""
    import numpy as np

    rng = np.random.default_rng(0)
    sizes = list(secret_crf.SIZES.values())
    windows = [(np.stack([rng.integers(0, n, 6) for n in sizes], axis=1), np.array([0, 0, 1, 2, 0, 0]) if i % 2 else np.zeros(6, int)) for i in range(8)]
    ridge = 0.5
    field = secret_crf.fit(windows, rounds=1500, ridge=ridge, rate=0.02)

    def value(f):
        total = -ridge / 2 * (sum((t ** 2).sum() for t in f.tables) + (f.moves ** 2).sum())
        for a, tags in windows:
            e = f.emissions(a)
            score = e[np.arange(6), tags].sum() + f.moves[tags[:-1], tags[1:]].sum()
            z = e[0]
            for t in range(1, 6):
                z = np.logaddexp.reduce(z[:, None] + f.moves, axis=0) + e[t]
            total += score - np.logaddexp.reduce(z)
        return total

    best = value(field)
    for _ in range(30):
        other = secret_crf.Field([t + rng.normal(0, 0.02, t.shape) for t in field.tables], field.moves + rng.normal(0, 0.02, (3, 3)))
        assert value(other) < best


# ------------------------------------------------------------------ exceptions

def test_exceptions_are_learned_from_clean_documents(spark, make_docs):
    rows, labels = [], []
    for i in range(400):
        text, toxic = prose(i, 30), i % 4 == 0
        at = 20 + i % 80
        if toxic:
            text = text[:at] + " dratted " + text[at:] + " dratted"
        elif i % 4 == 1 and i < 200:
            text = text[:at] + " dratted socks " + text[at:]
        rows.append((i, text))
        labels.append((i, int(toxic)))
    lexicon = toxicity.learn(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(False))
    assert "dratted" in lexicon.terms and lexicon.exceptions == ("dratted socks",)
    assert lexicon.score("so dratted socks it is")[1] == 0 and lexicon.score("you dratted one")[1] == 1
