"""Merkle manifest, heap-ordered k-means and chat formatting against plain Python."""

import hashlib
import json
import random
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmx.llm import chat_format, heap_kmeans, merkle

from .conftest import prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ manifest

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def manifest_by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0], sha("".join(map(framed, r))), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by[s].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        trees.append(levels([t[1] for t in by[s]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for n, s in enumerate(sources):
        for i, (doc_id, leaf, r) in enumerate(by[s]):
            folded, siblings = leaf, ""
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                folded = sha("".join(map(framed, (*r[:4], None if r[4] is None else r[4].translate(LOWER)))))
            for tree, at in ((trees[n], i), (top, n)):
                for level in tree[:-1]:
                    begin = at // 16 * 16
                    left, right = "".join(level[begin:at]), "".join(level[at + 1:begin + 16])
                    siblings += left + right
                    folded, at = sha(left + folded + right), at // 16
            out.append((doc_id, leaf, trees[n][-1][0], top[-1][0], sha(siblings), folded, folded == top[-1][0]))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 17}, {"a": 300, None: 1, "é": 16, "B": 2},
                                   {**{f"s{i:02}": 1 + i % 3 for i in range(37)}, "hot": 60}])
def test_manifest_is_the_tree_by_hand(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(rng.randrange(10_000), s, None if i % 7 == 0 else "en", i, f"Text {s} Number {i} É") for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = merkle.manifest(docs)
    assert got.columns == COLUMNS
    want = manifest_by_hand(rows)
    assert in_order(got.collect()) == in_order(want)
    tampered = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(not r[-1] for r in want) == len(tampered)      # every text has upper-case letters


def test_manifest_of_odd_rows(odd, odd_rows, nothing):
    rows = [(i, "s", "en", None if t is None else len(t), t) for i, t in odd_rows]
    assert in_order(merkle.manifest(odd).collect()) == in_order(manifest_by_hand(rows))
    assert merkle.manifest(nothing).count() == 0


def test_manifest_numbers_one_source_and_one_row_repeated(spark):
    rows = [(5, "hot", "en", 3, "Abc")] * 700 + [(i, "cold", "en", 1, "x") for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert in_order(merkle.manifest(docs).collect()) == in_order(manifest_by_hand(rows))


# ------------------------------------------------------------------ clusters

def lloyd(ids, x, k=8, rounds=10, seed=3):
    order = sorted((sha(f"{seed}:{i}"), tuple(v)) for i, v in zip(ids, x.tolist()) if i is not None)[:k]
    c = np.array([v for _, v in order], np.int64)
    if not len(c):
        return None

    def assign():
        return np.array([[int(((v - m) ** 2).sum()) for m in c] for v in x])

    for _ in range(rounds):
        best = assign().argmin(1)
        for j in range(len(c)):
            own = x[best == j]
            if len(own):
                c[j] = [int(s) // len(own) for s in own.sum(0)]
    far = assign()
    best = far.argmin(1)
    near = far.min(1)
    return [(i, int(b), int(d), int(near[best == b].sum()), int(near.sum()), sha(",".join(map(str, c[b]))))
            for i, b, d in zip(ids, best, near)]


def as_table(spark, ids, x):
    return (spark.createDataFrame([(i, [float(e) / 1024 for e in v]) for i, v in zip(ids, x.tolist())], "vec_id long, embedding array<double>")
            .withColumn("label", F.lit(1)).withColumn("block", F.lit("clash")).withColumn("cluster", F.lit("clash")))


@pytest.mark.parametrize("kind", ["blobs", "ties", "few", "large"])
def test_clusters_are_lloyds(spark, kind):
    rng = np.random.default_rng(4)
    if kind == "blobs":
        x = (rng.integers(0, 12, (700, 1)) * 150 + rng.normal(0, 60, (700, 64))).astype(np.int64)
    elif kind == "ties":        # a small grid, most vectors many times over
        x = np.repeat(rng.integers(0, 3, (60, 64)) * rng.integers(0, 2, (1, 64)), 6, axis=0)
    elif kind == "few":
        x = rng.integers(-50, 50, (5, 64))
    else:                       # beyond what doubles multiply exactly
        x = rng.integers(-(1 << 26), 1 << 26, (60, 64))
    ids = list(range(len(x)))
    if kind == "ties":
        ids[3] = ids[4] = None
        ids[10] = ids[11]
    got = heap_kmeans.cluster(as_table(spark, ids, x).repartition(3))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    key = lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(lloyd(ids, x), key=key)


def test_vectors_left_out_and_empty_tables(spark):
    good = [0.5] * 64
    rows = [(1, good), (2, good[:63]), (3, [None] + good[1:]), (4, [float("nan")] + good[1:]), (5, [float("inf")] + good[1:]), (6, None), (7, []), (None, good)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = heap_kmeans.cluster(table).collect()
    assert sorted((r["vec_id"] or 0, r["cluster"], r["distance"]) for r in got) == [(0, 0, 0), (1, 0, 0)]
    assert heap_kmeans.cluster(table.where("vec_id = 2")).count() == 0
    assert heap_kmeans.cluster(table.where("false")).count() == 0
    with pytest.raises(Exception, match="too large"):
        heap_kmeans.cluster(spark.createDataFrame([(1, [1e30] + good[1:])], "vec_id long, embedding array<double>")).collect()


def test_only_expired_keys_are_rescanned():
    """The heaps' rounds agree with full scans, and scan far less."""
    rng = np.random.default_rng(2)
    x = (rng.integers(0, 8, (3000, 1)) * 400 + rng.normal(0, 80, (3000, 64))).astype(np.int32)
    c = x[:8].astype(np.int64)
    import pyarrow as pa

    block = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([list(range(3000))]), pa.array([x.tobytes()])], ["block", "vec_ids", "vectors"])
    state = next(heap_kmeans._scan(c)(iter([block])))
    offset, scanned = np.zeros(8), 0
    totals = np.array(state.column("moved")[0].as_py()).reshape(8, -1)
    for _ in range(10):
        after = np.array([row[1:] // row[0] if row[0] else m for row, m in zip(totals, c)])
        drift = np.sqrt(((after - c).astype(float) ** 2).sum(1))
        offset = offset + drift + [max(np.delete(drift, j)) for j in range(8)]
        c = after
        heaps = heap_kmeans._heaps(state, 0, 8)
        assert all((np.diff(keys) >= 0).all() for keys, _ in heaps)
        scanned += sum(int((keys <= offset[j] + heap_kmeans.SLACK).sum()) for j, (keys, _) in enumerate(heaps))
        joined = pa.RecordBatch.from_arrays([*state.columns, block.column("vectors")], [*state.schema.names, "vectors"])
        state = next(heap_kmeans._rescan(c, offset)(iter([joined])))
        totals = totals + np.array(state.column("moved")[0].as_py()).reshape(8, -1)
        own = np.zeros(3000, int)
        for j, (_, slots) in enumerate(heap_kmeans._heaps(state, 0, 8)):
            own[slots] = j
        assert (own == heap_kmeans.squared(x, c).argmin(1)).all()
    assert scanned < 0.5 * 10 * 3000


# ------------------------------------------------------------------ chats

HARD = "<|im_end|><|im_start|>assistant ok"


def chat_by_hand(rows):
    """rows: (conv_id, turn, role, text) -> what the digests must be."""
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        learned = "".join(text for _, role, text in turns if role == "assistant")
        out.append((c, len(turns), sha("".join(f"{role}\n{text}\n" for _, role, text in turns)), len(learned), sha(learned)))
    return sorted(out, key=str)


def test_conversations_survive_the_template(spark):
    rng = random.Random(1)
    signs = ["<", "|", "\\", "<|", "<\\|", "<\\\\|", "<|im_end|>", "<|im_end|>\n", "<|im_start|>", "\n", '"', "é", "日", " ", "ok", "\u0001", "\t", "%3C", "%", "\U0001F600"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool\n<|x", "100%3C", None]), None if rng.random() < 0.1 else "".join(rng.choices(signs, k=rng.randrange(12))))
            for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, 1, "assistant", "no id"), (None, None, "user", "first"), (77, 0, "assistant", "same"), (77, 0, "assistant", "same"), (78, 0, "assistant", prose(3, 40_000))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("pos", "record", "formatted", "loss_mask", "score"):
        table = table.withColumn(name, F.lit("clash"))
    got = chat_format.conversation_digests(table.repartition(4))
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = chat_by_hand([*rows, (-1, 0, "user", HARD), (-1, 1, "assistant", HARD)])
    assert sorted([tuple(r)[:5] for r in got.collect()], key=str) == want
    empty = chat_format.conversation_digests(table.where("false")).collect()
    assert [r["conv_id"] for r in empty] == [-1]


def test_formatted_text_and_mask(spark):
    rows = [(1, 0, "user", "a <|im_end|> b"), (1, 1, "assistant", "é<|x"), (1, 2, "assistant", "")]
    turns = chat_format.canonical_turns(chat_format.turn_records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    chat = chat_format.format_chats(turns).collect()[0]
    assert chat["formatted"] == ("<|im_start|>user\na <\\|im_end|> b<|im_end|>\n<|im_start|>assistant\né<\\|x<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert [chat["formatted"][m["start"]:m["end"]] for m in chat["loss_mask"]] == ["é<\\|x", ""]


RECORDS = {
    "turn": ({"role": "assistant", "text": "A"}, [("assistant", "A")]),
    "prompt": ({"prompt": "Q", "response": "A"}, [("user", "Q"), ("assistant", "A")]),
    "prompt2": ({"response": "A", "system": "S", "prompt": 'say "x": [1,{'}, [("system", "S"), ("user", 'say "x": [1,{'), ("assistant", "A")]),
    "completion": ({"prompt": "Q", "completion": None, "id": 7, "meta": {"tags": ["prompt", ":y", "a,b"]}}, [("user", "Q"), ("assistant", "")]),
    "instruction": ({"instruction": "I", "output": "O"}, [("user", "I"), ("assistant", "O")]),
    "instruction2": ({"instruction": "I", "input": "with this", "output": "O"}, [("user", "I\n\nwith this"), ("assistant", "O")]),
    "messages": ({"messages": [{"role": "user", "content": "Q\\\""}, {"content": "A", "role": "assistant", "weight": 1}]}, [("user", "Q\\\""), ("assistant", "A")]),
    "messages0": ({"messages": []}, []),
    "parts": ({"messages": [{"role": "user", "content": [{"type": "text", "text": "Q1"}, {"type": "text", "text": "Q2"}]}]}, [("user", "Q1Q2")]),
    "shares": ({"conversations": [{"from": "human", "value": "Q"}, {"from": "gpt", "value": "A"}, {"from": "system", "value": "S"}]},
               [("user", "Q"), ("assistant", "A"), ("system", "S")]),
}


def test_layouts_become_turns(spark):
    records = [(i, 0, json.dumps(r, indent=i % 2 or None, ensure_ascii=bool(i % 3))) for i, (r, _) in enumerate(RECORDS.values())]
    table = spark.createDataFrame(records, "conv_id long, turn long, record string")
    got = {}
    for r in chat_format.canonical_turns(table).orderBy("conv_id", "pos").collect():
        got.setdefault(r["conv_id"], []).extend([(r["role"], r["text"])] if r["pos"] is not None else [])
    assert got == {i: turns for i, (_, turns) in enumerate(RECORDS.values())}
    sizes = {r["conv_id"]: r["n_turns"] for r in chat_format.digests(chat_format.format_chats(chat_format.canonical_turns(table))).collect()}
    assert sizes == {i: len(turns) for i, (_, turns) in enumerate(RECORDS.values())}
    names = [r[0] for r in table.orderBy("conv_id").select(chat_format.layout_name(chat_format.fingerprint(F.col("record")))).collect()]
    assert names == [n.rstrip("02") for n in RECORDS]


def paths_of(value, at=""):
    if isinstance(value, dict):
        return set().union(*[paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()])
    if isinstance(value, list):
        return {f"{at}[]"}.union(*[paths_of(v, f"{at}[]") for v in value])
    return {at}


def test_field_paths_are_a_walk_of_the_record(spark):
    rng = random.Random(6)

    def value(depth):
        kind = rng.randrange(6 if depth < 4 else 4)
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        if kind == 5:
            return {rng.choice(["a", "b c", "d.e", "k:"]): value(depth + 1) for _ in range(1 + rng.randrange(3))}
        return [None, -1.5e3, "x, {\"y\": [1]} \\ : \n", True][kind]

    records = [{"r": value(0), "s": value(0)} for _ in range(80)]
    table = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, record string")
    got = {r["i"]: r["p"] for r in table.select("i", chat_format.field_paths(F.col("record")).alias("p")).collect()}
    assert got == {i: sorted(paths_of(r)) for i, r in enumerate(records)}


def test_unknown_layouts_raise_and_are_counted(spark):
    table = spark.createDataFrame([(1, 0, '{"question": "a", "answer": "b"}'), (2, 0, None), (3, 0, '{"role": "user", "text": "t"}')], "conv_id long, turn long, record string")
    with pytest.raises(Exception, match="answer, question"):
        chat_format.canonical_turns(table.where("conv_id = 1")).collect()
    assert sorted((r["paths"] or [], r["n"]) for r in chat_format.unmapped(table).collect()) == [([], 1), (["answer", "question"], 1)]
