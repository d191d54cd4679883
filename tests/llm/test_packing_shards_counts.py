import collections
import math
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from cohortmx.llm import jump_shards, packing, token_counts
from cohortmx.llm.word_bpe import encoder


def best_fit(items, capacity):
    """Remaining room of each bin, one item at a time."""
    rooms = []
    for x in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= x]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= x
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 64])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 90))]
    bins = collections.defaultdict(list)
    ranks = collections.Counter()
    for length, rank, n, first, per, used in packing.plan(collections.Counter(items), capacity):
        assert rank == ranks[length]
        ranks[length] += n
        for k in range(n):
            bins[first + k // per].append((used + k % per * length, length))
    assert ranks == collections.Counter(items)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert sorted(capacity - sum(n for _, n in parts) for parts in bins.values()) == best_fit(items, capacity)


def test_tightest_room():
    tree = packing.RoomTree(20)
    for room in (3, 9, 20):
        tree.set(room, True)
    assert [tree.tightest(n) for n in (1, 3, 4, 9, 10, 20)] == [3, 3, 9, 9, 20, 20]
    tree.set(20, False)
    assert tree.tightest(10) is None


def test_encoder_is_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    for text in ("", "  ", "a  b", "don't WON'T I'll x'S 's", "ǅ ſ İi ﬁ Ω", "tab\there\x85there x", "___a_b_1_2", "ªº µ ²³ ½",
                 "<|endoftext|> hi", "日本語 テスト １２", "word" * 3000, "a\x1cb", "’s it’s", "Ünïcode, naïve. 3.14!"):
        assert np.frombuffer(encoder(path)(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_packing_odd_rows(odd, odd_rows, nothing):
    path = packing.default_tokenizer()
    rows = packing.best_fit_pack(odd, capacity=512).collect()
    whole = Tokenizer.from_file(path)
    want = collections.Counter()
    for doc, text in odd_rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 512)):
            part = ids[at:at + 512]
            want[doc, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert want == collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert sorted(512 - sum(n for _, n in p) for p in bins.values()) == best_fit([r.length for r in rows], 512)
    assert packing.best_fit_pack(nothing).count() == 0


def test_sequences_hold_the_ids(make_docs):
    docs = make_docs([(i, "alpha beta gamma " * i) for i in range(1, 30)])
    packed = packing.pack(packing.pieces(docs, 64, with_ids=True), 64)
    got = {r.sequence_id: list(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert got[r.sequence_id][r.offset:r.offset + r.length] == list(r.ids)


def draw_shard(spark, key, shards):
    """Jump hashing one key at a time, by the same draws."""
    b, j, i = -1, 0, 0
    while j < shards:
        b, i = j, i + 1
        h = spark.sql(f"select xxhash64({key}L, {i}) h").collect()[0].h
        j = math.floor((b + 1) * (float(1 << 31) / (((h & (2**64 - 1)) >> 33) + 1)))
    return b


def test_jump_shards(spark):
    keys = spark.range(3000).withColumnRenamed("id", "doc_id")
    at = {n: {r.doc_id: (r.shard, r.grown_shard) for r in jump_shards.with_shard(keys, "doc_id", n).collect()} for n in (1, 7, 16, 17, 70)}
    assert {s for s, _ in at[1].values()} == {0}
    for n, rows in at.items():
        counts = collections.Counter(s for s, _ in rows.values())
        assert set(counts) == set(range(n)) and max(counts.values()) < 3000 / n + 6 * math.sqrt(3000 / n)
        assert all(g in (s, n) for s, g in rows.values())
    assert all(at[16][k][1] == at[17][k][0] for k in range(3000))
    assert [at[70][k][0] for k in range(5)] == [draw_shard(spark, k, 70) for k in range(5)]


def test_shards_odd_rows(odd, odd_rows, nothing):
    rows = jump_shards.assign(odd).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == collections.Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in odd_rows)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r.law for r in rows} == {"key"}
    assert jump_shards.assign(nothing).count() == 0


def test_written_shards(spark, odd, odd_rows, tmp_path):
    jump_shards.write_shards(odd, "doc_id", str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(odd_rows)


def test_token_histogram(odd, odd_rows, nothing):
    encode = token_counts._encoding(token_counts.default_tokenizer()).encode_ordinary
    lengths = [len(encode(t or "")) for _, t in odd_rows]
    hist = token_counts.length_histogram(token_counts.token_lengths(odd))
    rows = {r.n_tokens: r for r in hist.collect()}
    assert {k: r.n_docs for k, r in rows.items()} == collections.Counter(lengths)
    for limit, r in rows.items():
        assert r.n_longer == sum(x > limit for x in lengths)
        assert r.tokens_kept == sum(min(x, limit) for x in lengths)
        assert r.tokens_cut == sum(max(x - limit, 0) for x in lengths) and r.total_tokens == sum(lengths)
        assert r["quantile"] == pytest.approx(sum(x <= limit for x in lengths) / len(lengths))
    for limit in (0, 2, 100, 2048, 10**6):
        assert token_counts.at_limit(hist, limit) == (sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths))
    assert token_counts.quantile(hist, 0.5) == sorted(lengths)[math.ceil(0.5 * len(lengths)) - 1]
    assert token_counts.quantile(hist, 1.0) == max(lengths)
    assert token_counts.length_histogram(token_counts.token_lengths(nothing)).count() == 0
