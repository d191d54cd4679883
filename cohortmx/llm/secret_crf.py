"""Secret scan: patterns, and a linear-chain conditional random field over tokens.

Three patterns give the base spans.  The field tags every token of the text as
secret begin (B), inside (I) or outside (O); its spans of MIN_LENGTH code points
or more are added, as far as no base span covers them.  A token is a run of letters, digits and ``_ - + /``, or any other
single character that isn't white space.  Its attributes are its shape and
length, how often its characters change kind, the shapes of its neighbours,
keywords, quotes and assignment signs before and after it, and features of the
file (a keyword anywhere, many digits, many signs).

Base spans are all that is known to be secret, and a field trained on them as
they stand would only repeat the patterns.  So most of its examples are
altered: in a bounded sample of the documents with base spans, the secret
gets letters and digits of its own, another length, another keyword or none,
and is kept where no pattern finds it any more; near misses put ordinary words and
short numbers of the text behind keywords.  Windows around the likeliest other
tokens of a sample of all documents show what isn't secret; a secret-shaped
token behind a keyword isn't called that.  Decoding is exact: a token
whose score for O leads by more than any two transitions can make up for is O
on the best path, and the runs of other tokens between are decoded by Viterbi.
"""

from __future__ import annotations

import hashlib
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmx.llm.common import _BYTE, _powers, mix64, only_ids, text_slices, written

SAMPLE_DOCS = 20_000       # documents that windows without secrets are taken from at most
SECRET_DOCS = 1_500        # documents with base spans that are learned from at most
WINDOWS = 4_000            # windows that are learned from at most
ALTERED, NEAR_MISSES = 5, 3   # examples made of each base span
REACH = 12                 # tokens on each side of a window's middle
SPANS_PER_DOC = 3          # of the base spans of a sampled document, those that give windows
MIN_LENGTH = 6             # code points of a span of the field, as of base assignments

# fixed values: the base patterns, kinds in this order
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "key", "auth",
            "authorization", "bearer", "credential", "credentials", "private_key", "access_key", "client_secret")

# keywords that no base pattern knows, and ways to write one before a value
OTHER_KEYWORDS = ("pwd", "key", "auth", "authorization", "bearer", "credential", "credentials", "private_key", "access_key")
FORMS = ("{k}: {v}", "{k} = {v}", "{k}={v}", '{k}: "{v}"', "{k} = '{v}'", "{k} '{v}'", "Authorization: Bearer {v}", "{k}:{v}")
# a superset of the base patterns, as Spark reads it
LIKELY = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[a-z0-9+/_.=-]{6}|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""

OUT, BEGIN, IN = 0, 1, 2
SHAPES = 12                # see _shape
LENGTHS = np.array([2, 4, 8, 16, 20, 24, 40])
SIZES = {"shape": SHAPES * 8, "change": 4, "before": 8, "after": 3, "shape_before": SHAPES + 1, "shape_after": SHAPES + 1, "file": 8}
_CLASS: list[np.ndarray] = []
SPACE, LOWER, HEXLOW, UPPER, DIGIT, JOIN, OTHER, SIGN, QUOTE, ASSIGN = range(10)


def _classes() -> np.ndarray:
    if not _CLASS:
        table = np.full(0x110000, OTHER, np.uint8)
        table[:128] = SIGN
        table[[*range(33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x7F]] = SPACE
        for kind, chars in ((LOWER, "ghijklmnopqrstuvwxyz"), (HEXLOW, "abcdef"), (UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                            (DIGIT, "0123456789"), (JOIN, "_-+/"), (QUOTE, "\"'`"), (ASSIGN, "=:")):
            table[[ord(c) for c in chars]] = kind
        _CLASS.append(table)
    return _CLASS[0]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns, in code points, by start, then kind as listed."""
    found: list[tuple[int, int, str]] = []
    if any(w in text.lower() for w in _ASSIGN_WORDS):
        found += [(*m.span(2), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Tokens:
    start: np.ndarray      # first code point within the text
    end: np.ndarray
    doc: np.ndarray        # text number
    attributes: np.ndarray  # (token, attribute) numbers below SIZES


def _word_hash(points: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    low = np.where((points >= 65) & (points <= 90), points + 32, points).astype(np.uint8)
    power, inverse = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_BYTE[low] * power[:-1], out=sums[1:])
    return mix64((sums[end] - sums[first]) * inverse[first] + (end - first).astype(np.uint64))


def _keyword_hashes() -> np.ndarray:
    points = np.frombuffer(" ".join(KEYWORDS).encode(), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(k) + 1 for k in KEYWORDS]) - 1
    return _word_hash(points, np.concatenate([[0], ends[:-1] + 1]), ends)


def tokens(texts: list[str]) -> Tokens:
    points = np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    text_first = np.cumsum(sizes) - sizes
    kind = _classes()[points]
    in_run = (kind >= LOWER) & (kind <= OTHER)
    begins = kind >= SIGN
    begins |= in_run
    begins[1:] &= ~(in_run[1:] & in_run[:-1])
    first = np.flatnonzero(begins)
    stops = (kind >= SIGN) | in_run
    stops[:-1] &= ~(in_run[1:] & in_run[:-1])
    end = np.flatnonzero(stops) + 1
    doc = np.searchsorted(text_first, first, "right") - 1

    def count(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag, dtype=np.int32)])
        return sums[end] - sums[first]

    size = end - first
    n_hex, n_low, n_up, n_digit, n_other = (count(kind == k) for k in (HEXLOW, LOWER, UPPER, DIGIT, OTHER))
    n_low = n_low + n_hex
    group = np.where(kind == HEXLOW, LOWER, kind)
    change = np.zeros(len(points), bool)
    change[1:] = (group[1:] != group[:-1]) & in_run[1:] & in_run[:-1]
    n_change = count(change)
    lead = kind[first]
    sign = kind[first] >= SIGN
    hexed = (n_hex + n_digit == size) & (n_hex > 0) & (n_digit > 0)
    shape = np.select(
        [sign, n_other > 0, hexed, n_digit == size, n_low == size, n_up == size, (n_up == 1) & (lead == UPPER) & (n_low == size - 1),
         (n_digit > 0) & (n_up > 0) & (n_low > 0), (n_digit > 0) & (n_low > 0), (n_digit > 0) & (n_up > 0), (n_up > 0) & (n_low > 0)],
        [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10], 11)
    n = len(first)
    known = np.isin(_word_hash(points, first, end), _keyword_hashes()) & (n_other == 0) if n else np.zeros(0, bool)

    def back(flag: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, flag.dtype)
        if n > abs(by):
            if by > 0:
                out[by:] = np.where(doc[by:] == doc[:-by], flag[:-by], 0)
            else:
                out[:by] = np.where(doc[:by] == doc[-by:], flag[-by:], 0)
        return out

    quote, assign = lead == QUOTE, lead == ASSIGN
    before = back(quote, 1) + 2 * (back(assign, 1) | back(assign, 2)) + 4 * (back(known, 1) | back(known, 2) | back(known, 3) | back(known, 4))
    after = np.where(back(quote, -1), 1, np.where(back(sign, -1), 2, 0))
    n_texts = len(texts)
    chars = np.maximum(sizes, 1)
    has_key = np.bincount(doc, known, n_texts) > 0
    digits = np.bincount(doc, n_digit, n_texts) > 0.05 * chars
    signs = np.bincount(doc, sign, n_texts) > 0.1 * chars
    file = (has_key + 2 * digits + 4 * signs)[doc] if n else np.zeros(0, np.int64)
    wide = np.searchsorted(LENGTHS, size, "right")
    attributes = np.stack([shape * 8 + wide, (n_change * 4 >= size) + 2 * (size >= 12), before, after,
                           back(shape + 1, 1), back(shape + 1, -1), file], axis=1).astype(np.int64)
    return Tokens(first - text_first[doc], end - text_first[doc], doc, attributes)


@dataclass
class Field:
    """Weights: one (value, tag) table for each attribute, and (tag, tag) transitions."""

    tables: list[np.ndarray]
    moves: np.ndarray

    def emissions(self, attributes: np.ndarray) -> np.ndarray:
        return sum(t[attributes[:, j]] for j, t in enumerate(self.tables))

    def decode(self, attributes: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The best tag of every token; tokens in order, ``doc`` their texts."""
        score = self.emissions(attributes)
        tags = np.zeros(len(score), np.int64)
        lead = score[:, OUT] - np.maximum(score[:, BEGIN], score[:, IN])
        open_ = np.flatnonzero(lead <= 2 * (self.moves.max() - self.moves.min()))
        if not len(open_):
            return tags
        new = np.ones(len(open_), bool)
        new[1:] = (np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])
        first = open_[new]
        length = np.diff(np.append(np.flatnonzero(new), len(open_)))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        before = (first > 0) & (doc[np.maximum(first - 1, 0)] == doc[first])
        best = score[first] + np.where(before[:, None], self.moves[OUT], 0.0)
        steps: list[np.ndarray] = []
        for t in range(1, int(length[0])):
            n = int(np.searchsorted(-length, -t, "left"))          # runs longer than t
            ways = best[:n, :, None] + self.moves
            steps.append(ways.argmax(axis=1))
            best[:n] = ways.max(axis=1) + score[first[:n] + t]
        last = first + length - 1
        follows = (last + 1 < len(score)) & (doc[np.minimum(last + 1, len(doc) - 1)] == doc[last])
        tag = (best + np.where(follows[:, None], self.moves[:, OUT], 0.0)).argmax(axis=1)
        tags[last] = tag
        for t in range(len(steps), 0, -1):
            n = len(steps[t - 1])
            tag[:n] = steps[t - 1][np.arange(n), tag[:n]]
            tags[first[:n] + t - 1] = tag[:n]
        return tags


def fit(windows: list[tuple[np.ndarray, np.ndarray]], rounds: int = 120, ridge: float = 0.02, rate: float = 0.15) -> Field:
    """Maximum likelihood with a ridge penalty, by Adam on exact
    forward-backward gradients.  ``windows``: (attributes, tags)."""
    n, longest = len(windows), max(len(t) for _, t in windows)
    x = np.zeros((n, longest, len(SIZES)), np.int64)
    y = np.zeros((n, longest), np.int64)
    real = np.zeros((n, longest), bool)
    for i, (a, t) in enumerate(windows):
        x[i, :len(t)], y[i, :len(t)], real[i, :len(t)] = a, t, True
    sizes = list(SIZES.values())
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    w = np.zeros((offsets[-1] + 3, 3))
    flat = x + offsets[:-1]
    hot = np.eye(3)[y] * real[:, :, None]
    pair = real[:, 1:] & real[:, :-1]
    seen = np.einsum("nta,ntb,nt->ab", np.eye(3)[y[:, :-1]], np.eye(3)[y[:, 1:]], pair.astype(float))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        moves = w[-3:]
        e = w[flat].sum(axis=2)
        f, b = np.zeros((n, longest, 3)), np.zeros((n, longest, 3))
        f[:, 0] = e[:, 0]
        for t in range(1, longest):
            ways = f[:, t - 1, :, None] + moves
            top = ways.max(axis=1)
            f[:, t] = np.where(real[:, t, None], top + np.log(np.exp(ways - top[:, None]).sum(axis=1)) + e[:, t], f[:, t - 1])
        top = f[:, -1].max(axis=1, keepdims=True)
        z = top + np.log(np.exp(f[:, -1] - top).sum(axis=1, keepdims=True))
        for t in range(longest - 2, -1, -1):
            ways = moves + (e[:, t + 1] + b[:, t + 1])[:, None, :]
            top = ways.max(axis=2)
            b[:, t] = np.where(real[:, t + 1, None], top + np.log(np.exp(ways - top[:, :, None]).sum(axis=2)), b[:, t + 1])
        p = np.exp(f + b - z[:, None]) * real[:, :, None]
        both = np.exp(f[:, :-1, :, None] + moves + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None]) * pair[:, :, None, None]
        grad = np.zeros_like(w)
        rest = hot - p
        for tag in range(3):
            grad[:-3, tag] = np.bincount(flat.reshape(-1), np.repeat(rest[:, :, tag].reshape(-1), len(sizes)), offsets[-1])
        grad[-3:] = seen - both.sum(axis=(0, 1))
        grad = grad / n - ridge / n * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field([w[a:b] for a, b in zip(offsets[:-1], offsets[1:])], w[-3:])


def _tags(tok: Tokens, doc: int, spans: list[tuple[int, int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(token numbers of a text, their tags by the base spans)."""
    at = np.arange(*np.searchsorted(tok.doc, [doc, doc + 1]))
    tags = np.zeros(len(at), np.int64)
    for a, b, _ in spans:
        own = np.flatnonzero((tok.start[at] < b) & (tok.end[at] > a))
        if len(own) and not tags[own].any():
            tags[own] = IN
            tags[own[0]] = BEGIN
    return at, tags


def _draws(seed: str) -> Iterator[int]:
    """An endless sequence of 64-bit numbers from a text."""
    state, i = int.from_bytes(hashlib.sha256(seed.encode("utf-8", "surrogatepass")).digest()[:8], "little"), 0
    while True:
        i += 1
        yield int(mix64(np.array([(state + i * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])


def _another(value: str, draw: Iterator[int]) -> tuple[str, bool]:
    """(a secret of another form made of ``value``, whether it needs a keyword
    before it).  Letters get other letters and cases, half of the digits become
    letters; the long ones may get a prefix or be parted by dots or dashes."""
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    size = (8 + next(draw) % 6, 14 + next(draw) % 10, 24 + next(draw) % 20)[next(draw) % 3]
    chars = []
    for c in (value * (1 + size // len(value)))[:size]:
        n = next(draw)
        chars.append(alphabet[n % 52] if c.isalpha() or n >> 32 & 1 else str((n >> 8) % 10))
    chars[1 + next(draw) % (size - 1)] = str(next(draw) % 10)
    out = "".join(chars)
    way = next(draw) % 6
    if size >= 20 and way == 0:
        out = "".join(alphabet[next(draw) % 26] for _ in range(2 + next(draw) % 3)) + "_-"[next(draw) % 2] + out
    elif size >= 20 and way == 1:
        out = ".".join((out[:size // 3], out[size // 3:2 * size // 3], out[2 * size // 3:]))
    elif size >= 20 and way == 2:
        out = "-".join(out[i:i + 8] for i in range(0, size, 8))
    return out, size < 20


def _behind(keyword: str, value: str, draw: Iterator[int]) -> str:
    return FORMS[next(draw) % len(FORMS)].format(k=(keyword, keyword.upper(), keyword.title())[next(draw) % 3], v=value)


def examples(text: str, span: tuple[int, int, str]) -> Iterator[tuple[str, int, int, bool]]:
    """(text, start, end, secret) made of a text with a base span: the base
    match replaced by a secret of another form, at start..end, that no base
    pattern touches, or by a near miss."""
    start, end, kind = span
    whole = next((m.span() for m in _ASSIGN.finditer(text) if m.span(2) == (start, end)), (start, end)) if kind == "assign" else (start, end)
    if whole[1] < len(text) and text[whole[1]] in "\"'":
        whole = whole[0], whole[1] + 1
    words = [w for w in re.findall(r"[^\W\d_]{3,}", text[max(0, start - 400):end + 400]) if w.lower() not in KEYWORDS] or ["word"]
    for i in range(ALTERED + NEAR_MISSES):
        draw = _draws(f"{i}:{start}:{text[start:end]}")
        secret = i < ALTERED
        if secret:
            value, needs = _another(text[start:end], draw)
        else:
            value, needs = str(next(draw) % 10_000) if next(draw) % 4 == 0 else words[next(draw) % len(words)], True
        put = _behind(OTHER_KEYWORDS[next(draw) % len(OTHER_KEYWORDS)], value, draw) if needs or next(draw) % 2 else value
        at = whole[0] + put.rindex(value)
        changed = text[:whole[0]] + put + text[whole[1]:]
        if not secret or not any(a < at + len(value) and b > at for a, b, _ in base_spans(changed)):
            yield changed, at, at + len(value), secret


PLAIN, SECRET, NEAR_MISS = 0, 1, 2


def training_windows(docs: DataFrame) -> DataFrame:
    """attributes (flat), tags, kind (PLAIN, SECRET, NEAR_MISS) of windows of
    each document: around its first base spans and around what ``examples``
    makes of them, around its longest other token with a digit, and around the
    token in its middle."""

    def windows(texts: list[str]) -> Iterator[tuple[list[int], list[int], int]]:
        tok = tokens(texts)

        def cut(at: np.ndarray, tags: np.ndarray, middle: int, kind: int) -> tuple[list[int], list[int], int]:
            part = slice(max(0, middle - REACH), middle + REACH + 1)
            return tok.attributes[at[part]].reshape(-1).tolist(), tags[part].tolist(), kind

        made: list[tuple[str, int, int, bool]] = []
        for d, text in enumerate(texts):
            spans = base_spans(text)
            at, tags = _tags(tok, d, spans)
            if not len(at):
                continue
            for i in np.flatnonzero(tags == BEGIN)[:SPANS_PER_DOC]:
                yield cut(at, tags, int(i), SECRET)
            a = tok.attributes[at]
            shape, keyed = a[:, 0] // 8, a[:, 2] >= 4
            size = np.where((tags == OUT) & np.isin(shape, (2, 3, 7, 8, 9)) & ~keyed, tok.end[at] - tok.start[at], 0)
            for i in dict.fromkeys([*([int(size.argmax())] if size.max() > 0 else []), len(at) // 2]):
                kind = SECRET if tags[max(0, i - REACH):i + REACH + 1].any() else PLAIN
                if kind == SECRET or not (keyed & np.isin(shape, (2, 7, 8, 9)))[max(0, i - REACH):i + REACH + 1].any():
                    yield cut(at, tags, i, kind)
            own = [s for s in spans if not any(o is not s and o[0] <= s[0] and s[1] <= o[1] and o[2] == "assign" for o in spans)]
            for span in own[:SPANS_PER_DOC]:
                made += examples(text, span)
        for text, start, end, secret in made:
            tok = tokens([text])
            at, tags = _tags(tok, 0, base_spans(text) + ([(start, end, "crf")] if secret else []))
            middle = int(np.searchsorted(tok.end, start, "right"))
            yield cut(at, tags, middle, SECRET if secret else NEAR_MISS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                rows = list(windows([t or "" for t in b.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                                                  pa.array([r[2] for r in rows], pa.int32())], ["attributes", "tags", "kind"])

    return docs.select("text").mapInArrow(run, "attributes array<int>, tags array<int>, kind int")


def learn(docs: DataFrame, rows: int = SAMPLE_DOCS, secret_rows: int = SECRET_DOCS, windows: int = WINDOWS) -> Field | None:
    """The field from bounded samples: of the documents that hold a base span,
    all searched, the ``secret_rows`` with the smallest hash of the id, and of
    all documents the ``rows`` with the smallest; of their windows up to
    ``windows``, half of them with secrets, a quarter near misses.  None, with a
    warning, if no document holds a base span: there is nothing to learn from."""
    own = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    first = lambda df, n: df.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = written(first(own.where(F.col("text").rlike(LIKELY)), secret_rows).union(first(own, rows)).distinct())
    cut = written(training_windows(only_ids(own, ids)))
    found = []
    for kind, share in ((SECRET, 2), (NEAR_MISS, 4), (PLAIN, 4)):
        kept = cut.where(F.col("kind") == kind).orderBy(F.xxhash64("attributes", "tags"), "attributes", "tags").limit(windows // share)
        found.append([(np.array(r["attributes"]).reshape(-1, len(SIZES)), np.array(r["tags"])) for r in kept.collect()])
    if not found[0]:
        warnings.warn("no document holds a secret that the base patterns know: the field has nothing to learn from and adds no spans", stacklevel=2)
        return None
    return fit(sum(found, []))


def _uncovered(start: int, end: int, spans: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """The parts of start..end that no span (by start) covers."""
    for a, b, _ in spans:
        if start < min(a, end):
            yield start, min(a, end)
        start = max(start, b)
    if start < end:
        yield start, end


def find(texts: list[str], field: Field | None) -> list[list[tuple[int, int, str]]]:
    """All spans of each text, base and added ones, by start, then kind."""
    spans = [base_spans(t) for t in texts]
    if field is None:
        return spans
    tok = tokens(texts)
    tags = field.decode(tok.attributes, tok.doc)
    added: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    at = np.flatnonzero(tags != OUT)
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = ((tags[at[1:]] == BEGIN) | (np.diff(at) > 1) | (tok.doc[at[1:]] != tok.doc[at[:-1]]) | (tok.start[at[1:]] != tok.end[at[:-1]]))
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(at)) - 1
        for a, b in zip(at[heads], at[tails]):
            d, start, end = int(tok.doc[a]), int(tok.start[a]), int(tok.end[b])
            if end - start >= MIN_LENGTH:
                added[d] += [(x, y, "crf") for x, y in _uncovered(start, end, spans[d])]
    return [sorted(s + more, key=lambda x: (x[0], KINDS.index(x[2]))) for s, more in zip(spans, added)]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans of each row.

    A null text counts as empty: no spans, the SHA-256 of the empty string.
    Repeated rows are scanned each, a null doc_id stays null; other columns are ignored.
    A span of the field under MIN_LENGTH code points is not reported; of one that
    overlaps base spans, n_crf and spans have the parts that these leave, however short.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole):
                found = find([t or "" for t in b.column("text").to_pylist()], shared.value)
                counts = [pa.array([sum(s[2] == k for s in spans) for spans in found], pa.int64()) for k in KINDS]
                digest = [hashlib.sha256(_joined([s for s in spans if s[2] != "crf"]).encode()).hexdigest() for spans in found]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *counts, pa.array(digest, pa.string()), pa.array(map(_joined, found), pa.string())],
                                                 ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def redact(docs: DataFrame, field: Field | None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark`` (touching
    spans by one), all rows and other columns kept.  A null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            raw = part.column("text").to_pylist()
            for text, spans in zip(raw, find([t or "" for t in raw], shared.value)):
                if spans:
                    pieces, at = [], 0
                    for a, b, _ in spans:
                        if a > at or not pieces:
                            pieces += [text[at:a], mark]
                        at = max(at, b)
                    text = "".join([*pieces, text[at:]])
                out.append(text)
        return pa.array(out, pa.string())

    return docs.withColumn("text", clean(F.col("text")))
