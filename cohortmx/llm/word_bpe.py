"""Token ids of whole texts under a word-level BPE tokenizer file.

The tokenizer drops white space and never joins what white space parts, so a
text's ids are the ids of its space-separated chunks in a row.  Chunks repeat,
so a worker keeps the ids of those it has met (up to CACHE_CHUNKS, then it
starts anew), until told to forget them.  Only
plain Latin chunks take the short way through the vocabulary's merge model;
every other chunk goes through the whole tokenizer.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

CACHE_CHUNKS = 600_000
MAX_FAST = 200          # characters of a chunk that takes the short way
_ENCODERS: dict[str, Encoder] = {}

# fixed values: the split pattern in the tokenizer file, for chunks whose
# letters are Latin (so that \w less digits and _ is a letter)
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_LATIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿĀ-ž]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: the
    byte's own where it is printable, else the next unused one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Chunks(dict):
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            word = "".join(map(self.letters.__getitem__, part.encode()))
            found = np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()
            if len(self.parts) >= CACHE_CHUNKS:
                self.parts.clear()
            self.parts[part] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) <= MAX_FAST and _LATIN.fullmatch(chunk):
            low = unicodedata.normalize("NFC", chunk).lower()
            ids = b"".join(map(self.part, _PARTS.findall(low)))
        elif chunk:
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            ids = b""
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        self[chunk] = ids
        return ids


class Encoder:
    """text -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.chunks = _Chunks(path)

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))

    def forget(self) -> None:
        self.chunks.clear()
        self.chunks.parts.clear()


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
