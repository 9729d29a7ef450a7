"""Word shingles of texts as numbers, for the near-duplicate operator's Python stages."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

from caseloom.llm.lookalike import CHARACTER_MAP
from caseloom.session import ship

ship(__name__)

WORD = re.compile(r"[^\W_]+")
MAPPED = re.compile("[" + "".join(re.escape(chr(c)) for c in CHARACTER_MAP if c > 126 and chr(c) not in "µ") + "]")
TOKEN_BITS = 44
#: Texts that are handled at once: their number within a batch takes 12 bits beside a token and its class.
BLOCK = 4096
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


class _Words(dict):
    """Word to hash, computed once a word; forgets all when it has grown too large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_words = _Words()


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case, in the canonical form of look-alike text."""
    if not text.isascii():
        if MAPPED.search(text):
            text = text.translate(CHARACTER_MAP)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
    return WORD.findall(text.lower())


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M[3]
    x = x ^ (x >> np.uint64(29))
    x = x * _M[4]
    return x ^ (x >> np.uint64(32))


def shingle_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every run of ``width`` words, repeats included."""
    flat: list[int] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    look = _words.__getitem__
    for i, t in enumerate(texts):
        words = words_of(t)
        sizes[i] = len(words)
        flat.extend(map(look, words))
    h = np.array(flat, dtype=np.uint64)
    if len(h) < width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    out = np.zeros(len(h) - width + 1, dtype=np.uint64)
    for i in range(width):
        out = (out + h[i : len(h) - width + 1 + i]) * _M[i % 3]
        out ^= out >> np.uint64(31)
    same = doc[: len(out)] == doc[width - 1 :]
    return doc[: len(out)][same], mix(out[same])


def sorted_unique(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    first = np.ones(len(x), dtype=bool)
    first[1:] = x[1:] != x[:-1]
    return x[first]


def distinct_tokens(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, token), sorted; a token is the hash's upper TOKEN_BITS."""
    key = sorted_unique((doc.astype(np.uint64) << np.uint64(TOKEN_BITS)) | (hashes >> np.uint64(64 - TOKEN_BITS)))
    return (key >> np.uint64(TOKEN_BITS)).astype(np.int64), key & np.uint64((1 << TOKEN_BITS) - 1)
