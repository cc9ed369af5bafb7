"""Rolling hashes of word k-grams, for whole batches of texts at a time.

Words are runs of characters that are an ASCII letter or digit or lie beyond
ASCII, A-Z lowered.  In UTF-8 that is a property of single bytes, so words are
found and hashed over the flat bytes of a batch without a loop over rows.

Hashes are 64 bits wide.  A byte has a random number; a word's hash is the
polynomial of its bytes, taken from running sums and spread by a finalizer; a
k-gram's is the polynomial of its words' hashes, spread as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_IS_WORD = np.array([48 <= b < 58 or 97 <= b < 123 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b < 91 else b for b in range(256)], np.uint8)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_CHUNK = 1 << 21  # bytes of text for which running sums are kept at a time


_DOWN = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(_DOWN))


def spread(h: np.ndarray) -> np.ndarray:
    """Finalizer that lets every bit of a 64-bit number affect every other."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BYTE = spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(4)
def powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least n places."""
    size = max(_CHUNK, 1 << max(n, 1).bit_length())
    return powers(size), powers(size, pow(_BASE, -1, 1 << 64))


def chunks(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Consecutive rows of at most about ``_CHUNK`` bytes together; a longer row is a chunk of its own."""
    lo = 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + _CHUNK, side="right")) - 1)
        yield data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]
        lo = hi


def word_hashes(data: np.ndarray, bounds: np.ndarray, of_word: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and number of words of each row; ``of_word`` says which bytes, lowered, words are made of."""
    n_rows = len(bounds) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    data = _LOWER[data]
    is_word = of_word[data]
    before = np.concatenate([[False], is_word[:-1]])
    after = np.concatenate([is_word[1:], [False]])
    inner = bounds[1:-1][bounds[1:-1] < len(data)]
    before[inner] = False
    after[inner[inner > 0] - 1] = False
    starts, ends = np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1
    up, down = power_table(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])
    h = spread((sums[ends] - sums[starts]) * down[starts])
    return h, np.diff(np.searchsorted(starts, bounds))


def gram_hashes(words: np.ndarray, n_words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k-gram within a row, in order, and number of k-grams of each row."""
    n_grams = np.maximum(n_words - k + 1, 0)
    if len(words) < k:
        return np.zeros(0, np.uint64), n_grams
    up, size = powers(64), len(words) - k + 1
    h = np.zeros(size, np.uint64)
    for i in range(k):
        h += words[i:i + size] * up[k - i]
    row = np.repeat(np.arange(len(n_words)), n_words)
    return spread(h[row[:size] == row[k - 1:]] + np.uint64(k)), n_grams


def phrase_grams(words: list[str], k: int) -> np.ndarray:
    """Hashes of a phrase's k-grams, as ``gram_hashes`` gives them."""
    raw = " ".join(words).encode()
    h, n = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    return gram_hashes(h, n, k)[0]
