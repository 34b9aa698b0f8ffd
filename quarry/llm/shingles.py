"""Word shingles of texts as 64-bit hashes, computed on flat byte arrays.

A word's hash sums its 8-byte pieces, each mixed with its number by a bijection
of 64-bit values that spreads every bit; a shingle's hash mixes its words'
hashes in order. No step is a polynomial, so words of a regular build (such as
the Thue-Morse word, on which polynomials modulo 2**64 agree whatever their
base) are no special case: two different shingles agree as two random 64-bit
values do.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240229)
BYTE_VALUE = _RNG.integers(0, 2 ** 64, 256, np.uint64)
BASE = int(_RNG.integers(0, 2 ** 63, dtype=np.uint64)) * 2 + 1
PIECE_SEED = np.uint64(0x9E3779B97F4A7C15)
WORD_FACTOR = _RNG.integers(0, 2 ** 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    out = []
    for base in (BASE, pow(BASE, -1, 2 ** 64)):
        p = np.full(n, np.uint64(base))
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    f, b = _powers(size)
    return f[:n], b[:n]


def prefix(data: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """Prefix sums p with p[j] - p[i] the polynomial of data[i:j] times BASE**i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data) + 1)[0][:-1], out=out[1:])
    return out


def _word_hashes(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The hash of each word; `letters` holds their bytes one after the other."""
    if not len(length):
        return np.zeros(0, np.uint64)
    at = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)      # place in the word
    starts = np.flatnonzero((at & 7) == 0)
    pieces = np.add.reduceat(letters.astype(np.uint64) << ((at & 7) << 3).astype(np.uint64), starts)
    pieces = mix(pieces ^ mix((at[starts] >> 3).astype(np.uint64) + PIECE_SEED))
    return mix(np.add.reduceat(pieces, np.flatnonzero(at[starts] == 0)) + length.astype(np.uint64))


def word_table(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(hash, begin, end of each word, first word of each text). Texts are
    data[offsets[i]:offsets[i+1]]; words are runs of bytes other than \\x20
    and \\x09-\\x0D, hashed with A-Z lower-cased if `lower`."""
    base = int(offsets[0])
    d = data[base:int(offsets[-1])]
    off = offsets - base
    none = np.zeros(0, np.int64)
    if not len(d):
        return np.zeros(0, np.uint64), none, none, np.zeros(len(off), np.int64)
    inside = ~SPACES[d]
    first = np.zeros(len(d) + 1, bool)          # texts begin here
    first[off] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    h = _word_hashes((LOWER[d] if lower else d)[inside], end - start)
    return h, start, end, np.searchsorted(start, off)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int):
    """(hashes, offsets): each text's k-word shingles in order, repeats
    included; a text of fewer words has its whole sequence as one, a text
    without words none."""
    w, _, _, at = word_table(data, offsets)
    return join_words(w, at, k)


def join_words(w: np.ndarray, at: np.ndarray, k: int):
    """The same from the words' hashes."""
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_at = np.r_[0, np.cumsum(count)]
    h = np.zeros(int(out_at[-1]), np.uint64)
    if not len(h):
        return h, out_at
    text = np.repeat(np.arange(len(n)), count)
    start = at[:-1][text] + (np.arange(len(h)) - out_at[:-1][text])
    size = np.minimum(n[text], k)
    padded = np.r_[w, np.zeros(k, np.uint64)]
    for t in range(k):
        x = padded[start + t] * WORD_FACTOR[t]
        h += np.where(t < size, x, np.uint64(0))
    return mix(h + size.astype(np.uint64)), out_at


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    h, at = shingle_hashes(data, offsets, k)
    return [np.unique(h[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
