"""Hashes of word shingles, vectorised over the bytes of a text.

Words are runs of bytes other than blank and 0x09-0x0D, with A-Z in lower case. A word's 64-bit hash is
a polynomial of its bytes, taken from prefix sums, and its length; a shingle's hash mixes those of its
words. Texts with fewer words than a shingle have one shingle, the whole sequence.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_random = np.random.default_rng(7)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANK, _TAB, _BLANKS = np.uint8(0x20), np.uint8(0x09), np.uint8(5)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = list(_random.integers(0, 1 << 63, 64, "u8") * np.uint64(2) + np.uint64(1))
_S27, _S30, _S31 = np.uint64(27), np.uint64(30), np.uint64(31)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, made once and lengthened when needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, "u8")

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << n.bit_length()
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, "u8")])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, _INVERSE, "u8")])
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> _S30)
    x *= _M1
    x ^= x >> _S27
    x *= _M2
    x ^= x >> _S31
    return x


def word_hashes(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, "u8")
    raw = np.frombuffer(data.translate(_LOWER), "u1")
    outside = np.ones(len(raw) + 2, bool)
    # 0x09-0x0D are the five bytes from a tab on; smaller ones wrap around
    np.logical_or(raw == _BLANK, raw - _TAB < _BLANKS, out=outside[1:-1])
    edges = np.flatnonzero(outside[1:] != outside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers.first(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, "u8")
    np.cumsum(raw * up[:-1], out=sums[1:])
    words = sums.take(ends)
    words -= sums.take(starts)
    words *= down.take(starts)
    words += (ends - starts).view("u8") * _LENGTH
    return mix(words)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    ordered = np.sort(hashes)
    if len(ordered) < 2:
        return ordered
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of all shingles of a text in order, repeats included; empty without words."""
    hashes = word_hashes(text.encode())
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, words)
    total = np.full(n - width + 1, width, "u8")
    for k in range(width):
        total += hashes[k : n - width + 1 + k] * _PLACE[k]
    return mix(total)
