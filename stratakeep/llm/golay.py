"""The binary Golay code (23, 12) over numpy arrays of 23-bit words.

The code is perfect: every word lies within three bits of exactly one
codeword. The keys of a word are the codewords that it and its one-bit
neighbours decode to, six at most. Two words at distance two share a neighbour
and therefore a key; a word at distance one decodes to a key of the other.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH = 23
CHECK_BITS = 11
# Generator polynomial of the code (fixed value).
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and the error of a syndrome."""
    low = np.array([_remainder(x) for x in range(1 << 12)], dtype=np.int32)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], dtype=np.int32)
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int32)
    for weight in range(4):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << bit for bit in bits)
            errors[_remainder(word)] = word
    return low, high, errors


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword within three bits of each word."""
    low, high, errors = _tables()
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> CHECK_BITS


def nearby(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of words that use the low ``width`` bits only.

    Returns a matrix with one row per word and a mask of its valid cells.
    """
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(words.dtype)
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    fresh = np.ones(found.shape, dtype=bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    order = np.argsort(~fresh, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(found, order, axis=1), np.take_along_axis(fresh, order, axis=1)
