"""The binary Golay code of length 23: every word is within three bits of exactly one of 4096 codewords."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR = 0b110001110101


def remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the upper 12 and the lower 11 bits, and the error that each remainder stands for."""
    upper = np.array([remainder(i << CHECKS) for i in range(1 << 12)], np.int64)
    lower = np.arange(1 << CHECKS, dtype=np.int64)
    errors = np.zeros(1 << CHECKS, np.int64)
    for weight in range(1, 4):
        for bits in combinations(range(LENGTH), weight):
            error = sum(1 << b for b in bits)
            errors[remainder(error)] = error
    return upper, lower, errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each word."""
    upper, lower, errors = tables()
    return (words ^ errors[upper[words >> CHECKS] ^ lower[words & ((1 << CHECKS) - 1)]]) >> CHECKS


def nearby(words: np.ndarray, width: int) -> np.ndarray:
    """Indices of the codewords nearest to each word and to its one-bit neighbours in the low ``width`` bits.

    Two words that differ in two bits have a neighbour in common, so they have an index in common. Most words
    lie three bits off their codeword and get several indices. One row per word, sorted, -1 for repetitions.
    """
    found = np.stack([decode(words)] + [decode(words ^ (1 << b)) for b in range(width)], axis=1)
    found.sort(axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
