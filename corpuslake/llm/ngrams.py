"""A modified Kneser-Ney model over bytes, kept and looked up in sorted hash arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

ORDER = 4
#: Bits of a hash that point to where its neighbours begin in the sorted array.
_RADIX = 16
_ODD = np.uint32(0x9E3779B1)
#: Digits are one symbol, white space but the line feed another; all other bytes stand for themselves.
SYMBOL = np.arange(256, dtype=np.uint32)
SYMBOL[48:58] = 48
SYMBOL[[9, 11, 12, 13]] = 32
FIRST = np.full(ORDER - 1, 10, np.uint32)


def symbols(text: bytes) -> np.ndarray:
    return SYMBOL[np.frombuffer(text, np.uint8)]


def grams(text: bytes) -> np.ndarray:
    """The ORDER-gram that ends at each byte, packed; a text begins after line feeds."""
    s = np.concatenate([FIRST, symbols(text)])
    return s[:-3] << np.uint32(24) | s[1:-2] << np.uint32(16) | s[2:-1] << np.uint32(8) | s[3:]


def hashed(packed: np.ndarray) -> np.ndarray:
    """A number of 32 bits, another one for every gram, spread over the whole range."""
    h = packed * _ODD
    return (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)


class HashArray:
    """Values of grams by the sorted hashes of these."""

    def __init__(self, packed: np.ndarray, values: np.ndarray) -> None:
        h = hashed(packed.astype(np.uint32))
        order = np.argsort(h)
        self.hashes, self.values = h[order], values[order].astype(np.float32)
        self.begin = np.searchsorted(self.hashes >> np.uint32(32 - _RADIX), np.arange((1 << _RADIX) + 1)).astype(np.int32)
        self.steps = int(np.diff(self.begin).max(initial=0))

    def find(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether it is there, its value) of each gram."""
        found, value = np.zeros(len(packed), bool), np.zeros(len(packed), np.float32)
        if not len(self.hashes):
            return found, value
        h = hashed(packed)
        at = np.searchsorted(self.hashes, h) if len(packed) < 64 else self._place(h)
        at[at == len(self.hashes)] = 0
        found = self.hashes[at] == h
        value[found] = self.values[at[found]]
        return found, value

    def _place(self, h: np.ndarray) -> np.ndarray:
        """The first hash that is not smaller: bisection between the ends that the leading bits point to."""
        bucket = (h >> np.uint32(32 - _RADIX)).astype(np.int32)
        low, high = self.begin[bucket], self.begin[bucket + 1]
        for _ in range(max(1, self.steps).bit_length()):
            middle = (low + high) >> 1
            less = (middle < high) & (self.hashes[np.minimum(middle, len(self.hashes) - 1)] < h)
            low = np.where(less, middle + 1, low)
            high = np.where(less, high, middle)
        return low


def discounts(of_counts: Sequence[int]) -> np.ndarray:
    """What modified Kneser-Ney takes off counts of 0, 1, 2, and 3 or more, from how many grams have counts 1 to 4."""
    n1, n2, n3, n4 = (max(int(n), 0) for n in of_counts)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k * 0.95) for k, d in enumerate(raw, 1))])


class Model:
    """Probabilities of a byte after the three before it.

    ``counts`` has (packed grams, counts) from ORDER down to 1: the highest as they occur, the lower ones as the number of
    different bytes they follow. A gram that is not there has what its context sets aside times the next order's.
    """

    def __init__(self, counts: Sequence[tuple[np.ndarray, np.ndarray]]) -> None:
        self.tables: list[HashArray] = []
        self.weights: list[HashArray] = []
        lower = None
        for order in range(1, ORDER + 1):
            packed, count = counts[ORDER - order]
            packed, count = packed.astype(np.uint32), count.astype(float)
            take = discounts([(count == i).sum() for i in (1, 2, 3, 4)])[np.minimum(count, 3).astype(int)]
            context = packed >> np.uint32(8) if order > 1 else np.zeros(len(packed), np.uint32)
            own, inverse = np.unique(context, return_inverse=True)
            whole = np.bincount(inverse, count, len(own))
            aside = np.bincount(inverse, take, len(own)) / np.maximum(whole, 1e-300)
            if order == 1:
                below = np.full(len(packed), 1 / 256)
                self.unseen = np.log(aside[0] / 256) if len(own) else np.log(1 / 256)
            else:
                below = np.exp(lower.log_prob(packed & np.uint32((1 << 8 * (order - 1)) - 1), order - 1))
            p = (count - take) / np.maximum(whole[inverse], 1e-300) + aside[inverse] * below
            self.tables.append(HashArray(packed, np.log(p)))
            self.weights.append(HashArray(own, np.log(np.maximum(aside, 1e-12))))
            lower = self

    def log_prob(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log of the probability of each gram's last byte after the others."""
        found, value = self.tables[order - 1].find(packed)
        out = value.astype(float)
        rest = np.nonzero(~found)[0]
        if len(rest):
            left = packed[rest]
            if order == 1:
                out[rest] = self.unseen
            else:
                _, weight = self.weights[order - 1].find(left >> np.uint32(8))  # a context that is not there sets all aside
                out[rest] = weight + self.log_prob(left & np.uint32((1 << 8 * (order - 1)) - 1), order - 1)
        return out

    def known(self, packed: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum of the log probabilities, and the grams that have none here."""
        return float(self.log_prob(packed).sum()), packed[:0]


class Part:
    """Log probabilities of some grams of a model that has more than a task holds; ``number`` names the model in its tables."""

    def __init__(self, number: int, packed: np.ndarray, log_p: np.ndarray) -> None:
        self.number, self.tables = number, [HashArray(packed, log_p)]

    def known(self, packed: np.ndarray) -> tuple[float, np.ndarray]:
        """As of ``Model``."""
        found, value = self.tables[0].find(packed)
        return float(value[found].sum(dtype=float)), packed[~found]


def lower_counts(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram without its first byte, number of different first bytes) of different grams of ORDER 4 or less."""
    return np.unique(packed, return_counts=True)


def counts_of(texts: Sequence[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The counts that a model is made of, from a few texts."""
    top, n = np.unique(np.concatenate([grams(t) for t in texts] or [np.zeros(0, np.uint32)]), return_counts=True)
    return all_orders(top, n)


def all_orders(packed: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of all orders from those of the highest."""
    out = [(packed, counts)]
    for order in range(ORDER - 1, 0, -1):
        out.append(lower_counts(out[-1][0] & np.uint32((1 << 8 * order) - 1)))
    return out
