"""Vectorised names (64-bit hashes) of words and of stretches of words."""

from __future__ import annotations

import numpy as np

# Odd multiplier of the polynomial names, and the mixing steps of splitmix64.
BASE = 0x9E3779B97F4A7C15
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
LENGTH = 0x8EBC6AF09C88C6E3

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(9, 14)]] = True

_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in MIX:
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        have = _powers[base] = np.cumprod(factors)
    return have[:n]


def stretch_names(x: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial names of the stretches x[begin:end], wherever they stand."""
    sums = np.r_[np.uint64(0), np.cumsum(x * powers(base, len(x)))]
    inverse = pow(base, -1, 1 << 64)
    return (sums[end] - sums[begin]) * powers(inverse, len(x) + 1)[begin]


class Words:
    """Words of some texts in one sequence; doc is the text each belongs to."""

    def __init__(self, texts: list):
        self.data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        raw = np.frombuffer(b"\n".join([*self.data, b""]), np.uint8)
        edge = np.flatnonzero(np.diff(np.r_[True, BLANK[raw]].astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        offsets = np.r_[0, np.cumsum([len(d) + 1 for d in self.data])]
        first = np.searchsorted(begin, offsets)
        self.first, self.count = first[:-1], np.diff(first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.place = np.arange(len(begin)) - self.first[self.doc]
        names = stretch_names(raw.astype(np.uint64) + np.uint64(1), begin, end, BASE)
        self.names = mixed(names ^ ((end - begin).astype(np.uint64) * np.uint64(LENGTH)))
