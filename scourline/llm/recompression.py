"""Recompression of token sequences: consistent names for equal stretches of tokens.

A sequence is rewritten in rounds.  A round replaces each maximal run of one symbol by a
symbol for the run, then each pair ``ab`` with ``a`` on the left and ``b`` on the right
side of a split of the alphabet by a symbol for the pair.  Names and sides are functions of
content alone (64-bit hashes), so tasks that never speak to each other give equal names to
equal stretches, and what Spark counts by name is counted globally.

Every symbol carries the *reach* of its making: the tokens that decided that it, and no
other symbol, stands there.  Wherever the tokens of its reach occur, the same symbol
appears; so two equal windows that hold the reach of a symbol share that symbol.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MULT_1 = np.uint64(0xBF58476D1CE4E5B9)
_MULT_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finaliser of splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _MULT_1
    x = (x ^ (x >> np.uint64(27))) * _MULT_2
    return x ^ (x >> np.uint64(31))


class Symbols(NamedTuple):
    """Symbols in order: name, first token, and reach ``[low, high)`` in tokens."""

    name: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray


def tokens_as_symbols(names: np.ndarray) -> Symbols:
    at = np.arange(len(names), dtype=np.int64)
    return Symbols(names, at, at, at + 1)


def compress_runs(s: Symbols, wall: np.ndarray, salt: int) -> tuple[Symbols, np.ndarray]:
    """Maximal runs of a name become one symbol; ``wall[i]``: a text begins at symbol i."""
    n = len(s.name)
    first = wall.copy()
    first[1:] |= s.name[1:] != s.name[:-1]
    heads = np.flatnonzero(first)
    length = np.diff(np.append(heads, n))
    name = s.name[heads]
    many = length > 1
    name[many] = mix(name[many] ^ mix(length[many].astype(np.uint64) + np.uint64(salt << 40)))
    last = heads + length - 1
    # That a run ends here is decided by its neighbours; at the ends of a text, too.
    low = np.where(wall[heads], s.low[heads] - 1, s.low[heads - 1])
    after = np.minimum(last + 1, n - 1)
    ends = (last + 1 == n) | wall[after]
    high = np.where(ends, s.high[last] + 1, s.high[after])
    low = np.minimum(low, s.low[heads])
    high = np.maximum(high, s.high[last])
    return Symbols(name, s.start[heads], low, high), wall[heads]


def compress_pairs(s: Symbols, wall: np.ndarray, salt: int) -> tuple[Symbols, np.ndarray]:
    """Pairs of a left and a right symbol become one symbol."""
    n = len(s.name)
    right = (mix(s.name ^ np.uint64(salt)) & np.uint64(1)).astype(bool)
    joins = np.zeros(n, bool)  # with the next one
    joins[:-1] = ~right[:-1] & right[1:] & ~wall[1:]
    taken = np.zeros(n, bool)
    taken[1:] = joins[:-1]
    left = np.flatnonzero(joins)
    name = s.name.copy()
    name[left] = mix(s.name[left] * _GOLD + mix(s.name[left + 1] ^ np.uint64(salt)))
    low, high = s.low.copy(), s.high.copy()
    # A left symbol stays alone because of its right neighbour, and the other way round.
    lone = ~joins & ~taken
    a = np.flatnonzero(lone & ~right)
    b = np.minimum(a + 1, n - 1)
    high[a] = np.where((a + 1 == n) | wall[b], s.high[a] + 1, np.maximum(s.high[b], s.high[a]))
    a = np.flatnonzero(lone & right)
    low[a] = np.where(wall[a], s.low[a] - 1, np.minimum(s.low[a - 1], s.low[a]))
    low[left] = np.minimum(low[left], s.low[left + 1])
    high[left] = np.maximum(s.high[left], s.high[left + 1])
    keep = ~taken
    return Symbols(name[keep], s.start[keep], low[keep], high[keep]), wall[keep]


def recompress(names: np.ndarray, wall: np.ndarray, rounds: int, runs: int = 1) -> Symbols:
    """The symbols after ``rounds`` rounds; runs are compressed in the first ``runs``."""
    symbols = tokens_as_symbols(names)
    if not len(names):
        return symbols
    for k in range(1, rounds + 1):
        if k <= runs:
            symbols, wall = compress_runs(symbols, wall, k)
        symbols, wall = compress_pairs(symbols, wall, k)
    return symbols
