"""Recompression of token sequences: runs and pairs get names, equal substrings equal inner symbols.

A name is a 64-bit hash of what it stands for, so naming is global without anybody keeping a table.
The first round names maximal runs of a token. Each further round parts the symbols into left and
right ones by a bit of their name and replaces every left-right pair by its name; such pairs cannot
overlap, so where a symbol ends depends on its neighbours only. Every symbol carries its extent, the
tokens that had to be seen to know that it stands there. A window sees the symbols whose extent it
holds, and what it sees depends on its own tokens alone. Hence equal windows see equal symbols, and
the rule that picks one (the longer, then the greater name) picks the same one in all of them.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 3
#: Lengths count up to this when a symbol is picked: longer ones are seen by few windows.
LONG = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RUN = np.uint64(0xD6E8FEB86659FD93)
_FAR = 1 << 40


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Symbols:
    """Symbols of one round: names, first token, extents [low, high), and length in tokens."""

    def __init__(self, name, start, low, high, size):
        self.name, self.start, self.low, self.high, self.size = name, start, low, high, size


def named_runs(tokens: np.ndarray) -> Symbols:
    """Maximal runs; to know one, its neighbours must be seen, which a text's ends never are."""
    n = len(tokens)
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    last = np.append(first[1:], n)
    size = last - first
    name = mixed(tokens[first] + _RUN * size.astype(np.uint64))
    low, high = first - 1, last + 1
    low[0], high[-1] = -_FAR, _FAR
    return Symbols(name, first, low, high, size)


def named_pairs(s: Symbols, turn: int) -> Symbols:
    """One round of pairs."""
    n = len(s.name)
    right = (mixed(s.name + np.uint64(turn)) & np.uint64(1)).astype(bool)
    joins = np.zeros(n, bool)  # with the next one
    joins[:-1] = ~right[:-1] & right[1:]
    joined = np.zeros(n, bool)
    joined[1:] = joins[:-1]
    # a left symbol stands alone as the next is left, a right one as the one before is right
    low, high = s.low.copy(), s.high.copy()
    high[:-1] = np.where(~right[:-1], s.high[1:], high[:-1])
    low[1:] = np.where(right[1:], s.low[:-1], low[1:])
    if not right[-1]:
        high[-1] = _FAR
    if right[0]:
        low[0] = -_FAR
    at = np.flatnonzero(joins)
    name, size = s.name.copy(), s.size.copy()
    low[at], high[at] = s.low[at], s.high[at + 1]
    name[at] = mixed(s.name[at] * _ODD + mixed(s.name[at + 1]) + np.uint64(turn))
    size[at] += s.size[at + 1]
    keep = ~joined
    return Symbols(name[keep], s.start[keep], low[keep], high[keep], size[keep])


def window_keys(tokens: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` tokens the key of the symbol it picks; uint64.

    The upper 6 bits are the symbol's length (up to ``LONG``). A window that sees nothing but single tokens takes one
    of those: tokens are symbols of their own extent.
    """
    n_windows = len(tokens) - width + 1
    if n_windows <= 0:
        return np.empty(0, np.uint64)
    at = np.arange(len(tokens))
    levels = [Symbols(mixed(tokens), at, at, at + 1, np.ones(len(tokens), np.int64))]
    symbols = named_runs(tokens)
    levels.append(symbols)
    for turn in range(1, ROUNDS + 1):
        symbols = named_pairs(symbols, turn)
        levels.append(symbols)
    best = np.zeros(n_windows, np.uint64)
    for level in levels:
        rank = (np.minimum(level.size, LONG).astype(np.uint64) << np.uint64(58)) | (level.name >> np.uint64(6))
        # extents grow with the place, so a window sees consecutive symbols
        first = _reached(level.low + 1, n_windows)
        stop = _reached(level.high - width, n_windows)
        np.maximum(best, _range_max(rank, first, stop, width), out=best)
    return best


def _reached(places: np.ndarray, n: int) -> np.ndarray:
    """How many of ``places`` are at or before each of 0 .. n - 1."""
    return np.cumsum(np.bincount(np.clip(places, 0, n), minlength=n + 1)[:n])


def _range_max(values: np.ndarray, first: np.ndarray, stop: np.ndarray, most: int) -> np.ndarray:
    """Greatest of values[first:stop] for ranges of up to ``most``; 0 for empty ones."""
    count = stop - first
    out = np.zeros(len(first), np.uint64)
    table, reach = values, 1
    while reach <= most:
        pick = np.flatnonzero((count >= reach) & (count < 2 * reach))
        if len(pick):
            out[pick] = np.maximum(table[first[pick]], table[stop[pick] - reach])
        if len(table) <= reach:
            break
        table = np.maximum(table[:-reach], table[reach:])
        reach *= 2
    return out


class Prefixes:
    """Polynomial hashes of all substrings of a sequence, modulo 2**64, after mixing its values."""

    BASE = 0xD1342543DE82EF95

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.inverse = powers(pow(self.BASE, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(values.astype(np.uint64) + _ODD) * powers(self.BASE, n), out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of [start, stop) for each pair; the length is part of it."""
        value = (self.sums[stop] - self.sums[start]) * self.inverse[start]
        return mixed(value + (stop - start).astype(np.uint64) * _RUN)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64, kept up to a million."""
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        size = max(count, 1024)
        known = np.ones(size, np.uint64)
        known[1:] = base
        np.cumprod(known, out=known)
        if size <= 1 << 20:
            _POWERS[base] = known
    return known[:count]
