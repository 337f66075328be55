"""A compressed FM-index over words: the Burrows-Wheeler transform in a wavelet matrix of packed bits with rank counts.

Suffixes are sorted by their first ``DEPTH`` symbols, or more on demand, which is enough for patterns up to that. All searches run
in step for many queries at once.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64
_ONE, _LOW6 = np.uint64(1), np.uint64(63)


class Bits:
    """A bit vector in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(np.append(packed, np.zeros(16 - len(packed) % 8, np.uint8)).tobytes(), np.uint64)
        ones = np.bitwise_count(self.words)
        self.before = np.zeros(len(ones) + 1, np.int32)
        np.cumsum(ones, out=self.before[1:])
        self.zeros = len(bits) - int(bits.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of each position."""
        w = i >> 6
        below = (_ONE << (i.astype(np.uint64) & _LOW6)) - _ONE
        return self.before[w] + np.bitwise_count(self.words[w] & below)


class FMIndex:
    """``symbols``: integers from 0 (a separator, never searched) to ``size`` - 1."""

    def __init__(self, symbols: np.ndarray, size: int, depth: int = DEPTH) -> None:
        n = len(symbols)
        order = suffixes(symbols, depth)
        bwt = symbols[order - 1]
        counts = np.bincount(symbols, minlength=size)
        self.n = n
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.levels: list[Bits] = []
        self.width = max(1, int(size - 1).bit_length())
        for shift in range(self.width - 1, -1, -1):
            bit = (bwt >> shift & 1).astype(bool)
            self.levels.append(Bits(bit))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        values = np.arange(size, dtype=np.int64)
        self.origin = self._down(values, np.zeros(size, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits in enumerate(self.levels):
            one = (symbol >> (self.width - 1 - k) & 1).astype(bool)
            ones = bits.rank(i)
            i = np.where(one, bits.zeros + ones, i - ones)
        return i

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of the patterns with ``symbol`` put in front."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol] - self.origin[symbol]
        return both[: len(symbol)] + base, both[len(symbol) :] + base


def suffixes(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions in the order of the suffixes' first ``depth`` symbols or more, by prefix doubling."""
    n = len(symbols)
    rank, k = symbols.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key)
        new = np.empty(n, np.int64)
        ordered = key[order]
        new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank, k = new, 2 * k
        if n and rank[order[-1]] == n - 1:
            break
    return order


def repeated_windows(index: FMIndex, symbols: np.ndarray, start: np.ndarray, stop: np.ndarray, size: int, probe: int = 8) -> np.ndarray:
    """Bits over all positions: at 1 starts a window of ``size`` symbols that occurs at least twice in the index.

    ``start:stop`` are the queries' segments in ``symbols``. From an end e the search goes back while the pattern occurs
    twice; where it fails, at p, the matching statistic of e is e - p. All windows inside the match occur twice. Windows
    that start at p or before and end at e or later do not. A short probe, the ``probe`` symbols from p on, mostly shows
    that no window through them does, which decides many windows at once; else the next end is tried, with twice the probe.
    """
    found = np.zeros(len(symbols) + 1, np.int32)
    live = stop - start >= size
    n = int(live.sum())
    s = {
        "first": start[live].astype(np.int64), "end": stop[live].astype(np.int64) - 1, "from": stop[live].astype(np.int64) - 1, "at": stop[live].astype(np.int64) - 1,
        "low": np.zeros(n, np.int64), "high": np.full(n, index.n, np.int64), "p": np.full(n, -1, np.int64), "length": np.full(n, probe, np.int64), "probing": np.zeros(n, bool),
    }
    while len(s["first"]):
        low, high = index.extend(symbols[s["at"]], s["low"], s["high"])
        good = high - low >= 2
        s["low"], s["high"] = low, high
        s["at"] -= good
        over = ~good | (s["at"] < np.where(s["probing"], s["p"], s["first"]))
        k = np.flatnonzero(over)
        if not len(k):
            continue
        at, end, first, probing = s["at"][k], s["end"][k], s["first"][k], s["probing"][k]
        # a search from an end: mark the windows in its match, then probe from where it failed
        hit = ~probing & (end - at >= size)
        np.add.at(found, (at + 1)[hit], 1)
        np.add.at(found, (end - size + 2)[hit], -1)
        p = np.where(probing, s["p"][k], at)
        length = np.where(probing | (p == s["p"][k]), s["length"][k], probe)
        fails = probing & (at >= p)
        length = np.where(probing & ~fails, 2 * length, length)
        end = np.where(probing, np.where(fails, s["from"][k] - 1, end), np.minimum(end - 1, p + size - 1))
        again = ~probing & (p + length - 1 < end)
        s["p"][k], s["length"][k], s["end"][k], s["probing"][k] = p, length, end, again
        s["from"][k] = s["at"][k] = np.where(again, p + length - 1, end)
        s["low"][k], s["high"][k] = 0, index.n
        done = np.zeros(len(over), bool)
        done[k] = (p < first) | (end - size + 1 < first)
        if done.any():
            s = {name: v[~done] for name, v in s.items()}
    return np.cumsum(found[:-1]) > 0
