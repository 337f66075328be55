"""Words and their hashes, for a whole Arrow column of texts at once.

A word is a run of bytes other than space and tab to carriage return (0x20, 0x09-0x0D). Its hash is a polynomial
over random byte values modulo 2**64, taken from one prefix sum over the column and then mixed; shingles and longer
windows use the same prefix-sum trick over the words' hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
#: Bytes hashed at once.
_CHUNK = 1 << 20


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _CACHE.get(base)
    if have is None or len(have[0]) < n:
        have = _powers(base, max(n, 2 * _CHUNK))
        if n <= 8 * _CHUNK:
            _CACHE[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """``first[i]:first[i + 1]`` are the words of row i; a word is ``data[start:end]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def text(self, a: int, b: int) -> list[bytes]:
        raw = self.data
        return [raw[s:e].tobytes() for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), strict=True)]


def words_of(text: pa.Array, lower: bool = False) -> Words:
    """``text``: large_string without nulls."""
    _, offsets, data = text.buffers()
    rows = len(text)
    bounds = np.frombuffer(offsets, dtype=np.int64)[text.offset : text.offset + rows + 1] if rows else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None and rows else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = ~_SPACE[raw]
    n = len(raw)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = np.unique(bounds[1:-1])
    edge = edge[(edge > 0) & (edge < n)]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, bounds)
    return Words(raw, start, end, first, _hash(raw, start, end, _LOWER if lower else _BYTES))


def _hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=np.uint64)
    k = 0
    while k < len(start):
        at = int(start[k])
        stop = max(k + 1, int(np.searchsorted(end, at + _CHUNK, side="right")))
        part = raw[at : int(end[stop - 1])]
        up, down = powers(_BASE, len(part))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(values[part] * up, out=total[1:])
        s, e = start[k:stop] - at, end[k:stop] - at
        out[k:stop] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        k = stop
    return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words; windows that cross rows are there too, for the caller to leave out."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(_WORD_BASE, n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up, out=total[1:])
    return mix((total[size:] - total[:-size]) * down[: n - size + 1] + np.uint64(size))


def span_hash(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hash of the words ``start:stop`` of each span, with a salt."""
    up, down = powers(_WORD_BASE, len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix(mix((total[stop] - total[start]) * down[start]) + salt.astype(np.uint64) * np.uint64(_BASE))


def shingle_sets(w: Words, size: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``size``-word shingles; fewer words make one shingle, none an empty set."""
    all_of = windows(w.hash, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(all_of[a : b - size + 1]))
        elif b > a:
            out.append(windows(w.hash[a:b], b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
