"""SetSketch registers (Ertl, 2021): b = 1.001, exponentially spaced truncated minima, joint estimation by likelihood.

Each element draws one value per register, ascending, in a random order of the registers: its j-th value is an
exponential variable truncated to the j-th of m equally likely intervals. A register holds floor(1 - log_b(least value)).
Registers of a union are the maxima of the parts' registers; equal registers are as likely as the Jaccard similarity.
"""

from __future__ import annotations

import numpy as np

from starload.llm.words import mix

REGISTERS, BASE, RATE, TOP = 128, 1.001, 20.0, 65535


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """(rows, REGISTERS) of uint16; an empty set has zeros."""
    m = REGISTERS
    sizes = np.array([len(s) for s in sets], np.int64)
    e = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    least = np.ones(len(sets) * m)  # as probabilities, which ascend with the values
    order = mix(e ^ np.uint64(0xA0761D6478BD642F))
    place = (order & np.uint64(m - 1)).astype(np.int64)
    step = ((order >> np.uint64(8)) | np.uint64(1)).astype(np.int64) & (m - 1)
    at = row * m
    for j in range(m):
        u = (mix(e + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(least, at + place, (j + u) / m)
        going = least.reshape(-1, m).max(axis=1) > (j + 1) / m
        keep = going[row]
        if not keep.all():
            e, row, place, step, at = e[keep], row[keep], place[keep], step[keep], at[keep]
        if not len(e):
            break
        place = (place + step) & (m - 1)
    with np.errstate(divide="ignore"):
        value = -np.log1p(-least) / RATE
        registers = np.floor(1 - np.log(value) / np.log(BASE))
    registers = np.clip(np.nan_to_num(registers, neginf=0, posinf=TOP), 0, TOP).astype(np.uint16).reshape(-1, m)
    registers[sizes == 0] = 0
    return registers


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the unions."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of each pair of rows, by maximum likelihood of the registers' order, the sets' sizes being known."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = np.maximum(_p(np.maximum(u - v * j, 0)), 1e-12), np.maximum(_p(np.maximum(v - u * j, 0)), 1e-12)
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    for _ in range(30):  # the likelihood has one peak
        third = (high - low) / 3
        up = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(up, low + third, low), np.where(up, high, high - third)
    return (low + high) / 2
