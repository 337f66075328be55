"""A static range asymmetric numeral system over token ids, vectorised over independent blocks and their lanes.

An image holds the ids of some whole documents. It has one frequency table (sum 2**18) that all its blocks share.
A block is ``BLOCK`` ids in ``LANES`` interleaved lanes with a word stream of its own, so blocks decode in parallel;
every ``STEPS`` steps a checkpoint keeps the lanes' states and the place in the stream, so that parts of a block do too.
Layout, little-endian, sections in this order: magic ``TRNS``, five u32 (ids, documents, symbols, blocks, crc32 of the
rest), symbols u32 and frequencies u32, document ids i64 with a null flag byte each, document lengths u32, per block
its number of words u32 and the crc32 of its ids u32, checkpoint states u64 and stream places u32, word streams u32.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

LANES, BLOCK, STEPS, SCALE = 64, 1 << 16, 256, 18
LOW = np.uint64(1 << 31)
_PARTS = BLOCK // LANES // STEPS
_HEAD = struct.Struct("<4s5I")


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Integers of sum 2**SCALE, at least 1 each, near the share of each count. Fewer than 2**SCALE symbols."""
    total = 1 << SCALE
    out = np.maximum(1, counts * total // counts.sum()).astype(np.int64)
    gap = total - int(out.sum())
    order = np.argsort(-out, kind="stable")
    for k in order.tolist() if gap < 0 else order[:1].tolist():
        step = gap if gap > 0 else -min(-gap, int(out[k]) - 1)
        out[k] += step
        gap -= step
        if not gap:
            break
    return out


def encode(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    n = len(ids)
    of_id = np.bincount(ids)
    symbols = np.flatnonzero(of_id)
    counts, number = of_id[symbols], np.zeros(len(of_id), np.int32)
    number[symbols] = np.arange(len(symbols))
    coded = number[ids]
    freq = frequencies(counts) if n else np.zeros(0, np.int64)
    cum = np.cumsum(freq) - freq
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, int(np.argmax(counts)) if n else 0, np.int32)
    padded[:n] = coded
    steps = BLOCK // LANES
    lanes = np.ascontiguousarray(padded.reshape(blocks, steps, LANES).transpose(1, 0, 2))
    f64, c64 = freq.astype(np.uint64), cum.astype(np.uint64)
    state = np.full((blocks, LANES), LOW)
    words, sent = np.zeros((steps, blocks, LANES), np.uint32), np.zeros((steps, blocks, LANES), bool)
    marks = np.zeros((blocks, _PARTS, LANES), np.uint64)
    limit = np.uint64(int(LOW) >> SCALE << 32)
    for t in range(steps - 1, -1, -1):
        f, c = f64[lanes[t]], c64[lanes[t]]
        out = state >= limit * f
        words[t], sent[t] = state.astype(np.uint32), out
        state = np.where(out, state >> np.uint64(32), state)
        q = state // f
        state = (q << np.uint64(SCALE)) + (state - q * f) + c
        if t % STEPS == 0:
            marks[:, t // STEPS] = state
    per_part = sent.reshape(_PARTS, STEPS, blocks, LANES).sum(axis=(1, 3)).T.astype(np.int64) if blocks else np.zeros((0, _PARTS), np.int64)
    places = (np.cumsum(per_part, axis=1) - per_part).astype("<u4")
    streams = [words[:, b][sent[:, b]].astype("<u4").tobytes() for b in range(blocks)]
    raw = ids.astype("<u4")
    sums = [zlib.crc32(raw[b * BLOCK : (b + 1) * BLOCK].tobytes()) for b in range(blocks)]
    body = b"".join(
        [
            symbols.astype("<u4").tobytes(),
            freq.astype("<u4").tobytes(),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            bytes(d is None for d in doc_ids),
            np.asarray(lengths, "<u4").tobytes(),
            np.array([len(s) // 4 for s in streams], "<u4").tobytes(),
            np.array(sums, "<u4").tobytes(),
            marks.astype("<u8").tobytes(),
            places.tobytes(),
            *streams,
        ]
    )
    return _HEAD.pack(b"TRNS", n, len(doc_ids), len(symbols), blocks, zlib.crc32(body)) + body


@dataclass
class Image:
    ids: np.ndarray
    doc_ids: list[int | None]
    lengths: np.ndarray


def decode(image: bytes) -> Image:
    """The reverse of ``encode``; every checkpointed part of every block is decoded at once. Raises on a bad checksum."""
    magic, n, docs, size, blocks, crc = _HEAD.unpack_from(image)
    if magic != b"TRNS" or zlib.crc32(memoryview(image)[_HEAD.size :]) != crc:
        raise ValueError("not a token image, or a damaged one")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(image, kind, count, at)
        at += out.nbytes
        return out

    symbols, freq, ids64, nulls, lengths = take("<u4", size), take("<u4", size).astype(np.uint64), take("<i8", docs), take("u1", docs), take("<u4", docs)
    sizes, sums = take("<u4", blocks).astype(np.int64), take("<u4", blocks)
    state = take("<u8", blocks * _PARTS * LANES).reshape(blocks * _PARTS, LANES).copy()
    places = take("<u4", blocks * _PARTS).astype(np.int64)
    stream = take("<u4", int(sizes.sum()))
    begin = np.repeat(np.cumsum(sizes) - sizes, _PARTS) + places
    cum = np.cumsum(freq) - freq
    symbol_of = np.repeat(np.arange(size, dtype=np.int32), freq.astype(np.int64))
    out = np.zeros((blocks * _PARTS, STEPS, LANES), np.int32)
    mask, low32 = np.uint64((1 << SCALE) - 1), np.uint64(32)
    stream = np.append(stream, np.zeros(1, "<u4")).astype(np.uint64)
    for t in range(STEPS if blocks else 0):
        slot = state & mask
        s = symbol_of[slot]
        out[:, t] = s
        state = freq[s] * (state >> np.uint64(SCALE)) + slot - cum[s]
        need = state < LOW
        rank = np.cumsum(need, axis=1)
        word = stream[np.minimum(begin[:, None] + rank - 1, len(stream) - 1)]
        state = np.where(need, (state << low32) | word, state)
        begin = begin + rank[:, -1]
    ids = symbols[out.reshape(-1)[:n]] if n else np.zeros(0, np.uint32)
    for b, want in enumerate(sums.tolist()):
        if zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK].astype("<u4").tobytes()) != want:
            raise ValueError(f"block {b} is damaged")
    return Image(ids, [None if z else int(d) for d, z in zip(ids64.tolist(), nulls.tolist(), strict=True)], lengths)
