"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact verification, and an
index of shingles for the near copies that the fingerprints miss.

1. An item of L words has fingerprints of all its windows of W words, W being a size near 0.8 L (sizes grow by a fifth, so
   there are few); a document has fingerprints of its windows of each size W at every (L - W + 1)-th word for the least such
   L. Wherever a copy of the item lies, one window of the document is one of the item's windows, word for word.
2. A fingerprint is 64 bits, each the majority of that bit over the words' hashes, from one running count. Four blocks of
   16 bits are looked up among all values one bit away from the items' blocks: any fingerprint within ``RADIUS`` = 7 bits has
   a block with at most one bit wrong, so none is missed.
3. The document's words where the item would lie, up to ``SHIFT`` words to either side, are compared with it exactly: the
   shared weight of the five-word shingles over the weight of both, a shingle weighing its words' bytes.
4. The fingerprints alone promise whole copies only: a copy that the text's end cuts off, or with words changed inside
   the window that is looked up, may have none within the radius. So of each item the shingles that fewest items hold, of
   together more than 1 - threshold of its weight, are looked up at every word: a place without any of them shares too
   little weight. Where one is, every place that lines up with a shared shingle and whose shared weight may suffice is
   compared as in 3. With both, all places of the threshold that line up within ``SHIFT`` words with a shared shingle are
   found, cut off or not.

Items are taken in blocks of bounded number and bytes; a block goes to every task, and each document meets every block.
A document's matches come from one task, without a shuffle.

Defined results: items and documents without words match nothing; an item of fewer words than a shingle is one shingle;
repeated rows and rows with null or shared ids each have matches of their own, repeated items too; empty tables give no
matches; other columns are ignored (``without_leaks`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepare, slices, text_rows
from starload.llm.words import windows, words_of

SHINGLE, RADIUS, SHIFT = 5, 7, 2
#: Bounds of a block of items.
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 4 << 20
_CHUNK = 16384
MATCHES = "doc_id long, text_hash long, item_id long, similarity double, start long, n_words long"


def window_size(length: int) -> int:
    """The window of items of so many words."""
    if length < 10:
        return length
    size = 8
    while max(size + 1, size * 6 // 5) <= length * 4 // 5:
        size = max(size + 1, size * 6 // 5)
    return size


class Running:
    """Running counts of each hash bit over words. Counts of several bits share a 64-bit number, as lanes that are wide
    enough for a window's count; sums may wrap, the difference of two is a window's counts all the same."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.n = len(hashes)
        self.bits = np.unpackbits(hashes.view(np.uint8), bitorder="little")
        self.totals: dict[type, np.ndarray] = {}

    def prints(self, size: int, begin: int, stride: int, most: int) -> np.ndarray:
        """Fingerprints of the windows of ``size`` words at ``begin``, ``begin + stride`` and so on below ``most``: bit majorities."""
        lane = np.uint8 if size < 1 << 8 else np.uint16 if size < 1 << 16 else np.uint32
        if lane not in self.totals:
            numbers = self.bits.astype(lane).view(np.uint64).reshape(self.n, -1).T
            total = np.zeros((numbers.shape[0], self.n + 1), np.uint64)
            np.cumsum(numbers, axis=1, out=total[:, 1:])
            self.totals[lane] = total
        total = self.totals[lane]
        stop = max(begin, min(most, self.n - size + 1))  # the last part of a text may be shorter than a window
        counts = total[:, begin + size : stop + size : stride] - total[:, begin:stop:stride]
        major = np.ascontiguousarray(counts.T).view(lane) > size // 2
        return np.packbits(major.reshape(-1), bitorder="little").view(np.uint64)


def weighted_shingles(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and the weight of each: its words' bytes times its number."""
    k = min(SHINGLE, len(hashes))
    total = np.concatenate([[0], np.cumsum(sizes)])
    s, inverse = np.unique(windows(hashes, k), return_inverse=True)
    return s, np.bincount(inverse, total[k:] - total[:-k], len(s))


def weighted_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    both = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


class Items:
    """The fingerprints of a block of items by window size, with the four block indexes."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = 0.8) -> None:
        self.threshold = threshold
        w = words_of(pa.array([t for _, t in items], pa.large_string()), lower=True)
        self.ids, self.shingles, self.length, self.order = [], [], [], []
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        stride: dict[int, int] = {}
        for (item_id, _), a, b in zip(items, w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            n = b - a
            if not n:
                continue
            size = window_size(n)
            prints = Running(w.hash[a:b]).prints(size, 0, 1, n)
            by_size.setdefault(size, []).append((len(self.ids), prints))
            stride[size] = min(stride.get(size, n), n - size + 1)
            self.ids.append(item_id)
            self.length.append(n)
            self.shingles.append(weighted_shingles(w.hash[a:b], (w.end - w.start)[a:b]))
            self.order.append(windows(w.hash[a:b], min(SHINGLE, n)))
        self._index_shingles()
        self.sizes = []
        for size, parts in sorted(by_size.items()):
            prints = np.concatenate([p for _, p in parts])
            item = np.concatenate([np.full(len(p), i) for i, p in parts])
            offset = np.concatenate([np.arange(len(p)) for _, p in parts])
            self.sizes.append((size, stride[size], prints, item, offset, [_near_values(prints, k) for k in range(4)]))
        self.most = max((s for s, *_ in self.sizes), default=0)

    def _index_shingles(self) -> None:
        """Each item's shingles that fewest items hold, as many as any place of the threshold must share one of."""
        held, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s for s, _ in self.shingles)]), return_counts=True)
        key, who = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i, (s, weight) in enumerate(self.shingles):
            if self.length[i] < SHINGLE:  # one shingle, the whole item: a whole copy or none, which the fingerprints find
                continue
            order = np.argsort(count[np.searchsorted(held, s)], kind="stable")
            total = weight.sum()
            n = min(len(s), 1 + int(np.count_nonzero((total - np.cumsum(weight[order])) / total >= self.threshold)))
            key.append(s[order[:n]])
            who.append(np.full(n, i))
        keys, self.holder = np.concatenate(key), np.concatenate(who)
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.holder, self.held = self.holder[order], np.append(first, len(order))

    def shared(self, hashes: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
        """(item, where it would start, row) of the places that line up with a shared shingle and may reach the threshold."""
        all_of = windows(hashes, SHINGLE)
        if not len(all_of) or not len(self.keys):
            return
        total = np.concatenate([[0], np.cumsum(sizes)])
        weight = total[SHINGLE:] - total[:-SHINGLE]
        k = np.searchsorted(self.keys, all_of)
        k[k == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[k] == all_of)
        row = np.searchsorted(first, hit, side="right") - 1
        whole = hit + SHINGLE <= first[row + 1]
        hit, row = hit[whole], row[whole]
        n = self.held[k[hit] + 1] - self.held[k[hit]]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = self.holder[np.repeat(self.held[k[hit]], n) + place]
        hit, row = np.repeat(hit, n), np.repeat(row, n)
        order = np.lexsort((hit, item, row))
        hit, row, item = hit[order], row[order], item[order]
        length = np.array(self.length)
        # hits of a row and item that are too far apart for one place are looked at apart
        cut = (np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(hit) > 3 * length[item[1:]])
        bounds = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(hit)]]) if len(hit) else np.zeros(1, np.int64)
        for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            starts = self._starts(int(item[x]), all_of, weight, int(first[row[x]]), int(first[row[x] + 1]), int(hit[x]), int(hit[y - 1]))
            if len(starts):
                yield np.stack([np.full(len(starts), item[x]), starts, np.full(len(starts), row[x])])

    def _starts(self, item: int, all_of: np.ndarray, weight: np.ndarray, begin: int, end: int, low: int, high: int) -> np.ndarray:
        """Where the item would start by the shingles it shares with the row ``begin:end`` around the words ``low`` to ``high``."""
        n, (s, mine) = self.length[item], self.shingles[item]
        a, b = max(begin, low - n - SHIFT), min(end - SHINGLE + 1, high + n + SHIFT + 1)
        near = all_of[a:b]
        k = np.searchsorted(s, near)
        k[k == len(s)] = 0
        same = s[k] == near
        both = np.concatenate([[0], np.cumsum(np.where(same, weight[a:b], 0))])
        # offsets of each of the item's shingles, once for each place of the row that has it
        order = np.argsort(self.order[item], kind="stable")
        bound = np.searchsorted(self.order[item][order], s), np.searchsorted(self.order[item][order], s, side="right")
        at = np.flatnonzero(same)
        count = bound[1][k[at]] - bound[0][k[at]]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        starts = np.unique(np.repeat(at + a, count) - order[np.repeat(bound[0][k[at]], count) + place])
        # the shared weight of a place is at most that of its words' shingles that the item has
        shifted = starts[:, None] + np.arange(-SHIFT, SHIFT + 1)
        left, right = np.clip(shifted - a, 0, b - a), np.clip(shifted + n - SHINGLE + 1 - a, 0, b - a)
        return starts[((both[np.maximum(left, right)] - both[left]) / mine.sum() >= self.threshold).any(axis=1)]

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
        """(item, where it would start, row) of every window within the radius of a fingerprint."""
        end = np.repeat(first[1:], np.diff(first))
        step = max(_CHUNK, 4 * self.most)
        for c in range(0, len(hashes), step):
            running = Running(hashes[c : c + step + self.most])
            for size, stride, prints, item, offset, near in self.sizes:
                begin = -c % stride
                mine = running.prints(size, begin, stride, step)
                at = begin + stride * np.arange(len(mine))
                whole = at + c + size <= end[at + c]
                mine, at = mine[whole], at[whole]
                seen = []
                for k, (bound, which) in enumerate(near):
                    value = (mine >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64)
                    count = bound[value + 1] - bound[value]
                    hit = np.flatnonzero(count)
                    window = np.repeat(hit, count[hit])
                    place = np.arange(len(window)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
                    other = which[bound[value[window]] + place]
                    close = np.bitwise_count(mine[window] ^ prints[other]) <= RADIUS
                    here = at[window[close]] + c
                    seen.append(np.stack([item[other[close]], here - offset[other[close]], np.searchsorted(first, here, side="right") - 1]))
                found = np.unique(np.concatenate(seen, axis=1), axis=1)
                if found.shape[1]:
                    yield found

    def matches(self, text: pa.Array, threshold: float) -> list[tuple[int, int, float, int, int]]:
        """(row, item id, similarity, first word, words): of each row and item the most similar place, the first of equal ones."""
        w = words_of(text, lower=True)
        bytes_of = w.end - w.start
        best: dict[tuple[int, int], tuple[float, int]] = {}
        done: set[tuple[int, int, int]] = set()
        for found in chain(self.candidates(w.hash, w.first), self.shared(w.hash, bytes_of, w.first)):
            for item, start, row in found.T.tolist():
                n = self.length[item]
                for at in range(start - SHIFT, start + SHIFT + 1):
                    a, b = max(at, int(w.first[row])), min(at + n, int(w.first[row + 1]))
                    if b <= a or (row, item, at) in done:
                        continue
                    done.add((row, item, at))
                    s = weighted_similarity(self.shingles[item], weighted_shingles(w.hash[a:b], bytes_of[a:b]))
                    have = best.get((row, item))
                    if s >= threshold and (have is None or (-s, a) < (-have[0], have[1])):
                        best[row, item] = (s, a)
        out = []
        for (row, item), (s, a) in sorted(best.items()):
            start = a - int(w.first[row])
            out.append((row, self.ids[item], s, start, min(self.length[item], int(w.first[row + 1]) - a)))
        return out


def _near_values(prints: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each 16-bit value the fingerprints whose k-th block is at most one bit from it, as bounds and members."""
    block = (prints >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64)
    flips = np.array([0, *(1 << i for i in range(16))])
    value, who = (block[:, None] ^ flips).ravel(), np.repeat(np.arange(len(prints)), 17)
    order = np.argsort(value, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << 16))]), who[order]


def item_blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The items, collected in blocks of bounded size one after the other by their own driver job."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [[tuple(r) for r in items.where(part == b).collect()] for b in range(blocks)]


def _matches(items: list[tuple[int, str]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(items, threshold)
        for batch, text in slices(batches, "text", 1 << 20):
            found = index.matches(text, threshold)
            if found:
                row, item, similarity, start, n = zip(*found, strict=True)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()).take(at), batch.column("text_hash").take(at), pa.array(item, pa.int64()), pa.array(similarity), pa.array(start, pa.int64()), pa.array(n, pa.int64())],
                    names=["doc_id", "text_hash", "item_id", "similarity", "start", "n_words"],
                )

    return run


def _clean(items: list[tuple[int, str]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(items, threshold)
        for batch, text in slices(batches, "text", 1 << 20):
            keep = np.ones(batch.num_rows, bool)
            keep[[m[0] for m in index.matches(text, threshold)]] = False
            yield batch.filter(pa.array(keep))

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per document and benchmark item that it holds, with the most similar place."""
    prepare(docs.sparkSession)
    rows = text_rows(docs)
    parts = [rows.mapInArrow(_matches(items, threshold), MATCHES) for items in item_blocks(benchmark)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no benchmark item."""
    prepare(docs.sparkSession)
    for items in item_blocks(benchmark):
        docs = docs.mapInArrow(_clean(items, threshold), docs.schema)
    return docs
