"""Packing documents into sequences of a fixed length: first-fit decreasing, in randomised groups.

Each document becomes its token ids and one end id. Whole sequences are cut off its front; what remains is placed
by first-fit decreasing within a random group of documents, where a tournament tree over the bins' free room finds
the first bin that still holds a piece in logarithmic time. Groups are independent, so each is one small task;
only piece headers are shuffled, never the ids.

Defined results: a null or empty text is the end id alone; repeated rows, and rows with a null or shared ``doc_id``,
are packed one by one; an empty table gives no pieces; columns of the input other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepare, slices, text_rows
from starload.llm.tokens import encoder, vocabulary_path

#: Documents of a group, on average.
GROUP_DOCS = 20_000
#: Sequence ids of a group start at its number times this.
GROUP_IDS = 1 << 36
HEADERS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, group long"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Bins:
    """Bins of equal capacity; a tournament tree keeps the most free room below each node."""

    def __init__(self, capacity: int, most: int) -> None:
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)
        self.capacity = capacity

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset in it) of the first bin with room for ``size``."""
        room, leaves = self.room, self.leaves
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        offset = self.capacity - room[node]
        room[node] -= size
        at = node
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
        return node - leaves, offset


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size (1 to ``capacity``)."""
    bins = Bins(capacity, len(sizes))
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        where[i], offset[i] = bins.place(int(sizes[i]))
    return where, offset


def _headers(path: str, end_id: int, capacity: int, groups: int, seed: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(path).encode
        draw = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch, text in slices(batches, "text", tokens=True):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(text.to_pylist()), strict=True):
                ids += end
                total, group = len(ids) // 4, int(draw.integers(groups))
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total, group))
            if rows:
                doc_id, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), *(pa.array(c, pa.int64()) for c in rest)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "group"])

    return run


def _pack_group(capacity: int):
    def run(pieces: pa.Table) -> pa.Table:
        """A whole sequence is a bin of its own; the rest share bins, which are numbered after those."""
        length = pieces.column("length").to_numpy()
        whole = length == capacity
        where, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        where[whole] = np.arange(whole.sum())
        bins, at = first_fit_decreasing(length[~whole], capacity)
        where[~whole], offset[~whole] = bins + whole.sum(), at
        where += pieces.column("group").to_numpy() * GROUP_IDS
        return pieces.drop_columns(["group"]).append_column("sequence_id", pa.array(where)).append_column("offset", pa.array(offset))

    return run


def pack(
    docs: DataFrame, capacity: int = 1024, end_id: int = 0, vocabulary: str | None = None, group_docs: int = GROUP_DOCS, seed: int = 17
) -> DataFrame:
    """One row per piece: which ids of which document, and where they lie in which sequence.

    The number of groups follows the number of documents, so that a group stays a small task at any size.
    """
    prepare(docs.sparkSession)
    rows = text_rows(docs).select("doc_id", "text")
    groups = max(1, -(-docs.select("doc_id").count() // group_docs))
    headers = rows.mapInArrow(_headers(vocabulary or vocabulary_path(), end_id, capacity, groups, seed), HEADERS)
    return headers.groupBy("group").applyInArrow(_pack_group(capacity), PIECES)


def padding(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Sequences, ids and the share of padding."""
    per = pieces.groupBy("sequence_id").agg(F.sum("length").alias("ids"))
    return per.agg(F.count("*").alias("sequences"), F.sum("ids").alias("ids"), (1 - F.sum("ids") / (F.count("*") * capacity)).alias("padding"))
