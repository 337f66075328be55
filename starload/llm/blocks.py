"""Comparing the members of lists (buckets, inverted lists) in blocks of bounded size, however long a list is.

A list of more than ``cap`` members is dealt into chunks by a hash of the member; each pair of chunks is a block and so
a task's unit of work. A list within the bound is one block. Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import staged

BLOCK_KEYS = ["list_key", "chunk_i", "chunk_j"]


def in_blocks(lists: DataFrame, member: str, cap: int) -> DataFrame:
    """``lists``: (list_key, member). Members of lists of two or more, with the blocks that they belong to and their own chunk."""
    sizes = staged(lists.groupBy("list_key").agg(F.count("*").alias("members")).where("members > 1"), "list-sizes")
    chunks = F.ceil(F.col("members") / cap)
    held = lists.join(sizes, "list_key").withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64(member), "chunks"))
    each = held.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return each.select("list_key", F.least("chunk", "other").alias("chunk_i"), F.greatest("chunk", "other").alias("chunk_j"), "chunk", member)


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted rows, with the groups' bounds in them."""
    held: list[pa.RecordBatch] = []
    rows, goal = 0, least
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < goal:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        bounds = _bounds(table, keys)
        if len(bounds) > 2:
            cut = int(bounds[-2])
            yield table.slice(0, cut), bounds[:-1]
            held = table.slice(cut).to_batches()
            rows, goal = table.num_rows - cut, least
        else:
            goal = 2 * rows
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _bounds(table, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
