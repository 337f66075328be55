"""Near-duplicate documents by SetSketch registers: band, estimate by likelihood, verify on the full shingle sets.

1. Each text becomes the set of its distinct word shingles, a digest of the set and its registers. Documents of equal
   sets are one class, so any number of copies counts once.
2. Bands of four register values are inverted lists of classes; lists are compared in blocks of bounded size. Of each
   block the pairs whose likely similarity is not far below the threshold go on: all pairs of a small block, of a larger
   one a spanning forest of the likeliest pairs and the star of its most central member, since one class per document
   is asked for and not each pair.
3. These pairs are verified on the full sets. A second round takes every likely pair across what are still different
   components, each pair in the lowest band that the two share, so that no link that would join two of them is left out.
   There may be many such pairs that are no links, so they never become rows: the blocks' members that have one get their
   full sets, and a block verifies its pairs itself and gives the links that join components.
4. Verified links give components.

Defined results: texts without words, null texts and empty ones link with nothing; fewer words than a shingle are one
shingle; repeated rows and rows of one id with different texts are classes by their text; rows with a null id take part
and get the least id of their component, null if it has none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm import setsketch
from starload.llm.blocks import BLOCK_KEYS, dealt, in_blocks, whole_groups
from starload.llm.common import prepare, slices, staged, text_rows
from starload.llm.components import connected
from starload.llm.words import shingle_sets, words_of

BANDS = 32
#: Members of a chunk; a block is one or two chunks.
CHUNK = 1024
#: A block of so many members or fewer gives all its likely pairs at once.
SMALL = 12
#: Standard errors below the threshold down to which a pair is verified.
MARGIN = 5.0
SETS = "doc_id long, text_hash long, n_shingles long, digest binary, registers binary"


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text"):
            sets = shingle_sets(words_of(text, lower=True), size)
            registers = setsketch.sketch(sets)
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array([r.tobytes() for r in registers], pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "digest", "registers"],
            )

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text"):
            sets = shingle_sets(words_of(text, lower=True), size)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["digest", "items"])

    return run


def _equal_counts(r: np.ndarray) -> np.ndarray:
    out = np.zeros((len(r), len(r)), np.uint8 if r.shape[1] < 256 else np.uint16)
    for column in np.ascontiguousarray(r.T):
        out += column[:, None] == column[None, :]
    return out


def _forest(weight: np.ndarray) -> list[tuple[int, int]]:
    """Maximum spanning forest of a dense symmetric matrix, 0 for no edge (Prim)."""
    n = len(weight)
    best, parent, out = np.zeros(n, weight.dtype), np.full(n, -1), []
    free = np.ones(n, bool)
    for _ in range(n):
        k = int(np.argmax(np.where(free, best, 0)))
        if not free[k] or not best[k]:
            k = int(np.argmax(free))
        elif parent[k] >= 0:
            out.append((int(parent[k]), k))
        free[k] = False
        better = free & (weight[k] > best)
        best[better], parent[better] = weight[k][better], k
    return out


def _floor(threshold: float) -> float:
    return threshold - MARGIN * float(np.sqrt(threshold * (1 - threshold) / setsketch.REGISTERS))


def _likely(r: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    close = np.flatnonzero(np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]))
    keep = np.zeros(len(a), bool)
    for at in range(0, len(close), 50_000):
        k = close[at : at + 50_000]
        x, y = a[k], b[k]
        keep[k] = setsketch.similarity(r[x], r[y], size[x].astype(float), size[y].astype(float)) >= _floor(threshold)
    return keep


def _alike(r: np.ndarray, size: np.ndarray, chunk: np.ndarray, two: bool, threshold: float) -> np.ndarray:
    """Equal registers of each pair of a block's members, 0 where they are too few or the sizes too different."""
    same = _equal_counts(r)
    ratio = np.minimum(size[:, None], size[None, :]) >= threshold * np.maximum(size[:, None], size[None, :])
    same[~ratio | (same < (_floor(threshold) - 0.05) * r.shape[1])] = 0
    np.fill_diagonal(same, 0)
    if two:
        same[chunk[:, None] == chunk[None, :]] = 0
    return same


class _Blocks:
    """The columns of a table of whole blocks."""

    def __init__(self, table: pa.Table) -> None:
        self.r = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(table.num_rows, -1)
        self.size, self.chunk = table.column("n_shingles").to_numpy(), table.column("chunk").to_numpy()
        self.two = table.column("chunk_i").to_numpy() != table.column("chunk_j").to_numpy()
        self.band = table.column("list_key").to_numpy() & (BANDS - 1)
        self.digest = table.column("digest")

    def across(self, s: int, e: int, root: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Likely pairs of different components in the block s:e, of which it is the lowest shared band."""
        if (root[s:e] == root[s]).all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        same = _alike(self.r[s:e], self.size[s:e], self.chunk[s:e], bool(self.two[s]), threshold)
        same[root[s:e, None] == root[None, s:e]] = 0
        a, b = np.nonzero(np.triu(same))
        a, b = a + s, b + s
        lowest = np.zeros(len(a), np.int64)
        for at in range(0, len(a), 50_000):
            x, y = self.r[a[at : at + 50_000]], self.r[b[at : at + 50_000]]
            lowest[at : at + 50_000] = np.argmax((x == y).reshape(len(x), BANDS, -1).all(axis=2), axis=1)
        own = lowest == self.band[s]
        a, b = a[own], b[own]
        likely = _likely(self.r, self.size, a, b, threshold)
        return a[likely], b[likely]


def _pairs(digest: pa.ChunkedArray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    take = lambda x: digest.take(pa.array(x)).combine_chunks().cast(pa.binary())
    return pa.RecordBatch.from_arrays([take(a), take(b)], names=["a", "b"])


def _spanning(threshold: float):
    """Likely pairs of each block: all of a small one, of a larger one what spans it."""

    def block(k: _Blocks, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        same = _alike(k.r[s:e], k.size[s:e], k.chunk[s:e], bool(k.two[s]), threshold)
        if e - s <= SMALL:
            return np.nonzero(np.triu(same))
        edges = _forest(same)
        center = int(np.argmax((same > 0).sum(axis=1)))
        edges += [(center, int(x)) for x in np.flatnonzero(same[center])]
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, BLOCK_KEYS):
            k, n = _Blocks(table), np.diff(bounds)
            left, right = [bounds[:-1][n == 2]], [bounds[:-1][n == 2] + 1]
            for s, e in zip(bounds[:-1][n > 2].tolist(), bounds[1:][n > 2].tolist(), strict=True):
                a, b = block(k, s, e)
                left.append(a + s)
                right.append(b + s)
            a, b = np.concatenate(left), np.concatenate(right)
            keep = _likely(k.r, k.size, a, b, threshold)
            yield _pairs(k.digest, a[keep], b[keep])

    return run


def _numbered(table: pa.Table) -> np.ndarray:
    return table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()


def _concerned(threshold: float):
    """The rows of block members that have a likely pair across components in their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, BLOCK_KEYS):
            k, root, keep = _Blocks(table), _numbered(table), np.zeros(table.num_rows, bool)
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                a, b = k.across(s, e, root, threshold)
                keep[a] = keep[b] = True
            yield from table.filter(pa.array(keep)).to_batches(512)

    return run


def _joining(threshold: float, percent: int):
    """Verified links of each block that join components, the likeliest pairs first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, BLOCK_KEYS, 256):
            k, root = _Blocks(table), _numbered(table)
            items = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("items")]
            left, right = [], []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                a, b = k.across(s, e, root, threshold)
                order = np.argsort(-(k.r[a] == k.r[b]).sum(axis=1), kind="stable") if len(a) < 50_000 else np.arange(len(a))
                to = {int(x): int(x) for x in np.unique(root[s:e])}

                def find(x: int, to: dict = to) -> int:
                    while to[x] != x:
                        to[x] = to[to[x]]
                        x = to[x]
                    return x

                for x, y in zip(a[order].tolist(), b[order].tolist(), strict=True):
                    one, two = find(int(root[x])), find(int(root[y]))
                    if one != two and _enough(items[x], items[y], percent):
                        to[one] = two
                        left.append(x)
                        right.append(y)
            yield _pairs(k.digest, np.array(left, np.int64), np.array(right, np.int64))

    return run


def _enough(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether sorted sets share ``percent`` hundredths of their union."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b"), strict=True):
                keep.append(_enough(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _sets_of(nodes: DataFrame, classes: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(digest, items) of the classes in ``nodes``. A set is made once, from one document of its class."""
    reps = nodes.join(classes.select("digest", "rep"), "digest").select("digest", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))
    texts = rows.join(reps, (rows.text_hash == reps.rep_hash) & rows.doc_id.eqNullSafe(reps.rep_id)).select("digest", "text")
    return staged(texts.mapInArrow(_full_sets(size), "digest binary, items binary").dropDuplicates(["digest"]), "sets")


def _verify(pairs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int, size: int) -> DataFrame:
    """``pairs`` whose full sets are as similar as asked for."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), classes, rows, size)
    of = lambda side: sets.select(F.col("digest").alias(side), F.col("items").alias(f"items_{side}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return staged(both.mapInArrow(_verified(percent), "a binary, b binary"), "links")


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """One row per document: its set's size, the least id of its component, whether it is that one, its text's hash and its group.

    Documents are linked if the shared shingles are at least ``percent`` hundredths of all shingles of the two.
    """
    prepare(docs.sparkSession)
    rows = text_rows(docs)
    sets = staged(rows.mapInArrow(_sets(size), SETS), "sketches")
    one = F.struct("doc_id", "text_hash")
    full = sets.where("n_shingles > 0")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("low"), F.min(one).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    classes = staged(classes, "classes")
    width = 2 * setsketch.REGISTERS // BANDS
    # the lowest bits of a list's key are its band
    hashed = [F.xxhash64(F.lit(i), F.substring("registers", 1 + i * width, width)) for i in range(BANDS)]
    keys = F.array(*[h.bitwiseAND(F.lit(-BANDS)).bitwiseOR(F.lit(i)) for i, h in enumerate(hashed)])
    lists = in_blocks(classes.select("digest", F.explode(keys).alias("list_key")), "digest", CHUNK)
    members = staged(lists, "members")
    described = members.join(classes.select("digest", "n_shingles", "registers"), "digest")
    pair = "a binary, b binary"
    first = dealt(described).mapInArrow(_spanning(percent / 100), pair)
    first = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    links = _verify(staged(first, "pairs"), classes, rows, percent, size)
    roots = staged(connected(links, "a", "b"), "roots")
    rooted = members.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    mixed = rooted.groupBy("list_key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("list_key")
    mixed = staged(mixed, "mixed")
    again = dealt(rooted.join(mixed, "list_key").join(classes.select("digest", "n_shingles", "registers"), "digest"))
    concerned = staged(again.mapInArrow(_concerned(percent / 100), again.schema), "concerned")
    if not concerned.isEmpty():
        items = _sets_of(concerned.select("digest").distinct(), classes, rows, size)
        more = dealt(concerned.join(items, "digest")).mapInArrow(_joining(percent / 100, percent), pair)
        roots = staged(connected(links.unionByName(more), "a", "b"), "roots")
    named = classes.select("digest", "low").join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = staged(named.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    of_class = named.join(least, "root").select("digest", "component_id", F.col("root").alias("group"))
    out = sets.select("doc_id", "text_hash", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash", "group")


def one_of_each(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The rows of ``docs``, unchanged, of which each group of near duplicates keeps one: that of the least id (nulls
    last), of equal ids the least text hash. Rows without words stay; of rows equal in id and text one stays."""
    near = near_duplicates(docs, percent, size)
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    grouped = near.where("n_shingles > 0").groupBy("group").agg(F.min(first).alias("first")).select("first.doc_id", "first.text_hash")
    keep = grouped.unionByName(near.where("n_shingles = 0").select("doc_id", "text_hash").distinct())
    keep = keep.select(F.col("doc_id").alias("__keep_id"), F.col("text_hash").alias("__keep_hash"))
    rows = docs.withColumn("__hash", F.xxhash64("text")).join(keep, F.col("doc_id").eqNullSafe(F.col("__keep_id")) & (F.col("__hash") == F.col("__keep_hash")), "left_semi")
    return rows.dropDuplicates(["doc_id", "__hash"]).drop("__hash")
