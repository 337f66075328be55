"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph is a line, cut behind words whose hash is a multiple of ``CUT`` so that long lines have several and an edit
changes those around it only. Its digest is 64 bits of its words and of how often it came before in the text, so that a
text's digests are a set. A sketch has three parts of cells; every digest goes to one cell of each part. A cell holds how
many digests it has, their exclusive or, and the exclusive or of their check hashes.

The difference of two sketches cell by cell holds only what one text has and the other has not. Cells with one digest are
peeled: the digest is read, taken out of its other cells, and so on. If cells are left over, both sketches are made
again with four times the cells, until all is recovered. Then the sizes of the sets and of their differences give the likeness:
digests in both over digests in either, 1 for two texts without any.

All texts of a part of an Arrow batch are sketched and peeled at once, as arrays.

Defined results: a null text is empty and has no paragraph; texts that differ in white space only have equal paragraphs;
rows with null or repeated ids are versions of their own, in the order of id (null first) and text hash; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import prepare, slices, staged, text_rows
from starload.llm.words import mix, span_hash, words_of

#: Words of a paragraph piece on average, and cells of a fingerprint. A failed sketch is made again with ``GROWTH`` times the
#: cells; after ``TRIES`` (billions of cells) something else must be wrong.
CUT, CELLS, GROWTH, TRIES = 4, 24, 4, 14
_PARTS = 3
_CHECK = np.uint64(0x2545F4914F6CDD1D)


@dataclass
class Digests:
    """Distinct paragraph digests of some texts: ``value[first[i]:first[i + 1]]`` are those of text i."""

    value: np.ndarray
    first: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.sizes)

    def of(self, rows: np.ndarray) -> Digests:
        sizes = self.sizes[rows]
        first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(first[-1]) + np.repeat(self.first[:-1][rows] - first[:-1], sizes)
        return Digests(self.value[at], first)


def paragraphs(text: pa.Array) -> Digests:
    """``text``: large_string without nulls."""
    w = words_of(text)
    n, rows = len(w.hash), len(w.first) - 1
    if not n:
        return Digests(np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64))
    breaks = np.concatenate([[0], np.cumsum(w.data == 10)])
    new = np.ones(n, bool)
    new[1:] = (breaks[w.start[1:]] != breaks[w.end[:-1]]) | (w.hash[:-1] % np.uint64(CUT) == 0)
    new[w.first[:-1][np.diff(w.first) > 0]] = True
    start = np.flatnonzero(new)
    stop = np.append(start[1:], n)
    row = np.searchsorted(w.first, start, side="right") - 1
    digest = span_hash(w.hash, start, stop, np.zeros(len(start), np.uint64))
    order = np.lexsort((digest, row))  # a paragraph's nth time in a text is a digest of its own
    d, r = digest[order], row[order]
    same = np.zeros(len(d), bool)
    same[1:] = (d[1:] == d[:-1]) & (r[1:] == r[:-1])
    run = np.arange(len(d)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(d))))
    return Digests(mix(d + run.astype(np.uint64) * _CHECK), np.searchsorted(r, np.arange(rows + 1)))


@dataclass
class Sketches:
    """Cells of several sketches in a row: those of sketch i begin at ``first[i]`` and are ``cells[i]``, a multiple of three."""

    count: np.ndarray
    digest: np.ndarray
    check: np.ndarray
    first: np.ndarray
    cells: np.ndarray

    def places(self, value: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """(parts, values): the cell of each value in each part of its owner's sketch."""
        wide = (self.cells // _PARTS)[owner].astype(np.uint64)
        return np.stack([(mix(value + np.uint64(p + 1) * _CHECK) % wide).astype(np.int64) + self.first[owner] + p * wide.astype(np.int64) for p in range(_PARTS)])

    def toggle(self, value: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> None:
        check = _check(value)
        for at in self.places(value, owner):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.digest, at, value)
            np.bitwise_xor.at(self.check, at, check)

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.count - other.count, self.digest ^ other.digest, self.check ^ other.check, self.first, self.cells)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Takes all digests out that can be read: (owner, digest, +1 or -1) of each and which sketches are empty now."""
        owner_of = np.repeat(np.arange(len(self.cells)), self.cells)
        found: list[tuple[np.ndarray, ...]] = []
        left = np.flatnonzero(self.count)
        for _ in range(len(self.count)):
            one = left[(np.abs(self.count[left]) == 1) & (self.check[left] == _check(self.digest[left]))]
            if not len(one):
                break
            one = one[np.lexsort((self.digest[one], owner_of[one]))]  # a digest may be alone in several of its cells
            owner, value, sign = owner_of[one], self.digest[one], self.count[one]
            once = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
            owner, value, sign = owner[once], value[once], sign[once]
            self.toggle(value, owner, -sign)
            found.append((owner, value, sign))
            left = np.unique(self.places(value, owner))
        rest = (self.count != 0) | (self.digest != 0) | (self.check != 0)
        empty = np.bincount(owner_of[rest], minlength=len(self.cells)) == 0
        none = np.zeros(0, np.int64)
        owner, value, sign = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none.astype(np.uint64), none)
        return owner, value, sign, empty


def _check(value: np.ndarray) -> np.ndarray:
    return (mix(value ^ _CHECK) >> np.uint64(32)).astype(np.uint32)


def sketches(digests: Digests, cells: np.ndarray) -> Sketches:
    first = np.concatenate([[0], np.cumsum(cells)[:-1]]).astype(np.int64) if len(cells) else np.zeros(0, np.int64)
    total = int(cells.sum())
    out = Sketches(np.zeros(total, np.int64), np.zeros(total, np.uint64), np.zeros(total, np.uint32), first, cells)
    out.toggle(digests.value, digests.owners(), np.ones(len(digests.value), np.int64))
    return out


def written(sk: Sketches) -> list[str]:
    """Each sketch as text: its cells' counts, digests and checks, in base 64."""
    count, digest, check = sk.count.astype("<i4"), sk.digest.astype("<u8"), sk.check.astype("<u4")
    spans = zip(sk.first.tolist(), (sk.first + sk.cells).tolist(), strict=True)
    return [base64.b64encode(b"".join(x[a:b].tobytes() for x in (count, digest, check))).decode() for a, b in spans]


@dataclass
class Differences:
    """What pair i's old and new text do not share, and the cells that it took; ``likeness`` of their sets."""

    removed: Digests
    added: Digests
    likeness: np.ndarray
    cells: np.ndarray


def differences(old: Digests, new: Digests, cells: int = CELLS) -> Differences:
    """Pair i is text i of ``old`` and of ``new``. Sketches of ``cells`` first; pairs that do not come apart are tried again with more."""
    n = len(old.sizes)
    used = np.full(n, cells, np.int64)
    left, parts = np.arange(n), []
    for _ in range(TRIES):
        if not len(left):
            break
        a, b = old.of(left), new.of(left)
        owner, value, sign, done = sketches(a, used[left]).minus(sketches(b, used[left])).peel()
        # the sets' sizes are known, so a recovery that does not fit them has failed too
        done &= np.bincount(owner, weights=sign, minlength=len(left)) == a.sizes - b.sizes
        ready = done[owner]
        parts.append((left[owner[ready]], value[ready], sign[ready]))
        left = left[~done]
        used[left] *= GROWTH
    if len(left):
        raise ValueError(f"{len(left)} pairs of sketches do not come apart with {int(used.max())} cells")
    owner, value, sign = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    sides = []
    for s in (1, -1):
        o, v = owner[sign == s], value[sign == s]
        order = np.lexsort((v, o))
        sides.append(Digests(v[order], np.searchsorted(o[order], np.arange(n + 1))))
    apart = sides[0].sizes + sides[1].sizes
    both = (old.sizes + new.sizes - apart) // 2
    likeness = np.where(both + apart > 0, both / np.maximum(both + apart, 1), 1.0)
    return Differences(*sides, likeness, used)


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many of the next text's first, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


DIFFERENCES = "removed array<long>, added array<long>, likeness double, cells long"


def _lists(d: Digests) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(d.first.astype(np.int32)), pa.array(d.value.view(np.int64)))


def version_differences(pairs: DataFrame, old: str, new: str) -> DataFrame:
    """``pairs`` with the paragraph digests that only its ``old`` or only its ``new`` text has, their likeness, and the cells it took."""
    prepare(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, before in slices(batches, "_old"):
            after = batch.column("_new").cast(pa.large_string()).fill_null("")
            d = differences(paragraphs(before), paragraphs(after))
            kept = [c for c in batch.schema.names if c not in ("_old", "_new")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), _lists(d.removed), _lists(d.added), pa.array(d.likeness), pa.array(d.cells)], names=[*kept, "removed", "added", "likeness", "cells"])

    taken = {f.split()[0] for f in DIFFERENCES.split(", ")}
    kept = [c for c in pairs.columns if c not in taken]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*kept).schema), DIFFERENCES])
    return pairs.select(*kept, F.col(old).alias("_old"), F.col(new).alias("_new")).mapInArrow(run, schema)


def _compared(text: pa.Array, following: pa.Array) -> list[pa.Array]:
    """n_chars, digest of the edited text, both fingerprints, both likenesses."""
    before, after = text.to_pylist(), following.to_pylist()
    new = [edited(a, b) for a, b in zip(before, after, strict=True)]
    own, changed, nxt = paragraphs(text), paragraphs(pa.array(new, pa.large_string())), paragraphs(following)
    base = np.full(len(before), CELLS, np.int64)
    return [
        pa.array([len(a) for a in before], pa.int64()),
        pa.array([hashlib.sha256(a.encode()).hexdigest() for a in new], pa.string()),
        pa.array(written(sketches(own, base)), pa.string()),
        pa.array(written(sketches(changed, base)), pa.string()),
        pa.array(differences(own, changed).likeness),
        pa.array(differences(own, nxt).likeness),
    ]


RESULT = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
RESULT_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each with the one behind it. A partition's first and last row are edges: they go on with their texts."""
    task = TaskContext.get().partitionId()

    def rows(ids, results=None, edge=None, text=None):
        n = len(ids)
        values = results or [pa.nulls(n, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays(
            [ids, *values, pa.array([task] * n, pa.int64()), pa.array([edge] * n, pa.string()), text if text is not None else pa.nulls(n, pa.string())],
            names=["doc_id", *RESULT, "task", "edge", "text"],
        )

    last = None  # (id, text) that still waits for the next row
    for batch, text in slices(batches, "text"):
        ids = batch.column("doc_id").cast(pa.int64())
        if last is None:
            yield rows(ids[:1], edge="first", text=text[:1].cast(pa.string()))
        else:
            ids, text = pa.concat_arrays([last[0], ids]), pa.concat_arrays([last[1], text])
        if len(ids) > 1:
            yield rows(ids[:-1], _compared(text[:-1], text[1:]))
        last = (ids[-1:], pa.array(text[-1:].to_pylist(), pa.large_string()))
    if last is not None:
        yield rows(last[0], edge="last", text=last[1].cast(pa.string()))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, text in slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_compared(text, batch.column("following").cast(pa.large_string()))], names=["doc_id", *RESULT])


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document with the fingerprints of its text and its edited text, and their likeness, and that of the next document's.

    One range-partitioned sort by id puts neighbours together; a partition is streamed. Its last row meets the next
    partition's first by a join of the edges, two rows a partition.
    """
    prepare(docs.sparkSession)
    ordered = text_rows(docs).repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    done = staged(ordered.select("doc_id", "text").mapInArrow(_in_order, f"{RESULT_SCHEMA}, task long, edge string, text string"), "neighbours")
    first = done.where("edge = 'first'").select(F.col("task").alias("next_task"), F.col("text").alias("following"))
    # one number per partition
    tasks = first.select(F.col("next_task").alias("task"))
    around = Window.orderBy("task")
    lowest = F.min("task").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    links = tasks.select("task", F.coalesce(F.lead("task").over(around), lowest).alias("next_task"))
    edges = done.where("edge = 'last'").select("doc_id", "task", "text").join(links, "task").join(first, "next_task")
    compared = edges.select("doc_id", "text", "following").mapInArrow(_edges, RESULT_SCHEMA)
    return done.where("edge is null").select("doc_id", *RESULT).unionByName(compared)
