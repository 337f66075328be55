"""Substring deduplication: words covered by a window that also starts elsewhere, by FM-indexes of content-dealt shards.

Comparing every document with an index of every shard would grow with the square of the corpus. Instead each window goes
to one shard by its content: its minimizer, the least hash of the ``GRAM``-word grams in it. Consecutive windows with the
same minimizer occurrence are one segment. Equal windows have equal minimizers, so they meet in one shard.

1. Segments (a few dozen bytes each, without text; a run of equal ones, as in text that repeats itself, is one row) are
   counted by minimizer. One met once holds no repeated window; one
   whose segments are all equal holds only repeated ones.
2. Of the rest, one representative of each distinct segment brings its words to its shard. A shard is indexed in parts of
   whole minimizers and bounded size (``PART_ROWS``): wavelet-matrix FM-index, backward search from each window's end, matching
   statistics, intervals of windows that occur twice.
3. A minimizer with more than ``MOST`` distinct segments does not fit into one part; its windows are counted exactly by
   128 bits of hash instead, pre-aggregated.
4. Marks go back to the documents' segments, and the marked words go.

Defined results: a null text has no words; repeated rows count as places of their own, so all their windows are repeated;
rows with null or shared ids are told apart by their text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.blocks import whole_groups
from starload.llm.common import prepare, slices, staged, text_rows
from starload.llm.fm_index import DEPTH, FMIndex, repeated_windows
from starload.llm.words import mix, span_hash, windows, words_of

GRAM = 8
PART_ROWS = 16_384
MOST = 50_000
_POSITION_BITS = 24
_SPAN = 1 << 22
SEGMENTS = "doc_id long, text_hash long, start int, n_windows int, runs int, key long, segment long"


def segments(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(row, first window's start, windows, minimizer) of each segment; ``first`` are the rows' bounds in ``hashes``."""
    counts = np.diff(first)
    ends = np.repeat(first[1:], counts)
    out = []
    for at in range(0, max(0, len(hashes) - size + 1), _SPAN):
        part = hashes[at : at + _SPAN + size - 1]
        grams = windows(part, GRAM)
        n = len(part) - size + 1
        packed = (grams >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(len(grams), dtype=np.uint64)
        low, span, wide = packed, 1, size - GRAM + 1
        while 2 * span <= wide:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < wide:
            low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
        place = (low[:n] & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        valid = np.flatnonzero(np.arange(at, at + n) + size <= ends[at : at + n])
        if not len(valid):
            continue
        here = place[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (here[1:] != here[:-1]) | (valid[1:] != valid[:-1] + 1)
        begin = np.flatnonzero(new)
        out.append((valid[begin] + at, np.diff(np.append(begin, len(valid))), grams[here[begin]]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),)
    start, number, key = (np.concatenate(x) for x in zip(*out, strict=True))
    return np.searchsorted(first, start, side="right") - 1, start, number, key


def _segments(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text"):
            w = words_of(text)
            row, start, number, key = segments(w.hash, w.first, size)
            whole = span_hash(w.hash, start, start + number + size - 1, number)
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + number[:-1]) | (key[1:] != key[:-1]) | (whole[1:] != whole[:-1]) | (number[1:] != number[:-1])
            begin = np.flatnonzero(new)
            runs = np.diff(np.append(begin, len(row)))
            row, start, number, key, whole = row[begin], start[begin], number[begin], key[begin], whole[begin]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(at), batch.column("text_hash").take(at), pa.array((start - w.first[row]).astype(np.int32)),
                    pa.array(number.astype(np.int32)), pa.array(runs.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)),
                ],
                names=["doc_id", "text_hash", "start", "n_windows", "runs", "key", "segment"],
            )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch, text in slices(batches, "text"):
        data = pa.array([pack(t.as_buffer().to_pybytes()) for t in text], pa.binary())
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), data], names=[*names, "packed"])


def packed_rows(rows: DataFrame) -> DataFrame:
    """Texts as zstd frames, for joins: a third of the bytes to shuffle. Other columns stay."""
    kept = T.StructType([f for f in rows.schema if f.name != "text"])
    return rows.mapInArrow(_packed, kept.add("packed", "binary"))


def _unpack():
    return zstandard.ZstdDecompressor().decompress


def _words(size: int):
    """The words of the asked segments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpack()
        for batch in batches:
            out = []
            for data, asked in zip(batch.column("packed"), batch.column("asked").to_pylist(), strict=True):
                words = unpack(data.as_buffer()).split()
                out += [(a["key"], a["segment"], a["copies"], a["hot"], b" ".join(words[a["start"] : a["start"] + a["n_windows"] + size - 1])) for a in asked]
            for at in range(0, len(out), 10_000):
                key, segment, copies, hot, words = zip(*out[at : at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(segment, pa.int64()), pa.array(copies, pa.int64()), pa.array(hot, pa.bool_()), pa.array(words, pa.binary())],
                    names=["key", "segment", "copies", "hot", "words"],
                )

    return run


def _masks(bits: np.ndarray, row: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    at = np.flatnonzero(bits)
    np.bitwise_or.at(out, row[at], np.uint64(1) << place[at].astype(np.uint64))
    return out


def _search(size: int):
    """One FM-index per part of whole minimizers; per segment the windows that occur twice, as a bit mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in whole_groups(batches, ["key"], PART_ROWS):
            key, segment = table.column("key").to_numpy(), table.column("segment").to_numpy()
            once = np.ones(len(key), bool)  # a repeated row brings its segments twice
            once[1:] = (key[1:] != key[:-1]) | (segment[1:] != segment[:-1])
            table = table.filter(pa.array(once)).combine_chunks()
            w = words_of(table.column("words").combine_chunks().cast(pa.large_binary()).view(pa.large_string()) if table.num_rows else pa.array([], pa.large_string()))
            rows, counts = table.num_rows, np.diff(w.first)
            _, number = np.unique(w.hash, return_inverse=True)
            symbols = np.zeros(len(number) + rows, np.int64)
            row = np.repeat(np.arange(rows), counts)
            place = np.arange(len(number)) - w.first[:-1][row]
            at = np.arange(len(number)) + row
            symbols[at] = number + 1
            start = w.first[:-1] + np.arange(rows)
            index = FMIndex(symbols, int(symbols.max(initial=0)) + 1, depth=max(DEPTH, int(counts.max(initial=0))))
            found = repeated_windows(index, symbols, start, start + counts, size)
            masks = _masks(found[at], row, place, rows)
            copies = table.column("copies").to_numpy() > 1
            masks[copies] = (np.uint64(1) << (counts[copies] - size + 1).astype(np.uint64)) - np.uint64(1)
            yield pa.RecordBatch.from_arrays([table.column("key").combine_chunks(), table.column("segment").combine_chunks(), pa.array(masks.view(np.int64))], names=["key", "segment", "mask"])

    return run


def _hot_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words_of(batch.column("words").cast(pa.large_binary()).view(pa.large_string()))
            counts = np.maximum(np.diff(w.first) - size + 1, 0)
            row = np.repeat(np.arange(batch.num_rows), counts)
            place = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
            at = w.first[:-1][row] + place
            one, two = windows(w.hash, size), windows(mix(w.hash ^ np.uint64(0x5851F42D4C957F2D)), size)
            many = (batch.column("copies").to_numpy() > 1)[row]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(take), batch.column("segment").take(take), pa.array(one[at].view(np.int64)), pa.array(two[at].view(np.int64)), pa.array(place), pa.array(many)],
                names=["key", "segment", "one", "two", "place", "many"],
            )

    return run


def _counted(hot: DataFrame, size: int) -> DataFrame:
    """Masks of the segments of minimizers too frequent for one part: each distinct window counted over all segments."""
    each = hot.dropDuplicates(["key", "segment"]).select("key", "segment", "copies", "words").mapInArrow(_hot_windows(size), "key long, segment long, one long, two long, place long, many boolean")
    twice = each.groupBy("one", "two").agg(F.count("*").alias("n"), F.max("many").alias("more")).where("n > 1 or more").select("one", "two")
    return each.join(twice, ["one", "two"]).groupBy("key", "segment").agg(F.expr("bit_or(shiftleft(1L, cast(place as int)))").alias("mask"))


def _cut(size: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpack()
        for batch in batches:
            rows: list[tuple] = []
            for data, marks in zip(batch.column("packed"), batch.column("marks").to_pylist(), strict=True):
                raw = unpack(data.as_buffer())
                words = raw.split()
                total = len(words)
                gone = np.zeros(total + 1, np.int32)
                for m in marks or []:
                    bits = np.flatnonzero(np.uint64(m["mask"] & (1 << 64) - 1) >> np.arange(64, dtype=np.uint64) & np.uint64(1))
                    at = (m["start"] + m["n_windows"] * np.arange(m["runs"])[:, None] + bits).ravel()
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + size, -1)
                covered = np.cumsum(gone[:-1]) > 0
                removed = int(covered.sum())
                if removed:
                    words = [words[i] for i in np.flatnonzero(~covered).tolist()]
                kept = b" ".join(words)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
                spans = [{"start": a, "length": b - a} for a, b in edge.reshape(-1, 2).tolist()]
                rows.append((total, removed, hashlib.sha256(kept).hexdigest(), spans, (kept if removed else raw).decode() if texts else None))
            total, removed, sha, spans, text = zip(*rows, strict=True) if rows else ((),) * 5
            carried = [c for c in batch.schema.names if c not in ("packed", "marks")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in carried), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(text, pa.string()),
                ],
                names=[*carried, "n_words", "n_removed", "kept_sha256", "removed", "kept_text"],
            )

    return run


CUT = (("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string"), ("removed", "array<struct<start: long, length: long>>"), ("kept_text", "string"))


def remove_repeats(docs: DataFrame, size: int = 35, texts: bool = True, carry: bool = False) -> DataFrame:
    """One row per document: words, removed words and their spans, the kept text and its digest.

    The digest is of the kept words joined by one space. ``kept_text`` is the text itself if nothing was removed. With
    ``carry``, the input's other columns come along as the struct ``document``.
    ``size`` is from ``GRAM`` to ``GRAM`` + 62 words, so that a segment's windows fit one mask.
    """
    if not GRAM <= size <= GRAM + 62:
        raise ValueError(f"size must be from {GRAM} to {GRAM + 62}")
    prepare(docs.sparkSession)
    rows = text_rows(docs)
    found = staged(rows.mapInArrow(_segments(size), SEGMENTS), "segments")
    keys = found.groupBy("key").agg(F.sum("runs").alias("total"), F.min("segment").alias("low"), F.max("segment").alias("high")).where("total > 1")
    keys = staged(keys.select("key", (F.col("low") != F.col("high")).alias("mixed")), "keys")
    repeated = staged(found.join(keys, "key"), "repeated")
    distinct = repeated.where("mixed").groupBy("key", "segment").agg(F.sum("runs").alias("copies"), F.min(F.struct("doc_id", "text_hash", "start", "n_windows")).alias("rep"))
    distinct = staged(distinct, "distinct")
    per_key = staged(distinct.groupBy("key").agg((F.count("*") > MOST).alias("hot")), "per-key")
    one = F.struct("key", "segment", "copies", F.col("rep.start").alias("start"), F.col("rep.n_windows").alias("n_windows"), "hot")
    asked = distinct.join(per_key, "key").groupBy(F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash")).agg(F.collect_list(one).alias("asked"))
    texts_of = packed_rows(rows)
    whole = packed_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), _but_text(docs).alias("document"))) if carry else texts_of
    same = (F.col("text_hash") == F.col("rep_hash")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))
    words = staged(texts_of.join(asked, same).select("packed", "asked").mapInArrow(_words(size), "key long, segment long, copies long, hot boolean, words binary"), "segment-words")
    shards = words.where("not hot").repartition("key").sortWithinPartitions("key", "segment").select("key", "segment", "copies", "words")
    masks = shards.mapInArrow(_search(size), "key long, segment long, mask long")
    masks = masks.unionByName(_counted(words.where("hot"), size)).where("mask <> 0")
    every = F.expr("shiftleft(1L, n_windows) - 1")
    place = ["doc_id", "text_hash", "start", "n_windows", "runs"]
    marks = repeated.where("not mixed").select(*place, every.alias("mask"))
    marks = marks.unionByName(repeated.where("mixed").join(masks, ["key", "segment"]).select(*place, "mask"))
    per_doc = marks.distinct().groupBy(F.col("doc_id").alias("rep_id"), F.col("text_hash").alias("rep_hash")).agg(F.collect_list(F.struct("start", "n_windows", "runs", "mask")).alias("marks"))
    schema = T.StructType([f for f in whole.schema if f.name != "packed"])
    for name, kind in CUT:
        schema = schema.add(name, T._parse_datatype_string(kind))
    joined = whole.join(per_doc, same, "left")
    out = joined.select(*[c for c in whole.columns if c != "packed"], "packed", "marks").mapInArrow(_cut(size, texts), schema)
    return out if texts else out.drop("kept_text")


def _but_text(docs: DataFrame) -> F.Column:
    """The row without its text, which comes back as ``kept_text``."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
