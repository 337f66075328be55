"""CSV records of files whose quoted cells hold line breaks, read in parallel however large a file is.

A line tells only together with all lines before it whether it begins a record or goes on inside a quoted cell. But there
are just these two states, so a split can be read for both at once:

1. Each split of a file goes through its lines from either state and keeps, for each, the state it ends in, its first
   record and the record that it leaves open. That is one row per split.
2. The splits of a file are put in order and the states composed, which gives each split the state it begins in.
3. Splits are read again. What lies between a split's first record and the one left open are whole records. Lines of records
   that cross splits are few; they are grouped by the record's place and joined.

A quote opens a quoted cell only as the first character of a cell, and two quotes in a row inside stand for one, so bare
quotes within unquoted cells change nothing. Lines end with a line feed, with or without a carriage return before it.

Lines are known by their split and their number in the scan, so both scans must cut the files alike: the number of
partitions that Spark aims at is pinned in the session (``spark.sql.files.minPartitionNum``) where it isn't set.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import scratch_path

_LEAST, _MOST = -(1 << 62), 1 << 62
#: Per split and state it may begin in (0: a record begins, 1: inside a quoted cell): the state it ends in, its first
#: record's line and the line of the record that it leaves open; and the first record's text at the beginning of a file.
_SPLITS = "file string, block long, end0 int, end1 int, first0 long, first1 long, open0 long, open1 long, opening_row long, opening string"
#: Splits that records cross: their own records begin at line ``first``, whole ones before ``until``; lines before ``first`` belong to (from_block, from_row).
_CROSSED = "file string, block long, first long, until long, from_block long, from_row long"


def pin_splits(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def inside_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether the text behind ``line`` is inside a quoted cell, if its beginning is (or else begins a record)."""
    at = 0
    while True:
        if not inside:
            if line.startswith('"', at):
                at += 1
            else:
                at = line.find(sep + '"', at)
                if at < 0:
                    return False
                at += len(sep) + 1
        while True:  # to the quote that closes the cell
            at = line.find('"', at)
            if at < 0:
                return True
            if not line.startswith('"', at + 1):
                break
            at += 2
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at, inside = at + len(sep), False


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Parts of a batch that lie in one split."""
    if not batch.num_rows:
        return
    file, block = batch.column("file"), batch.column("block")
    new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
    edges = [0, *(i + 1 for i in pc.indices_nonzero(new).to_pylist()), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        yield file[a].as_py(), block[a].as_py(), batch.slice(a, b - a)


class _Split:
    """What a split's lines do, from either state."""

    def __init__(self, file: str, block: int) -> None:
        self.file, self.block = file, block
        self.state, self.first, self.last = [False, True], [None, None], [None, None]
        self.begins, self.opening, self.opening_row, self.opening_inside = block == 0, [], None, False

    def take(self, part: pa.RecordBatch) -> None:
        rows, text = part.column("row"), part.column("value")
        marked = pc.indices_nonzero(pc.match_substring(text, '"')).to_pylist()
        if self.begins:
            self._begin(part)
        done = 0
        for i in [*marked, None]:
            upto = len(rows) if i is None else i + 1
            for s in (0, 1):
                if not self.state[s]:  # all lines up to the next with a quote, and that one, begin records
                    if self.first[s] is None:
                        self.first[s] = rows[done].as_py() if upto > done else None
                    if upto > done:
                        self.last[s] = rows[upto - 1].as_py()
            if i is not None:
                line = text[i].as_py()
                self.state = [inside_after(line, s) for s in self.state]
            done = upto

    def _begin(self, part: pa.RecordBatch) -> None:
        """The first record of the file, whose beginning is known to be one. Blank lines before it are none."""
        for row, line in zip(part.column("row").to_pylist(), part.column("value").to_pylist(), strict=True):
            if not self.opening:
                if not line.strip("\r"):
                    continue
                self.opening_row = row
            self.opening.append(line)
            self.opening_inside = inside_after(line, self.opening_inside)
            if not self.opening_inside:
                self.begins = False
                return

    def row(self) -> tuple:
        opened = [last if inside else None for last, inside in zip(self.last, self.state, strict=True)]
        return (self.file, self.block, *map(int, self.state), *self.first, *opened, self.opening_row, "\n".join(self.opening) if self.opening else None)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        for file, block, part in _runs(batch):
            if split is None or (split.file, split.block) != (file, block):
                if split is not None:
                    yield _batch([split.row()], _SPLITS)
                split = _Split(file, block)
            split.take(part)
    if split is not None:
        yield _batch([split.row()], _SPLITS)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Splits sorted by file and block: the state that each begins in, and of those that records cross, where its own are."""
    file, inside, place = None, 0, (0, 0)
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["file"] != file:
                file, inside, place = r["file"], 0, (0, 0)
            first, opened = r[f"first{inside}"], r[f"open{inside}"]
            if inside or opened is not None:
                begins = (_MOST if first is None else first) if inside else _LEAST
                out.append((file, r["block"], begins, _MOST if opened is None else opened, *place))
            if opened is not None:
                place = (r["block"], opened)
            inside = r[f"end{inside}"]
        if out:
            yield _batch(out, _CROSSED)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines that begin with a record and end with one, split by split."""
    held: list[str] = []
    begin, of = 0, None
    schema = "file string, block long, row long, record string"
    for batch in batches:
        for file, block, part in _runs(batch):
            if (file, block) != of:
                held, of = [], (file, block)
            text, rows = part.column("value"), part.column("row")
            if not held and not pc.any(pc.match_substring(text, '"')).as_py():
                yield pa.RecordBatch.from_arrays([part.column("file"), part.column("block"), rows, text], names=["file", "block", "row", "record"])
                continue
            out = []
            inside = bool(held)
            for row, line in zip(rows.to_pylist(), text.to_pylist(), strict=True):
                if not inside:
                    begin = row
                held.append(line)
                inside = inside_after(line, inside) if '"' in line else inside
                if not inside:
                    out.append((file, block, begin, held[0] if len(held) == 1 else "\n".join(held)))
                    held = []
            if out:
                yield _batch(out, schema)


class Records:
    """The records of some files. The first scan is made at once, the second one is ``frame``."""

    def __init__(self, spark: SparkSession, files: list[str]) -> None:
        pin_splits(spark)
        self.spark, self.files = spark, files
        path = scratch_path(spark, "csv-splits")
        _lines(spark, files).mapInArrow(_splits, _SPLITS).write.parquet(path)
        self.splits = spark.read.schema(_SPLITS).parquet(path)
        crossed = scratch_path(spark, "csv-crossed")
        self.splits.repartition("file").sortWithinPartitions("file", "block").mapInArrow(_composed, _CROSSED).write.parquet(crossed)
        self.crossed = spark.read.schema(_CROSSED).parquet(crossed)

    def openings(self) -> dict[str, tuple[int, str]]:
        """Line number and text of each file's first record: one per file, as many as the listing holds."""
        return {r.file: (r.opening_row, r.opening) for r in self.splits.where("opening is not null").select("file", "opening_row", "opening").collect()}

    def frame(self) -> DataFrame:
        """file, block, row, record; within a file, block and row give the order.

        The broadcast table has at most a row per split, far less than the list of splits that the driver plans with.
        """
        marked = _lines(self.spark, self.files).join(F.broadcast(self.crossed), ["file", "block"], "left")
        own = marked.where(F.col("first").isNull() | ((F.col("row") >= F.col("first")) & (F.col("row") < F.col("until"))))
        whole = own.select("file", "block", "row", "value").mapInArrow(_whole, "file string, block long, row long, record string")
        after = F.col("row") >= F.col("until")
        parts = marked.where(after | (F.col("row") < F.col("first"))).select(
            "file", F.when(after, F.col("block")).otherwise(F.col("from_block")).alias("of_block"), F.when(after, F.col("until")).otherwise(F.col("from_row")).alias("of_row"),
            F.struct("block", "row", "value").alias("part"),
        )
        text = F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["value"]), "\n")
        crossing = parts.groupBy("file", "of_block", "of_row").agg(text.alias("record"))
        crossing = crossing.select("file", F.col("of_block").alias("block"), F.col("of_row").alias("row"), "record")
        ends = F.regexp_replace("record", r"\r$", "")
        return whole.unionByName(crossing).withColumn("record", ends).where("record <> ''")
