"""A message queue as a folder of segments, read by a streaming source that flushes by count or age.

The consumer's flush rule is: hand on a batch as soon as ``max_records`` messages wait, or when the oldest has waited
``max_seconds``. A trigger interval can't say that, and a cap a trigger alone never waits for a batch to fill. Here the
source itself admits messages: asked for its latest offset it lists what waits, takes exactly ``max_records`` in the order of
arrival if there are as many, all if the oldest is old enough, and else answers with the offset it gave before, so that no
batch runs. One micro-batch a flush costs a backlog of millions of messages a micro-batch and a listing for every thousand, so
``max_batches`` lets one micro-batch hold as many full flushes as wait, up to that number. Each still has exactly ``max_records``
in the order of arrival; the column ``flush`` says which one a message belongs to, counted from the queue's first.

A queue has partitions with dense offsets of their own. A segment is a Parquet file of consecutive messages, whose name
tells its first and last offset and when it arrived, so batches are planned from listings alone:
``<queue>/p=<partition>/b=<first offset div BLOCK>/<first>-<last>-<arrived, ms>.parquet``. Blocks before an offset are not listed,
so planning takes as long as the backlog is, however old the queue. Segments appear by a rename, whole or not at all. Each
segment of a batch is read by a task of its own.

Spark writes a batch's end to its checkpoint before the batch runs and hands it to the source when a query starts again; the
source keeps no other state. Paths go through ``pyarrow.fs``: local, HDFS and object stores.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from starload import specs

SEGMENT, BLOCK = 1000, 100_000
NAME = "starload_queue"
#: In an offset, beside the partitions' own: the flushes before it.
FLUSHES = "flushes"
SCHEMA = "key string, value string, queue_partition int, offset long, arrived_ms long"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


@dataclass(frozen=True, order=True)
class Segment:
    """In the order in which messages are taken."""

    arrived_ms: int
    queue_partition: int
    first: int
    last: int

    def path(self, root: str, block: int | None = None) -> str:
        return f"{root}/p={self.queue_partition}/b={self.first // (block or BLOCK)}/{self.first}-{self.last}-{self.arrived_ms}.parquet"


def _children(fs: pafs.FileSystem, path: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return [f.base_name for f in found]


def partitions_of(fs: pafs.FileSystem, root: str) -> list[int]:
    return sorted(int(n[2:]) for n in _children(fs, root) if n.startswith("p="))


def segments(fs: pafs.FileSystem, root: str, partition: int, since: int) -> list[Segment]:
    """Segments with messages from offset ``since`` on, as far as they follow one another without a gap, in order of offset.

    A segment that was published twice, with another arrival or cut, counts once."""
    home, out = f"{root}/p={partition}", []
    for block in sorted(int(n[2:]) for n in _children(fs, home) if n.startswith("b=") and int(n[2:]) >= since // BLOCK):
        for name in _children(fs, f"{home}/b={block}"):
            if name.endswith(".parquet") and not name.startswith("_"):
                first, last, arrived = (int(x) for x in name[: -len(".parquet")].split("-"))
                out.append(Segment(arrived, partition, first, last))
    chain = []
    for s in sorted(out, key=lambda s: (s.first, -s.last, s.arrived_ms)):
        if s.first > since:
            break
        if s.last >= since:
            chain.append(s)
            since = s.last + 1
    return chain


def publish(messages: DataFrame, queue: str) -> int:
    """Writes messages (the columns of ``SCHEMA``, offsets dense per partition) as segments, each by one task's group of ``SEGMENT`` rows
    at most. A repeated call with the same messages writes the same files. Returns the number of segments."""

    block = BLOCK

    def write(part: pa.Table) -> pa.Table:
        fs, root = _store(queue)
        part = part.sort_by("offset").drop_columns(["_segment"])
        ends = [part.column(c).to_pylist() for c in ("offset", "arrived_ms")]
        s = Segment(max(ends[1]), part.column("queue_partition")[0].as_py(), ends[0][0], ends[0][-1])
        if s.last - s.first + 1 != part.num_rows:
            raise ValueError(f"offsets {s.first} to {s.last} of queue partition {s.queue_partition} are not dense")
        to = s.path(root, block)
        home = to.rsplit("/", 1)[0]
        fs.create_dir(home, recursive=True)
        draft = f"{home}/_{uuid.uuid4().hex}"
        pq.write_table(part, draft, filesystem=fs)
        if fs.get_file_info(to).type == pafs.FileType.NotFound:
            fs.move(draft, to)
        else:
            fs.delete_file(draft)
        return pa.table({"path": pa.array([to], pa.string())})

    rows = messages.selectExpr("string(key) AS key", "string(value) AS value", "int(queue_partition) AS queue_partition", "bigint(offset) AS offset", "bigint(arrived_ms) AS arrived_ms")
    return rows.withColumn("_segment", F.floor(F.col("offset") / SEGMENT)).groupBy("queue_partition", "_segment").applyInArrow(write, "path string").count()


@dataclass
class SegmentRange(InputPartition):
    """Messages ``begin`` to ``end`` (left out) of a segment."""

    path: str
    first: int
    begin: int
    end: int
    flush: int | None = None


class QueueReader(DataSourceStreamReader):
    def __init__(self, queue: str, max_records: int, max_seconds: float, max_batches: int = 1) -> None:
        self.queue, self.max_records, self.max_seconds, self.max_batches = queue, max_records, max_seconds, max_batches
        self.at: dict[str, int] | None = None  # the last offset given, or the checkpoint's one after a start

    def _now_ms(self) -> float:
        return time.time() * 1000

    def initialOffset(self) -> dict:
        return {}

    def admitted(self, at: dict[str, int], now_ms: float) -> dict[str, int]:
        """The offsets behind the messages that may go now, from listings alone."""
        fs, root = _store(self.queue)
        waiting: list[tuple[int, int, int, int]] = []
        for p in partitions_of(fs, root):
            arrived = 0
            for s in segments(fs, root, p, at.get(str(p), 0)):
                arrived = max(arrived, s.arrived_ms)  # within a partition the order is that of the offsets
                waiting.append((arrived, p, max(s.first, at.get(str(p), 0)), s.last + 1))
        waiting.sort()
        total = sum(end - begin for _, _, begin, end in waiting)
        if not waiting or (total < self.max_records and now_ms - waiting[0][0] < self.max_seconds * 1000):
            return at
        full = max(1, min(self.max_batches, total // self.max_records))
        out, room = dict(at), self.max_records * full
        if self.max_batches > 1:
            out[FLUSHES] = at.get(FLUSHES, 0) + full
        for _, p, begin, end in waiting:
            taken = min(room, end - begin)
            if taken:
                out[str(p)] = begin + taken
            room -= taken
        return out

    def latestOffset(self) -> dict:
        self.at = self.admitted(self.initialOffset() if self.at is None else self.at, self._now_ms())
        return self.at

    def partitions(self, start: dict, end: dict) -> list[SegmentRange]:
        if self.at is None:  # a query that starts again tells the offset that it has reached
            self.at = dict(end)
        fs, root = _store(self.queue)
        out, order = [], []
        for p, stop in sorted((p, stop) for p, stop in end.items() if p != FLUSHES):
            begin, arrived = start.get(p, 0), 0
            for s in segments(fs, root, int(p), begin) if stop > begin else []:
                if s.first < stop:
                    arrived = max(arrived, s.arrived_ms)
                    out.append(SegmentRange(s.path(root), s.first, max(s.first, begin), min(s.last + 1, stop)))
                    order.append((arrived, int(p), out[-1].begin))
                    begin = s.last + 1
        if self.max_batches == 1:
            return out
        return self._flushes([r for _, r in sorted(zip(order, out, strict=True), key=lambda x: x[0])], start.get(FLUSHES, 0))

    def _flushes(self, ranges: list[SegmentRange], flush: int) -> list[SegmentRange]:
        """Ranges in the order of arrival, cut where a flush is full."""
        out, room = [], self.max_records
        for r in ranges:
            begin = r.begin
            while begin < r.end:
                if not room:
                    flush, room = flush + 1, self.max_records
                taken = min(room, r.end - begin)
                out.append(SegmentRange(r.path, r.first, begin, begin + taken, flush))
                begin, room = begin + taken, room - taken
        return out

    def read(self, partition: SegmentRange) -> Iterator[pa.RecordBatch]:
        fs, _ = _store(self.queue)
        table = pq.read_table(partition.path, filesystem=fs, columns=[f.split()[0] for f in SCHEMA.split(", ")])
        part = table.slice(partition.begin - partition.first, partition.end - partition.begin).combine_chunks()
        yield from part.append_column("flush", pa.array([partition.flush] * part.num_rows, pa.int64())).to_batches()

    def commit(self, end: dict) -> None:
        """Segments stay: other queries may read them."""


class QueueSource(DataSource):
    """Options: ``path`` of the queue, ``maxRecords`` and ``maxSeconds`` of the flush rule, ``maxBatches`` of a micro-batch."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA + ", flush long"

    def streamReader(self, schema) -> QueueReader:
        o = self.options
        return QueueReader(
            o["path"], int(o.get("maxRecords", specs.FLUSH_RECORDS)), float(o.get("maxSeconds", specs.FLUSH_SECONDS)), int(o.get("maxBatches", 1))
        )


def queue_source(
    spark: SparkSession, queue: str, max_records: int = specs.FLUSH_RECORDS, max_seconds: float = specs.FLUSH_SECONDS, max_batches: int = 1
) -> DataFrame:
    """Messages as a stream with the columns that ``ingest`` takes from any source: key, value, _offset, arrived. With ``max_batches``
    over one also ``flush``: a micro-batch then holds that many full flushes at most."""
    spark.dataSource.register(QueueSource)
    rule = {"maxRecords": str(max_records), "maxSeconds": str(max_seconds), "maxBatches": str(max_batches)}
    raw = spark.readStream.format(NAME).options(**rule).load(queue)
    flush = ["flush"] if max_batches > 1 else []
    return raw.select("key", "value", F.struct(F.col("queue_partition").alias("partition"), "offset").alias("_offset"), F.timestamp_millis("arrived_ms").cast("timestamp_ntz").alias("arrived"), *flush)
