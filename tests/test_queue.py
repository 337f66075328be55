import json
import time

import pyarrow.fs as pafs
import pytest

from starload.streaming import ingest, queue
from starload.streaming.queue import QueueReader, publish, queue_source, segments

MESSAGES = "key string, value string, queue_partition int, offset long, arrived_ms long"


def _publish(spark, root, partition, offsets, arrived_ms, value="v"):
    publish(spark.createDataFrame([(str(o), value if isinstance(value, str) else value(o), partition, o, arrived_ms) for o in offsets], MESSAGES), root)


def test_admission_by_count_and_by_age(spark, workdir):
    root, now = f"{workdir}/q", 10_000_000
    reader = QueueReader(root, max_records=100, max_seconds=2)
    assert reader.admitted({}, now) == {}
    _publish(spark, root, 0, range(60), now - 500)
    assert reader.admitted({}, now) == {}  # too few and too young
    assert reader.admitted({}, now + 1499) == {} and reader.admitted({}, now + 1500) == {"0": 60}  # the oldest has waited two seconds
    _publish(spark, root, 1, range(70), now - 600)
    assert reader.admitted({}, now) == {"1": 70, "0": 30}  # exactly as many as a batch holds, in the order of arrival
    assert reader.admitted({"1": 70, "0": 30}, now) == {"1": 70, "0": 30}
    assert reader.admitted({"1": 70, "0": 30}, now + 5000) == {"1": 70, "0": 60}
    assert [(p.begin, p.end) for p in reader.partitions({"1": 10}, {"1": 70, "0": 30})] == [(0, 30), (10, 70)]
    rows = [r for p in reader.partitions({"1": 68}, {"1": 70}) for b in reader.read(p) for r in b.column("offset").to_pylist()]
    assert rows == [68, 69]


def test_gaps_blocks_and_repeated_publishing(spark, workdir, monkeypatch):
    monkeypatch.setattr(queue, "BLOCK", 40)
    monkeypatch.setattr(queue, "SEGMENT", 20)
    root = f"{workdir}/q"
    fs = pafs.LocalFileSystem()
    _publish(spark, root, 3, range(50), 1)
    _publish(spark, root, 3, range(50), 1)
    assert [(s.first, s.last) for s in segments(fs, root, 3, 0)] == [(0, 19), (20, 39), (40, 49)]
    assert [(s.first, s.last) for s in segments(fs, root, 3, 45)] == [(40, 49)]
    _publish(spark, root, 3, range(60, 65), 1)  # 50 to 59 are not there yet
    assert segments(fs, root, 3, 0)[-1].last == 49
    _publish(spark, root, 3, range(50, 60), 2)
    assert segments(fs, root, 3, 0)[-1].last == 64
    with pytest.raises(Exception, match="not dense"):
        _publish(spark, root, 4, [0, 2], 1)


def _drain(spark, root, ck, batches, **rule):
    def take(df, batch_id):
        batches[batch_id] = sorted((r._offset.partition, r._offset.offset) for r in df.collect())

    q = queue_source(spark, root, **rule).writeStream.option("checkpointLocation", ck).foreachBatch(take).trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_stream_flushes_and_goes_on_after_a_restart(spark, workdir):
    root, ck, batches = f"{workdir}/q", f"{workdir}/ck", {}
    _publish(spark, root, 0, range(130), 1000)
    _publish(spark, root, 1, range(90), 2000)
    _drain(spark, root, ck, batches, max_records=100)
    assert [len(batches[b]) for b in sorted(batches)] == [100, 100, 20]
    _publish(spark, root, 1, range(90, 300), int(time.time() * 1000) + 3_600_000)
    _drain(spark, root, ck, batches, max_records=100)  # the last ten are too young: they wait
    assert [len(batches[b]) for b in sorted(batches)] == [100, 100, 20, 100, 100]
    _drain(spark, root, ck, batches, max_records=100, max_seconds=-7200)
    assert [len(batches[b]) for b in sorted(batches)][-1] == 10
    everything = [x for b in sorted(batches) for x in batches[b]]
    assert len(everything) == len(set(everything)) == 130 + 300


def test_messages_of_the_queue_are_ingested(spark, workdir):
    from starload.operators import loading

    for name, rows in {"departments": [(1, "Sales")], "jobs": [(1, "Clerk")], "hired_employees": [(7, "Old")]}.items():
        loading.staged_overwrite(spark.createDataFrame(rows, "id int, name string"), f"{workdir}/tables/{name}")
    body = lambda o: json.dumps({"table": "hired_employees", "payload": {"id": 100 + o % 30, "name": "Ana Gil", "datetime": "2023-01-01T10:00:00", "department_id": 1, "job_id": 1}})
    _publish(spark, f"{workdir}/q", 0, range(40), 1000, body)
    cfg = ingest.IngestConfig(tables_dir=f"{workdir}/tables", stream_dir=f"{workdir}/stream", reject_dir=f"{workdir}/rejects", checkpoint=f"{workdir}/ckpt", as_of="2025-01-01 00:00:00")
    q = ingest.start(queue_source(spark, f"{workdir}/q", max_records=25), cfg, seconds=0)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    loaded = spark.read.parquet(f"{workdir}/stream/hired_employees")
    assert sorted((r.batch_id, r.id) for r in loaded.select("batch_id", "id").collect()) == [(0, 100 + k) for k in range(25)] + [(1, 125 + k) for k in range(5)]
    errors = [r.error_type for r in spark.read.parquet(f"{workdir}/rejects").where("error_type <> 'BATCH_SUMMARY'").collect()]
    assert errors == ["VALIDATION_ERROR"] * 10  # ids that the first batch has stored


def test_a_micro_batch_holds_the_full_flushes_that_wait(spark, workdir):
    root, now = f"{workdir}/q", 10_000_000
    _publish(spark, root, 0, range(130), now - 500)
    _publish(spark, root, 1, range(120), now - 600)
    reader = QueueReader(root, max_records=100, max_seconds=2, max_batches=5)
    first = reader.admitted({}, now)
    assert first == {"1": 120, "0": 80, "flushes": 2} and reader.admitted(first, now) == first  # the last fifty are too young
    assert [(p.flush, p.begin, p.end) for p in reader.partitions({}, first)] == [(0, 0, 100), (1, 100, 120), (1, 0, 80)]
    last = reader.admitted(first, now + 5000)
    assert last == {"1": 120, "0": 130, "flushes": 3} and [(p.flush, p.begin, p.end) for p in reader.partitions(first, last)] == [(2, 80, 130)]
    got = {}
    q = queue_source(spark, root, max_records=100, max_batches=2).writeStream.option("checkpointLocation", f"{workdir}/ck")
    q = q.foreachBatch(lambda df, b: got.update({b: sorted((r.flush, r["count"]) for r in df.groupBy("flush").count().collect())})).trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert got == {0: [(0, 100), (1, 100)], 1: [(2, 50)]}
