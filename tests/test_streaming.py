import json
from pathlib import Path

import pytest

from starload.operators import loading
from starload.streaming import ingest as stream_ingest


def _messages():
    msgs = []
    for i in range(40):
        payload = {"id": 100 + i, "name": "Ana Gil", "datetime": "2023-01-01T10:00:00", "department_id": 1 + i % 2, "job_id": 1}
        if i % 7 == 3:
            payload["name"] = "A"
        msgs.append({"key": str(100 + i), "value": json.dumps({"table": "hired_employees", "payload": payload}), "offset": i})
    msgs.append({"key": "", "value": json.dumps({"table": "hired_employees", "payload": {"name": "No Id", "datetime": "2023-01-01T10:00:00", "department_id": 1, "job_id": 1}}), "offset": 40})
    msgs.append({"key": "", "value": "not json", "offset": 41})
    return msgs


def _setup(spark, root, split):
    tables = f"{root}/tables"
    loading.staged_overwrite(spark.createDataFrame([(1, "Sales"), (2, "Legal")], "id int, name string"), f"{tables}/departments")
    loading.staged_overwrite(spark.createDataFrame([(1, "Clerk")], "id int, name string"), f"{tables}/jobs")
    loading.staged_overwrite(spark.createDataFrame([(7, "Old", None, 1, 1)], "id int, name string, datetime timestamp_ntz, department_id int, job_id int"), f"{tables}/hired_employees")
    src = Path(root) / "src"
    src.mkdir(parents=True)
    msgs = _messages()
    size = -(-len(msgs) // split)
    for k in range(split):
        part = msgs[k * size:(k + 1) * size]
        (src / f"m{k:03d}.json").write_text("\n".join(json.dumps(m) for m in part))
    cfg = stream_ingest.IngestConfig(
        tables_dir=tables, stream_dir=f"{root}/stream", reject_dir=f"{root}/rejects",
        checkpoint=f"{root}/ckpt", as_of="2025-01-01 00:00:00",
    )
    return str(src), cfg


def _run(spark, src, cfg):
    q = stream_ingest.start(stream_ingest.file_source(spark, src, max_files=1), cfg, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_equals_batch_and_restart(spark, workdir):
    results = []
    for split in (1, 3):
        root = f"{workdir}/s{split}"
        src, cfg = _setup(spark, root, split)
        _run(spark, src, cfg)
        rows = spark.read.parquet(f"{cfg.stream_dir}/hired_employees").select("id", "name", "department_id")
        rej = spark.read.parquet(cfg.reject_dir).where("error_type <> 'BATCH_SUMMARY'")
        results.append((sorted(map(tuple, rows.collect())), sorted(r.error_type for r in rej.collect())))
        # restart from the checkpoint: nothing new, nothing duplicated
        _run(spark, src, cfg)
        assert spark.read.parquet(f"{cfg.stream_dir}/hired_employees").count() == len(results[-1][0])
    assert results[0] == results[1]
    loaded, errors = results[0]
    assert len(loaded) == 41 - 6  # 6 short names rejected, one row got an assigned id
    assert errors.count("VALIDATION_ERROR") == 6 and errors.count("INVALID_ENVELOPE") == 1
    assert (140, "No Id", 1) in loaded or any(r[1] == "No Id" and r[0] > 139 for r in loaded)


def test_the_id_store_changes_no_outcome(spark, workdir, monkeypatch):
    from starload.operators import id_store

    monkeypatch.setattr(id_store, "FAN", 2)
    results = []
    for store in (None, f"{workdir}/ids"):
        root = f"{workdir}/with{bool(store)}"
        src, cfg = _setup(spark, root, 3)
        cfg.id_store = store
        _run(spark, src, cfg)
        rows = spark.read.parquet(f"{cfg.stream_dir}/hired_employees").select("id", "name")
        rejected = spark.read.parquet(cfg.reject_dir).where("error_type <> 'BATCH_SUMMARY'").select("error_type", "error_message")
        results.append((sorted(map(tuple, rows.collect())), sorted(map(tuple, rejected.collect()))))
    assert results[0] == results[1]
    kept = id_store.IdStore(spark, f"{workdir}/ids/hired_employees")
    assert [(r.first, r.last) for r in kept.runs()] == [(-1, -1), (0, 1)] and kept.recent() == [2]
    batch = spark.createDataFrame([(m["key"], m["value"], (0, m["offset"])) for m in _messages()[-9:]], "key string, value string, _offset struct<file: int, offset: long>")
    batch = batch.selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' AS arrived")
    runs = []
    for _ in range(2):  # a batch that is run again accepts what the first run accepted
        cfg.stream_dir = f"{workdir}/replay"
        stream_ingest.process_batch(batch, 3, cfg)
        runs.append(sorted(map(tuple, spark.read.parquet(f"{workdir}/replay/hired_employees/batch_id=3").select("id", "name").collect())))
    assert runs[0] == runs[1] == [(max(r[0] for r in results[0][0]) + 1, "No Id")]


def _run_bursts(spark, root, schema, **rule):
    """Until the files there are used up, and no more; started again it goes on from its checkpoint."""
    from starload.streaming.burst import burst_flags_stream, keyed_state

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")
    flagged = burst_flags_stream(stream, key="user_id", ts="ts", tie="event_id", **rule)
    with keyed_state(spark):
        q = flagged.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_bursts_equal_batch_and_late_calls_are_set_apart(spark, workdir):
    import datetime as dt
    import random

    from starload.operators.burst import burst_flags

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    rng, t0 = random.Random(4), dt.datetime(2024, 1, 1)
    rows = [(k, k * 1000 + i, t0 + dt.timedelta(seconds=7 * (i // 2) + k)) for k in (1, 2, 3) for i in range(80)]  # calls of one time too
    end = t0 + dt.timedelta(seconds=300)
    late = [r for r in rows if r[2] < t0 + dt.timedelta(seconds=100) and rng.random() < 0.2] + [(4, 4000, t0)]
    soon = [r for r in rows if r not in late]
    # within the delay of 60 s calls come in any order, and a third part of them a batch later than their neighbours
    first = [r for r in soon if r[2] < t0 + dt.timedelta(seconds=180) and rng.random() < 0.7 or r[2] < t0 + dt.timedelta(seconds=125)]
    second = [r for r in soon if r not in first]
    rng.shuffle(first)
    rng.shuffle(second)
    schema = "user_id long, event_id long, ts timestamp_ntz"
    rule = {"limit": 4, "ttl_seconds": 30, "watermark": "1 minute", "slot_seconds": 8}
    for part in (first, second, [*late, (5, 5000, None), (None, None, end + dt.timedelta(hours=1))]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{workdir}/events")
        _run_bursts(spark, workdir, schema, **rule)
    got = spark.read.parquet(f"{workdir}/out").collect()
    assert len(got) == len(rows) + 2
    assert sorted(r.event_id for r in got if r.late) == sorted([*(r[1] for r in late), 5000]) and all(r.flagged is None for r in got if r.late)
    want = {r.event_id: r.flagged for r in burst_flags(spark.createDataFrame(soon, schema), key="user_id", ts="ts", tie="event_id", limit=4, ttl_seconds=30).collect()}
    assert {r.event_id: r.flagged for r in got if not r.late} == want and any(want.values())
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


@pytest.mark.parametrize("leased", [False, True])
def test_a_replayed_batch_gives_the_same_rows(spark, workdir, leased):
    src, cfg = _setup(spark, f"{workdir}/replay", 1)
    cfg.id_leases = f"{workdir}/leases" if leased else None
    msgs = _messages() + [
        {"key": "", "value": json.dumps({"table": "jobs", "payload": {"id": 3000000000, "name": "Too large"}}), "offset": 50},
        {"key": "", "value": json.dumps({"table": "jobs", "payload": {"name": "No id"}}), "offset": 51},
        {"key": "", "value": json.dumps({"table": "jobs", "payload": {"id": 77, "name": "Fine"}}), "offset": 52},
    ]
    batch = spark.createDataFrame([(m["key"], m["value"], (0, m["offset"])) for m in msgs], "key string, value string, _offset struct<file: int, offset: long>")
    batch = batch.selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' AS arrived")
    runs = []
    for _ in range(2):
        stream_ingest.process_batch(batch, 0, cfg)
        rows = {t: sorted(map(tuple, spark.read.parquet(f"{cfg.stream_dir}/{t}/batch_id=0").select("id", "name").collect())) for t in ("hired_employees", "jobs")}
        errors = sorted(r.error_type for r in spark.read.parquet(cfg.reject_dir).collect())
        runs.append((rows, errors))
    assert runs[0] == runs[1]
    assert runs[0][0]["jobs"] == [(77, "Fine")] and runs[0][1].count("BAD_ID") == 2
    stream_ingest.process_batch(batch, 1, cfg)  # a later batch meets the ids of the one before
    assert not spark.read.parquet(f"{cfg.stream_dir}/jobs/batch_id=1").count()
