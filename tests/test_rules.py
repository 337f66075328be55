import json

import pytest
from pyspark.sql import functions as F

from starload.operators import ingest

AS_OF = "2025-01-01 00:00:00"
BASE = {"id": 1, "name": "Ana Ñu", "datetime": "2023-01-01T10:00:00", "department_id": 1, "job_id": 1}


def _with(**kw):
    rec = dict(BASE)
    for k, v in kw.items():
        if v is _DROP:
            rec.pop(k, None)
        else:
            rec[k] = v
    return rec


_DROP = object()

CASES = [
    (_with(), None, []),
    (_with(id=_DROP), None, []),
    (_with(id=None), None, []),
    (_with(department_id=0), "MISSING_REQUIRED_FIELDS", ["REQUIRED(department_id)"]),
    (_with(department_id="0"), "VALIDATION_ERROR", ["FK_POSITIVE(department_id)"]),
    (_with(name="  ", job_id=_DROP), "MISSING_REQUIRED_FIELDS", ["REQUIRED(name)", "REQUIRED(job_id)"]),
    (_with(name="A"), "VALIDATION_ERROR", ["NAME_SHORT"]),
    (_with(name="a" * 256), "VALIDATION_ERROR", ["NAME_LONG"]),
    (_with(name="a" * 255), None, []),
    (_with(name="O'Neil"), "VALIDATION_ERROR", ["NAME_CHARSET"]),
    (_with(name="Üna"), "VALIDATION_ERROR", ["NAME_CHARSET"]),
    (_with(name="C3PO"), "VALIDATION_ERROR", ["NAME_CHARSET"]),
    (_with(name="Ana-M. Gil"), None, []),
    (_with(datetime="2023-01-01T10:00:00Z"), "VALIDATION_ERROR", ["TS_FORMAT"]),
    (_with(datetime="2023-01-01 10:00:00"), None, []),
    (_with(datetime="2023-01-01T10:00:00.5"), None, []),
    (_with(name="A", datetime="bad", department_id=99), "VALIDATION_ERROR", ["NAME_SHORT", "TS_FORMAT"]),
    (_with(datetime=20230101), "VALIDATION_ERROR", ["TS_TYPE"]),
    (_with(datetime="2026-01-01T00:00:00", department_id=99), "VALIDATION_ERROR", ["TS_FUTURE", "FK_MISSING(department_id)"]),
    (_with(department_id=" 2 "), None, []),
    (_with(department_id=1.7), None, []),
    (_with(department_id="1.7"), "VALIDATION_ERROR", ["FK_INTEGER(department_id)"]),
    (_with(department_id=[]), "MISSING_REQUIRED_FIELDS", ["REQUIRED(department_id)"]),
    (_with(department_id=False), "MISSING_REQUIRED_FIELDS", ["REQUIRED(department_id)"]),
    (_with(id=7), "VALIDATION_ERROR", ["ID_EXISTS"]),
    (_with(id=0), "VALIDATION_ERROR", ["ID_RANGE"]),
    (_with(id=2147483648), "VALIDATION_ERROR", ["ID_RANGE"]),
    (_with(id="x"), "VALIDATION_ERROR", ["ID_INTEGER"]),
]


@pytest.fixture(scope="module")
def checked(spark):
    # one batch per golden case (they share id 1); the duplicate pair below shares batch 999
    msgs = [(i, i, json.dumps({"table": "hired_employees", "payload": rec})) for i, (rec, _, _) in enumerate(CASES)]
    n = len(msgs)
    msgs.append((n, 0, json.dumps({"table": "zzz", "payload": {"name": "Ana"}})))
    msgs.append((n + 1, 0, json.dumps({"table": "jobs"})))
    msgs.append((n + 2, 0, "not json"))
    msgs.append((n + 3, 999, json.dumps({"table": "jobs", "payload": {"id": 5, "name": "Lead"}})))
    msgs.append((n + 4, 999, json.dumps({"table": "jobs", "payload": {"id": 5, "name": "Clerk"}})))
    msgs.append((n + 5, 0, json.dumps({"table": "jobs", "payload": {"id": 1, "name": "Ab"}, "extra": 1})))
    df = spark.createDataFrame(msgs, "_offset long, batch_id long, value string")
    ids12 = spark.createDataFrame([(1,), (2,)], "id long")
    fact_ids = spark.createDataFrame([(7,)], "id long")
    dims = {"departments": ids12, "jobs": ids12}
    targets = {"departments": ids12, "jobs": ids12, "hired_employees": fact_ids}
    out = ingest.check_messages(df, dims=dims, targets=targets, as_of=AS_OF)
    return {r["_offset"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_fact_golden(checked, i):
    _, etype, codes = CASES[i]
    row = checked[i]
    assert row["error_type"] == etype, (CASES[i][0], row["error_codes"])
    assert list(row["error_codes"]) == codes


def test_unknown_table_envelope_and_duplicates(checked):
    n = len(CASES)
    assert checked[n]["error_type"] == "UNKNOWN_TABLE"
    assert checked[n + 1]["error_type"] == "INVALID_ENVELOPE"
    assert checked[n + 2]["error_type"] == "INVALID_ENVELOPE"
    assert checked[n + 3]["error_type"] is None
    assert checked[n + 4]["error_type"] == "DUPLICATE_IN_BATCH"
    assert checked[n + 5]["error_type"] == "INVALID_ENVELOPE"


def test_accepted_plus_rejected_is_input(checked):
    acc = sum(1 for r in checked.values() if r["error_type"] is None)
    rej = sum(1 for r in checked.values() if r["error_type"] is not None)
    assert acc + rej == len(checked)


def _hires(spark, n):
    payload = '\'{"table":"hired_employees","payload":{"name":"Ana Gil","datetime":"2023-01-01T10:00:00","department_id":1,"job_id":1}}\''
    return spark.range(n).selectExpr("id AS _offset", "0L AS batch_id", f"{payload} AS value")


def test_messages_are_read_once_and_records_without_id_spread(spark):
    from starload.operators.ingest import check_messages

    ids = spark.createDataFrame([(1,), (None,)], "id bigint")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        tables = {"departments": ids, "jobs": ids}
        checked = check_messages(_hires(spark, 2000), dims=tables, targets={**tables, "hired_employees": ids}, as_of="2025-01-01 00:00:00")
        assert "parse_json" not in checked._jdf.queryExecution().optimizedPlan().toString()
        per_task = [r["count"] for r in checked.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 2000 and max(per_task) < 1000
        assert checked.where("error_type is not null").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
