import datetime as dt

from starload.operators import rejects

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def _log(spark):
    rows = [
        (1, T0 - dt.timedelta(hours=30), "jobs", "1", "VALIDATION_ERROR", "NAME_SHORT", None),
        (2, T0 - dt.timedelta(hours=24), "jobs", "2", "MISSING_REQUIRED_FIELDS", "REQUIRED(name)", None),
        (3, T0 - dt.timedelta(hours=2), "hired_employees", "3", "VALIDATION_ERROR", "FK_MISSING(job_id)", None),
        (4, T0 - dt.timedelta(hours=2), "hired_employees", "4", "VALIDATION_ERROR", "x" * 120, None),
        (5, T0 + dt.timedelta(days=40), "departments", None, "UNKNOWN_TABLE", "UNKNOWN_TABLE(zzz)", None),
    ]
    return spark.createDataFrame(
        rows, "id long, timestamp timestamp_ntz, table_name string, record_id string, error_type string, error_message string, raw_data string"
    )


def test_log_filter_window_is_inclusive(spark):
    log = _log(spark)
    ids = sorted(r.id for r in rejects.log_filter(log, as_of=T0, last_hours=24).collect())
    assert ids == [2, 3, 4, 5]
    ids = sorted(r.id for r in rejects.log_filter(log, as_of=T0, last_hours=24, table="hired_employees", error_type="VALIDATION_ERROR").collect())
    assert ids == [3, 4]


def test_latest_ties_by_id(spark):
    assert [r.id for r in rejects.latest(_log(spark), 3).collect()] == [5, 4, 3]


def test_summary_and_rollup(spark):
    summ = {(r.level, r.value): r.n for r in rejects.log_summary(_log(spark)).collect()}
    assert summ[("total", "")] == 5
    assert summ[("table", "jobs")] == 2 and summ[("error_type", "VALIDATION_ERROR")] == 3
    roll = {(r.year, r.month, r.day): r.n for r in rejects.log_date_rollup(_log(spark)).collect()}
    assert roll[(None, None, None)] == 5 and roll[(2024, 1, None)] == 4 and roll[(2024, 2, 19)] == 1


def test_search_and_display(spark):
    log = _log(spark)
    assert sorted(r.id for r in rejects.log_search(log, "fk_missing").collect()) == [3]
    disp = {r.id: r for r in rejects.with_display(log).collect()}
    assert disp[4].message_short == "x" * 100 + "..." and disp[4].severity == "ERROR"
    assert disp[2].severity == "WARNING" and disp[5].severity == "WARNING"


def test_batch_summary_only_failed_and_rate(spark):
    checked = spark.createDataFrame(
        [("jobs", 1, None), ("jobs", 1, "VALIDATION_ERROR"), ("jobs", 1, None), ("jobs", 2, None)],
        "table string, batch_id long, error_type string",
    )
    rows = rejects.batch_summary(checked).collect()
    assert len(rows) == 1 and rows[0].batch_id == 1 and rows[0].success_rate == 66.67
    reply = {r.batch_id: (r.accepted, r.rejected, r.status) for r in rejects.batch_reply(checked).collect()}
    assert reply == {1: (2, 1, 202), 2: (1, 0, 202)}
