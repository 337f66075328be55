import json
from pathlib import Path

from starload import specs
from starload.operators import cleaning
from starload.sources import csv

ROWS = [
    "1,Ana Ruiz,2021-11-07T02:48:42Z,1,2",
    "2,Luis Paz,2021-11-07 02:48:42,1,2",
    "3,,2021-11-07T02:48:42Z,1,2",
    "4,NULL,2021-11-07T02:48:42Z,1,2",
    "5,nUlL,2021-11-07T02:48:42Z,1,2",
    "6,   ,2021-11-07T02:48:42Z,1,2",
    "7,Eva Gil,2021-02-30T00:00:00Z,1,2",
    "8,Eva Gil,2021-01-05T10:00:00Z,x,2",
    "9,Eva Gil,2021-01-05T10:00:00Z,1.9,2",
    "10,Eva Gil,2021-01-05T10:00:00Z,0.5,2",
    "11,Eva Gil,2021-01-05T10:00:00Z,-3,2",
    "12,Eva Gil,2021-01-05T10:00:00Z,3000000000,2",
    "13,Eva Gil,2021-01-05T10:00:00Z,12d,2",
    "14,Bad One,oops,1,2",
    "14,Good One,2021-01-05T10:00:00Z,1,2",
    "15,First,2021-01-05T10:00:00Z,1,2",
    "15,Second,2021-01-05T10:00:00Z,1,2",
    "16,C3PO,2021-01-05T10:00:00Z,1,2",
    "x1,Eva Gil,2021-01-05T10:00:00Z,1,2",
]

EXPECTED_STEP = {
    "3": "required", "4": "required", "5": "name_token", "6": "name_blank", "7": "timestamp",
    "8": "fk_not_numeric", "10": "fk_not_positive", "11": "fk_not_positive", "12": "fk_not_numeric",
    "13": "fk_not_numeric", "x1": "bad_id",
}


def _read(spark, workdir, lines, header_line=None):
    d = Path(workdir) / "in"
    d.mkdir(parents=True, exist_ok=True)
    text = ([header_line] if header_line else []) + lines
    (d / "hires.csv").write_text("\n".join(text))  # no final newline, as in the bundled files
    return csv.read_raw(spark, str(d), specs.HIRED_EMPLOYEES)


def test_cleaning_golden_rows(spark, workdir):
    res = cleaning.clean(_read(spark, workdir, ROWS), specs.HIRED_EMPLOYEES, position=csv.POSITION)
    kept = {r.id: r for r in res.kept.collect()}
    assert sorted(kept) == [1, 2, 9, 14, 15, 16]
    assert kept[9].department_id == 1
    assert kept[14].name == "Good One"
    assert kept[15].name == "First"
    assert str(kept[1].datetime) == "2021-11-07 02:48:42"
    steps = {}
    for r in res.annotated.where("_drop_step is not null").collect():
        steps.setdefault(r["_raw"]["id"], set()).add(r["_drop_step"])
    for r in res.dropped.where("_drop_step = 'duplicate'").collect():
        steps.setdefault(json.loads(r["_raw"])["id"], set()).add("duplicate")
    for rid, step in EXPECTED_STEP.items():
        assert step in steps[rid], (rid, steps.get(rid))
    assert "duplicate" in steps["15"] and "timestamp" in steps["14"]
    # law: kept + dropped = input
    assert res.kept.count() + res.dropped.count() == len(ROWS)


def test_header_sniff_uses_whole_tokens(spark, workdir):
    # "David" contains "id" as a substring; the first line is still data
    df = _read(spark, workdir, ["1,David,2021-01-01T00:00:00Z,1,2", "2,Ana,2021-01-01T00:00:00Z,1,2"])
    assert sorted(r.name for r in df.collect()) == ["Ana", "David"]


def test_headed_file_read_by_name(spark, workdir):
    df = _read(spark, workdir, ["2,7,Ana,2021-01-01T00:00:00Z,1"], header_line="job_id,id,name,datetime,department_id")
    r = df.first()
    assert (r.id, r.name, r.job_id, r.department_id) == ("7", "Ana", "2", "1")


def test_dim_space_padded_null_kept(spark, workdir):
    d = Path(workdir) / "dims"
    d.mkdir()
    (d / "departments.csv").write_text("1, null \n2,NULL\n3,Ok\n3,Later")
    raw = csv.read_raw(spark, str(d), specs.DEPARTMENTS)
    kept = {r.id: r.name for r in cleaning.clean(raw, specs.DEPARTMENTS, position=csv.POSITION).kept.collect()}
    assert kept == {1: "null", 3: "Ok"}


def test_keep_first_stable_across_partitionings(spark):
    from pyspark.sql import functions as F

    base = spark.range(0, 20000).select(
        (F.col("id") % 997).cast("string").alias("id"), F.lit("Ana").alias("name"),
        F.lit("2021-01-01T00:00:00").alias("datetime"), F.lit("1").alias("department_id"),
        F.lit("1").alias("job_id"), F.col("id").alias("_pos"),
    )
    a = cleaning.clean(base, specs.HIRED_EMPLOYEES).kept.select("id", "_pos")
    b = cleaning.clean(base.repartition(13), specs.HIRED_EMPLOYEES).kept.select("id", "_pos")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.where("_pos >= 997").count() == 0


def test_hot_key_keep_first_is_an_aggregate(spark):
    from pyspark.sql import functions as F

    # a third of the rows share one id
    base = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("999999")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("Ana").alias("name"), F.lit("2021-01-01T00:00:00").alias("datetime"),
        F.lit("1").alias("department_id"), F.lit("1").alias("job_id"), (F.lit(30000) - F.col("id")).alias("_pos"),
    )
    res = cleaning.clean(base, specs.HIRED_EMPLOYEES)
    hot = res.kept.where("id = 999999").collect()
    assert len(hot) == 1 and hot[0]._pos == 30000 - 29997
    assert res.kept.count() == 1 + 20000
    res.kept.collect()
    plan = res.kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "min_by" in plan
