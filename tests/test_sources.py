from pyspark.sql import functions as F

from starload import specs
from starload.sources import csv
from starload.sources.envelope import parse_envelope, to_envelope


def test_envelope_roundtrip(spark):
    recs = spark.createDataFrame([(1, "Sales"), (None, "Legal")], "id int, name string")
    env = to_envelope(recs, "departments")
    rows = env.collect()
    assert [r.key for r in rows] == ["1", ""]
    assert {r.topic for r in rows} == {"raw.departments"}
    parsed = parse_envelope(env).select("envelope_ok", "table", F.try_variant_get("payload", "$.name", "string").alias("n"))
    assert [tuple(r) for r in parsed.collect()] == [(True, "departments", "Sales"), (True, "departments", "Legal")]


def test_csv_keeps_blanks_and_padding(spark, workdir):
    df = spark.createDataFrame([("1", "", "  x ", "NULL", "a,b")], "id string, name string, datetime string, department_id string, job_id string")
    csv.write_csv(df, f"{workdir}/c", header=False)
    back = csv.read_raw(spark, f"{workdir}/c", specs.HIRED_EMPLOYEES, header=False).first()
    assert (back.id, back.name, back.datetime, back.department_id, back.job_id) == ("1", "", "  x ", "NULL", "a,b")


def test_structure_check_missing_and_extra(spark, workdir):
    from pathlib import Path

    d = Path(workdir) / "s"
    d.mkdir()
    (d / "a.csv").write_text("id,name,extra\n1,Ana,x\n")
    (d / "b.csv").write_text("1,Ana\n")
    rows = {r.file: r for r in csv.structure_check(spark, str(d), specs.DEPARTMENTS.columns).collect()}
    assert rows["a.csv"].ok and rows["a.csv"].extra == ["extra"]
    assert rows["b.csv"].ok and rows["b.csv"].missing == []
    (d / "c.csv").write_text("name,other\nAna,1\n")
    rows = {r.file: r for r in csv.structure_check(spark, str(d), specs.DEPARTMENTS.columns).collect()}
    assert not rows["c.csv"].ok and rows["c.csv"].missing == ["id"]


def test_profile_sample_and_size(spark, workdir):
    from pathlib import Path

    d = Path(workdir) / "p"
    d.mkdir()
    (d / "a.csv").write_text("\n".join(f"{i},Name{i}" for i in range(1, 21)))
    df = csv.read_raw(spark, str(d), specs.DEPARTMENTS)
    prof = csv.profile(df).first()
    assert (prof.rows, prof.n_columns, prof.columns) == (20, 2, "id,name")
    assert [r.id for r in csv.sample_rows(df).collect()] == ["1", "2", "3", "4", "5"]
    assert 0 < csv.files_size_mb(spark, str(d)) < 1


def test_headers_and_data_rows_are_told_apart():
    expected = ("id", "name")
    assert csv.header_names('id, "name"', expected) == ("id", "name")
    assert csv.header_names(" name ,note,id", expected) == ("name", "note", "id")
    for row in ("1,id", "1,David", "id,id", "", '7,"name"', "a,b"):
        assert csv.header_names(row, expected) is None


def test_files_of_differing_headers_and_quoted_cells(spark, workdir):
    from pathlib import Path

    d = Path(workdir) / "h"
    d.mkdir()
    (d / "a.csv").write_text('id,name\n1,"Ana ""the"" Gil"\n')
    (d / "b.csv").write_text('name, id\n"Luis\nPaz",2\n')
    (d / "c.csv").write_text("3,id\n")
    (d / "d.csv").write_text("")
    got = csv.read_raw(spark, str(d), specs.DEPARTMENTS, multiline=True).select("id", "name").collect()
    assert sorted(map(tuple, got)) == [("1", 'Ana "the" Gil'), ("2", "Luis\nPaz"), ("3", "id")]


def test_restore_checks_the_columns_before_the_target_is_touched(spark, workdir):
    import datetime as dt

    import pytest

    from starload.sources import backup

    now = dt.datetime(2024, 1, 1)
    with pytest.raises(ValueError, match="table must be one of"):
        backup.take_snapshot(spark.range(1), workdir, "lineitem", as_of=now)
    target = f"{workdir}/target/departments"
    spark.createDataFrame([(1, "Sales")], "id int, name string").write.parquet(target)
    backup.take_snapshot(spark.createDataFrame([(2, "x")], "id int, title string"), workdir, "departments", as_of=now)
    with pytest.raises(ValueError, match=r"missing columns \['name'\], unknown columns \['title'\]"):
        backup.restore(spark, workdir, "departments", target)
    assert [r.name for r in spark.read.parquet(target).collect()] == ["Sales"]


def test_restore_of_a_fact_without_ids(spark, workdir):
    import datetime as dt

    from starload.sources import backup

    rows = [("Ana", "2024-01-02 00:00:00", 1, 1), ("Ana", "2024-01-01 00:00:00", 1, 2), ("Eva", "2024-01-01 00:00:00", 2, 1)]
    facts = spark.createDataFrame(rows, "name string, datetime string, department_id int, job_id int").selectExpr("name", "cast(datetime AS timestamp_ntz) AS datetime", "department_id", "job_id")
    backup.take_snapshot(facts, workdir, "hired_employees", as_of=dt.datetime(2024, 1, 1))
    target = f"{workdir}/target/hired_employees"
    assert backup.restore(spark, workdir, "hired_employees", target) == 3
    got = spark.read.parquet(target)
    assert got.columns == list(specs.HIRED_EMPLOYEES.columns) and got.schema["id"].dataType.simpleString() == "int"
    assert sorted((r.id, r.name, r.job_id) for r in got.collect()) == [(1, "Ana", 2), (2, "Ana", 1), (3, "Eva", 1)]
    assert backup.restore(spark, workdir, "hired_employees", target) == 3  # ids of the replaced table are not used again
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [4, 5, 6]
