import csv as pycsv
import io
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starload import specs
from starload.sources import csv
from starload.sources.csv_records import Records, inside_after


@pytest.fixture()
def small_splits(spark):
    """Splits of a few bytes, so that cells, quotes and line ends of small files lie on their edges."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}

    def cut(size):
        for k, v in zip(keys, (str(size), "1", "1"), strict=True):
            spark.conf.set(k, v)

    yield cut
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _quoted(rows, seed):
    rng = random.Random(seed)
    out = io.StringIO()
    write = pycsv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([pycsv.QUOTE_MINIMAL, pycsv.QUOTE_ALL]))
    write.writerows(rows)
    return out.getvalue()


def _cells(rng):
    return "".join(rng.choice(['"', ",", "\n", "\r\n", "a", "bc", " ", "é", '""', ',"', '",']) for _ in range(rng.randrange(9)))


@pytest.mark.parametrize("size", [37, 150])
def test_records_of_small_splits_equal_a_plain_reader(spark, workdir, small_splits, size):
    small_splits(size)
    rng, want = random.Random(size), []
    for f in range(3):
        rows = [(f"{f}-{k}", _cells(rng) + rng.choice(["", "", "", "z" * 40 + "\n\n" + "y" * 30])) for k in range(30)]
        Path(workdir, f"f{f}.csv").write_text(_quoted(rows, f), newline="")
        want += [(i, t) for i, t in rows]
    df = csv.read_raw(spark, workdir, specs.DEPARTMENTS, header=False, multiline=True)
    got = df.collect()
    assert sorted((r.id, r.name or "") for r in got) == sorted(want)  # an unquoted empty cell is null
    for f in range(3):  # block and row give the order within a file
        mine = sorted((r for r in got if r.id.startswith(f"{f}-")), key=lambda r: (r._block, r._row))
        assert [r.id for r in mine] == [f"{f}-{k}" for k in range(30)]


def test_one_file_is_read_by_many_tasks(spark, workdir, small_splits):
    small_splits(3000)
    Path(workdir, "one.csv").write_text("".join(f'{k},"line one of {k}\nline ""two""\n"\n' for k in range(2000)))
    records = Records(spark, csv.list_files(spark, workdir))
    assert records.splits.count() > 20 and records.frame().select("block").distinct().count() > 20
    assert records.crossed.count() > 0
    got = csv.read_raw(spark, workdir, specs.DEPARTMENTS, header=False, multiline=True).select("id", "name").collect()
    assert sorted(map(tuple, got)) == sorted((str(k), f'line one of {k}\nline "two"\n') for k in range(2000))
    one_task = spark.read.options(**csv._CSV_OPTIONS, multiLine="true").schema("id string, name string").csv(workdir)
    assert one_task.rdd.getNumPartitions() == 1
    assert csv.read_raw(spark, workdir, specs.DEPARTMENTS, header=False, multiline=True).select("id", "name").exceptAll(one_task).count() == 0


def test_a_cell_longer_than_many_splits(spark, workdir, small_splits):
    small_splits(60)
    long = "\n".join(f"line {k}" for k in range(120))
    Path(workdir, "a.csv").write_text(f'1,"{long}"\n2,b\n3,"open at the end\nof the file')
    Path(workdir, "b.csv").write_text('4,"x\n"')
    got = csv.read_raw(spark, workdir, specs.DEPARTMENTS, header=False, multiline=True).select("id", "name").collect()
    assert {r.id: r.name for r in got if r.id != "3"} == {"1": long, "2": "b", "4": "x\n"}
    assert [r.name for r in got if r.id == "3"][0].lstrip('"') == "open at the end\nof the file"


def test_headers_blank_lines_and_bare_quotes(spark, workdir, small_splits):
    small_splits(16)
    Path(workdir, "a.csv").write_text('\n\nname,"note",id\n"Ana\nGil",x,1\n\nB "the" C,"y\n\n",2\n')
    Path(workdir, "b.csv").write_text('3,5" pipe\n4,"q"\n')
    Path(workdir, "c.csv").write_text("\r\n\r\n")
    Path(workdir, "d.csv").write_text("")
    Path(workdir, "e.csv").write_text("id,name\r\n9,nine\r\n")
    got = csv.read_raw(spark, workdir, specs.DEPARTMENTS, multiline=True).select("id", "name").collect()
    assert sorted(map(tuple, got)) == [("1", "Ana\nGil"), ("2", 'B "the" C'), ("3", '5" pipe'), ("4", "q"), ("9", "nine")]
    empty = Path(workdir, "none")
    empty.mkdir()
    (empty / "x.csv").write_text("")
    assert csv.read_raw(spark, str(empty), specs.DEPARTMENTS, multiline=True).count() == 0


def test_states_of_a_line():
    for line, inside, after in [
        ("a,b", False, False), ('"a', False, True), ('a,"b', False, True), ('a,b"', False, False), ('"a""', False, True), ('"a"', False, False), ('x', True, True),
        ('x"', True, False), ('x","y', True, True), ('x"",y', True, True), ('x",y"z', True, False), ('"', True, False), ('""', True, True), ('', True, True), ('"""', False, True),
    ]:
        assert inside_after(line, inside) is after, (line, inside)


def test_rows_do_not_depend_on_the_plan(spark, workdir, small_splits):
    small_splits(70)
    Path(workdir, "a.csv").write_text("".join(f'{k},"a\n{k}"\n' for k in range(150)))
    df = csv.read_raw(spark, workdir, specs.DEPARTMENTS, header=False, multiline=True)
    assert df.where(F.col("id") == "77").select("name").collect()[0][0] == "a\n77"
    assert df.select("name").count() == df.select("id").distinct().count() == 150
