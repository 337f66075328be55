import pytest
from pyspark.sql import functions as F

from starload.operators import cascade, loading
from starload.session import list_dirs, list_files


@pytest.fixture()
def fact(spark, workdir):
    """Sixty rows in six files by department; two rows have no department."""
    path = f"{workdir}/fact"
    for part in range(6):
        rows = [(part * 10 + i, part if (part, i) not in ((2, 0), (5, 0)) else None, i) for i in range(10)]
        spark.createDataFrame(rows, "id int, department_id int, job_id int").coalesce(1).write.mode("append").parquet(path)
    return path


def _rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).collect())


def _dims(spark, gone):
    old = spark.range(10).select(F.col("id").cast("int").alias("id"))
    return old, old.where(~F.col("id").isin(gone))


def test_only_files_that_hold_a_lost_key_are_written_again(spark, fact):
    files, before = set(list_files(spark, fact)), _rows(spark, fact)
    done = cascade.cascade_replace(spark, fact, {"department_id": _dims(spark, [2, 8])})
    assert done == cascade.Cascade(1, 5)
    assert len(files & set(list_files(spark, fact))) == 5
    assert _rows(spark, fact) == [r for r in before if r[1] != 2]
    assert not [d for d in list_dirs(spark, fact)] and not [f for f in list_files(spark, fact, hidden=True) if f.startswith("_j")]


def test_equal_to_the_full_cascade_on_two_dimensions(spark, fact, workdir):
    deps, jobs = _dims(spark, [1]), _dims(spark, [3, 4])
    whole = spark.read.parquet(fact).where("department_id is not null")
    want = sorted(tuple(r) for r in loading.cascade_keep(whole, {"department_id": deps[1], "job_id": jobs[1]}).collect())
    cascade.cascade_replace(spark, fact, {"department_id": deps, "job_id": jobs})
    assert [r for r in _rows(spark, fact) if r[1] is not None] == want


def test_many_lost_keys_are_joined(spark, fact, monkeypatch):
    monkeypatch.setattr(cascade, "PUSHED_KEYS", 1)
    assert cascade.cascade_replace(spark, fact, {"department_id": _dims(spark, [0, 1, 2])}).files_touched == 3


def test_nothing_lost_touches_nothing(spark, fact):
    before = list_files(spark, fact)
    assert cascade.cascade_replace(spark, fact, {"department_id": _dims(spark, [])}) == cascade.Cascade(0, 6)
    assert list_files(spark, fact) == before


@pytest.mark.parametrize("step", range(4))
def test_a_cascade_cut_short_is_made_whole_by_the_next(spark, fact, monkeypatch, step):
    """The driver is lost after 0, 1, 2 … of the moves and deletions; no row comes twice, and the next run ends it."""
    before, calls = _rows(spark, fact), []

    def failing(real):
        def run(*args):
            calls.append(args)
            if len(calls) > step:
                raise OSError("lost")
            return real(*args)

        return run

    with monkeypatch.context() as m:
        m.setattr(cascade, "delete_path", failing(cascade.delete_path))
        m.setattr(cascade, "rename_path", failing(cascade.rename_path))
        with pytest.raises(OSError, match="lost"):
            cascade.cascade_replace(spark, fact, {"department_id": _dims(spark, [2, 3])})
    seen = [r[0] for r in _rows(spark, fact)]
    assert len(seen) == len(set(seen))
    cascade.cascade_replace(spark, fact, {"department_id": _dims(spark, [2, 3])})
    assert _rows(spark, fact) == [r for r in before if r[1] not in (2, 3)]
    assert not list_dirs(spark, fact)
