import pytest
from pyspark.sql import functions as F

from starload.operators import id_leases
from starload.operators.id_leases import IdLeases, assign_leased


def _rows(spark, n, given=()):
    return spark.createDataFrame([(i, None) for i in range(n)] + [(n + k, v) for k, v in enumerate(given)], "_offset long, id long")


def _ids(df):
    return {r._offset: r.id for r in df.collect()}


@pytest.fixture()
def leases(spark, workdir):
    out = IdLeases(spark, f"{workdir}/leases")
    out.begin(40, size=10)
    out.begin(9999, size=3)  # only the first call counts
    return out


def test_ids_go_on_after_what_was_stored_and_replays_repeat(spark, leases):
    first = _ids(assign_leased(_rows(spark, 25), leases, 0, order=["_offset"]))
    assert [first[i] for i in range(25)] == list(range(41, 66))
    second = _ids(assign_leased(_rows(spark, 3), leases, 1, order=["_offset"]))
    assert list(second.values()) == [71, 72, 73]
    assert _ids(assign_leased(_rows(spark, 25), leases, 0, order=["_offset"])) == first
    assert _ids(assign_leased(_rows(spark, 25).where(F.lit(False)), leases, 2, order=["_offset"])) == {}


def test_a_crash_before_the_record_leaves_a_gap_and_no_id_twice(spark, leases, monkeypatch):
    place = IdLeases._place
    monkeypatch.setattr(IdLeases, "_place", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        leases.lease(0, 12)
    monkeypatch.setattr(IdLeases, "_place", place)
    a = leases.lease(0, 12)
    assert a == [(61, 20)] and leases.lease(0, 12) == a == IdLeases(spark, leases.path).lease(0, 12)
    assert leases.lease(1, 1) == [(81, 10)]


def test_writers_with_an_old_listing_do_not_share_blocks(leases, monkeypatch):
    monkeypatch.setattr(IdLeases, "_next", lambda self: 0)
    runs = [leases.lease(b, 15) for b in range(3)]
    assert runs == [[(41, 20)], [(61, 20)], [(81, 20)]]
    leases._take(7)
    assert leases.lease(3, 15) == [(101, 10), (121, 10)]


def test_ids_over_several_runs(spark, leases):
    leases._take(1)
    leases._take(3)
    runs = IdLeases._next
    try:
        IdLeases._next = lambda self: 0
        got = _ids(assign_leased(_rows(spark, 25), leases, 0, order=["_offset"]))
    finally:
        IdLeases._next = runs
    assert [got[i] for i in range(25)] == [*range(41, 51), *range(61, 71), *range(81, 86)]


def test_ids_that_records_bring_are_passed_over(spark, leases):
    got = _ids(assign_leased(_rows(spark, 2, [55, 7]), leases, 0, order=["_offset"]))
    assert got == {0: 61, 1: 62, 2: 55, 3: 7}
    assert _ids(assign_leased(_rows(spark, 2, [55, 7]), leases, 0, order=["_offset"])) == got


def test_lease_lists_only_the_last_group(leases, monkeypatch):
    leases._take(3 * id_leases.GROUP + 5)
    listed = []
    files = id_leases.list_files
    monkeypatch.setattr(id_leases, "list_files", lambda spark, path: listed.append(path) or files(spark, path))
    assert leases.lease(0, 1) == [(41 + (3 * id_leases.GROUP + 6) * 10, 10)]
    assert len(listed) == 1
