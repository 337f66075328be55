import random

import pytest
from pyspark.sql import functions as F

from starload.operators import id_store
from starload.operators.id_store import IdStore
from starload.session import list_dirs


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def _found(df):
    return sorted(r.id for r in df.collect())


def _scanned(df):
    """Rows that the scans gave out, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        inner = leaf.plan().collectLeaves() if "QueryStage" in leaf.nodeName() else None
        for x in [inner.apply(j) for j in range(inner.size())] if inner is not None else [leaf]:
            total += x.metrics().apply("numOutputRows").value() if x.nodeName().startswith("Scan") else 0
    return total


@pytest.mark.parametrize("literals", [1000, 3])
def test_probe_add_and_compact(spark, workdir, literals, monkeypatch):
    monkeypatch.setattr(id_store, "LITERALS", literals)
    monkeypatch.setattr(id_store, "FAN", 3)
    rng, store, have = random.Random(2), IdStore(spark, f"{workdir}/s", 4), {}
    store.add(_ids(spark, [5, 6, None, 7]), id_store.GIVEN)
    have[-1] = {5, 6, 7}
    for b in range(11):
        store.compact(b)
        have[b] = set(rng.sample(range(200), 6))
        store.add(_ids(spark, [999]), b)
        store.add(_ids(spark, have[b]), b)  # a batch that is run again replaces its ids
        wanted = rng.sample(range(220), 20)
        stored = set().union(*(have[k] for k in have if k < b))
        assert _found(store.probe(_ids(spark, [*wanted, None]), before=b)) == sorted(stored & set(wanted))
    assert store.highest() == max(v for have_b in have.values() for v in have_b) and store.highest(before=10) == max(v for b in have if b < 10 for v in have[b])
    assert _found(store.all().distinct()) == sorted(set().union(*have.values()))
    runs = store.runs()
    assert [(r.first, r.last) for r in runs][:2] == [(-1, -1), (0, 8)] and store.recent() == [9, 10]
    assert len(list_dirs(spark, f"{workdir}/s/runs")) == len(runs) and len(list_dirs(spark, f"{workdir}/s/recent")) == 2
    with pytest.raises(ValueError, match="holds batch"):
        store.probe(_ids(spark, [1]), before=4)
    again = IdStore(spark.newSession(), f"{workdir}/s", 4)
    assert _found(again.probe(_ids(spark, [5, 1000]))) == [5]


def test_a_merge_broken_off_changes_nothing(spark, workdir, monkeypatch):
    monkeypatch.setattr(id_store, "FAN", 2)
    store = IdStore(spark, f"{workdir}/s", 2)
    for b in range(4):
        store.add(_ids(spark, [b, 10 + b]), b)
    store._merge([store._batch(0), store._batch(1)], 0, 1, 11)
    (spark.range(50, 60).write.parquet(f"{workdir}/s/runs/2_3_2_59"))
    import os

    os.remove(f"{workdir}/s/runs/2_3_2_59/_SUCCESS")  # written by half: does not count
    assert _found(store.all()) == [0, 1, 2, 3, 10, 11, 12, 13] and store.recent() == [2, 3]
    store.compact(4)
    assert _found(store.all()) == [0, 1, 2, 3, 10, 11, 12, 13] and [(r.first, r.last) for r in store.runs()] == [(0, 3)]


def test_few_ids_skip_row_groups_and_many_do_not_shuffle_what_is_stored(spark, workdir, monkeypatch):
    monkeypatch.setattr(id_store, "GROUP_BYTES", 32 * 1024)
    store = IdStore(spark, f"{workdir}/s", 8)
    store.add(spark.range(0, 400_000).select((F.col("id") * 7).alias("id")), id_store.GIVEN)
    store.compact(0)
    few = store.probe(_ids(spark, [7 * 1234, 7 * 300_000, 5, 2_800_000]))
    assert _found(few) == [7 * 1234, 7 * 300_000]
    assert 0 < _scanned(few) < 40_000  # of 400,000 rows
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = store.probe(spark.range(0, 70_000).select((F.col("id") * 3).alias("id")))
        plan = many._jdf.queryExecution().executedPlan().toString()
        stored = plan[plan.index("LeftSemi") :].split("\n")
        side = [line for line in stored[1 : next(k for k, x in enumerate(stored) if "FileScan" in x) + 1]]
        assert any("FileScan" in x and "starload_ids" in x for x in side) and not any("Exchange" in x for x in side)
        assert many.count() == len(set(range(0, 210_000, 3)) & set(range(0, 2_800_000, 7)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
