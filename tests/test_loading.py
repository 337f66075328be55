import datetime as dt

import pytest
from pyspark.sql import functions as F

from starload.operators import loading
from starload.sources import backup


def test_positions_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    pos = loading.positions(df, ["k"], n_partitions=7)
    rows = pos.select("k", "_position").collect()
    assert sorted(r._position for r in rows) == list(range(5000))
    assert all(r.k == r._position for r in rows)


def test_assign_ids_after_max(spark):
    df = spark.createDataFrame([(1, None), (2, 50), (3, None), (4, None)], "_offset long, id long")
    stored = spark.createDataFrame([(10,), (40,)], "id long")
    out = {r._offset: r.id for r in loading.assign_ids(df, order=["_offset"], stored_ids=stored).collect()}
    assert out == {1: 51, 2: 50, 3: 52, 4: 53}


def test_assign_batches(spark):
    df = spark.range(0, 2500).withColumnRenamed("id", "k")
    out = loading.assign_batches(df, order=["k"], batch_size=1000)
    counts = {r.batch_no: r["count"] for r in out.groupBy("batch_no").count().collect()}
    assert counts == {1: 1000, 2: 1000, 3: 500}


def test_orphans_and_cascade(spark):
    fact = spark.createDataFrame([(1, 1, 1), (2, 1, 9), (3, 9, 1), (4, 9, 9)], "id int, department_id int, job_id int")
    deps = spark.createDataFrame([(1,)], "id int")
    jobs = spark.createDataFrame([(1,)], "id int")
    refs = {"department_id": deps, "job_id": jobs}
    orph = {r.id: r.orphan_column for r in loading.orphans(fact, refs).collect()}
    assert orph == {2: "job_id", 3: "department_id", 4: "department_id"}
    assert [r.id for r in loading.cascade_keep(fact, refs).collect()] == [1]


def test_staged_overwrite_replaces(spark, workdir):
    path = f"{workdir}/t"
    assert loading.staged_overwrite(spark.range(3), path) == 3
    assert loading.staged_overwrite(spark.range(5), path) == 5
    assert spark.read.parquet(path).count() == 5


def test_backup_roundtrip_latest_and_empty(spark, workdir):
    src = spark.range(0, 2500).withColumn("name", F.lit("Ana"))
    b = f"{workdir}/backups"
    backup.take_snapshot(src, b, "jobs", as_of=dt.datetime(2024, 1, 1), part_rows=1000)
    backup.take_snapshot(src.limit(10), b, "jobs", as_of=dt.datetime(2024, 2, 1), part_rows=1000)
    assert backup.latest_snapshot(spark, b, "jobs").endswith("ts=20240201T000000")
    target = f"{workdir}/jobs"
    assert backup.restore(spark, b, "jobs", target) == 10
    first = backup.snapshot_path(b, "jobs", "20240101T000000")
    assert backup.restore(spark, b, "jobs", target, backup_path=first) == 2500
    restored = spark.read.parquet(target)
    assert restored.exceptAll(src).count() == 0 and src.exceptAll(restored).count() == 0
    # an empty table still gives a readable snapshot
    backup.take_snapshot(src.limit(0), b, "departments", as_of=dt.datetime(2024, 3, 1))
    assert backup.restore(spark, b, "departments", f"{workdir}/departments") == 0


def test_restore_bad_path_leaves_target(spark, workdir):
    target = f"{workdir}/hired"
    loading.staged_overwrite(spark.range(4), target)
    with pytest.raises(FileNotFoundError):
        backup.restore(spark, f"{workdir}/none", "hired_employees", target)
    with pytest.raises(ValueError):
        backup.restore(spark, f"{workdir}/none", "other_table", target)
    assert spark.read.parquet(target).count() == 4


def test_full_load_dims_first(spark):
    from starload.plans.load_plans import full_load

    rows = {r.table: r for r in full_load(spark, "/root/testdata/sf0.001").collect()}
    assert [rows[t].status for t in ("departments", "jobs", "hired_employees")] == ["success"] * 3
    assert rows["hired_employees"].rows_loaded > 0 and rows["hired_employees"].rows_rejected > 0


def test_positions_of_a_wide_frame_are_dense(spark, workdir):
    """A million rows with more columns than the order's, written and read back, with exchange reuse on and off."""
    n = 1_000_000
    wide = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.col("id").cast("string").alias("name"), (F.col("id") % 13).alias("x"))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            loading.positions(wide, ["k"]).write.parquet(f"{workdir}/p-{reuse}")
            ids = wide.withColumn("id", F.when(F.col("x") == 0, F.col("k")))
            loading.assign_ids(ids, order=["k"]).write.parquet(f"{workdir}/i-{reuse}")
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        r = spark.read.parquet(f"{workdir}/p-{reuse}").agg(F.count_distinct("_position").alias("d"), F.sum((F.col("_position") != F.col("k")).cast("int")).alias("off"))
        assert tuple(r.first()) == (n, 0)
        new = spark.read.parquet(f"{workdir}/i-{reuse}").where("x <> 0").agg(F.count_distinct("id").alias("d"), F.min("id"), F.max("id"), F.count("*").alias("n")).first()
        assert new.d == new.n and new[2] - new[1] + 1 == new.n


def test_one_pass_tells_kept_rows_from_orphans(spark):
    fact = spark.createDataFrame([(1, 1, 1), (2, 9, 1), (3, 1, 9), (4, None, 9)], "id int, d int, j int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    marked = loading.mark_orphans(fact, {"d": keys, "j": keys})
    assert sorted((r.id, r.orphan_column) for r in marked.collect()) == [(1, None), (2, "d"), (3, "j"), (4, "d")]
    assert [r.id for r in loading.cascade_keep(fact, {"d": keys, "j": keys}).collect()] == [1]
