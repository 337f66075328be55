import datetime as dt

from pyspark.sql import functions as F

from starload.operators import metrics

FACTS = [
    (1, 1, 1, dt.datetime(2021, 1, 10)),
    (2, 1, 1, dt.datetime(2021, 3, 31)),
    (3, 1, 1, dt.datetime(2021, 12, 31)),
    (4, 2, 1, dt.datetime(2021, 7, 1)),
    (5, 1, 2, dt.datetime(2022, 5, 5)),
]


def _frames(spark, legal_name="Legal"):
    fact = spark.createDataFrame(FACTS, "id int, department_id int, job_id int, datetime timestamp_ntz")
    deps = spark.createDataFrame([(1, "Sales"), (2, legal_name), (3, "Empty")], "id int, name string")
    jobs = spark.createDataFrame([(1, "Clerk"), (2, "Lead")], "id int, name string")
    return fact, deps, jobs


def _pivot(fact, deps, jobs, year=None):
    return metrics.quarterly_pivot(
        fact, deps, jobs, ts="datetime", fk1="department_id", fk2="job_id",
        dim1_key="id", dim1_name="name", dim2_key="id", dim2_name="name", year=year,
    )


def test_quarterly_pivot_golden(spark):
    rows = [tuple(r) for r in _pivot(*_frames(spark)).collect()]
    assert rows == [
        (2022, "Sales", "Lead", 0, 1, 0, 0),
        (2021, "Legal", "Clerk", 0, 0, 1, 0),
        (2021, "Sales", "Clerk", 2, 0, 0, 1),
    ]


def test_pivot_groups_by_name(spark):
    rows = [tuple(r) for r in _pivot(*_frames(spark, legal_name="Sales")).where("year = 2021").collect()]
    assert rows == [(2021, "Sales", "Clerk", 2, 0, 1, 1)]


def test_pivot_holds_no_counts_by_pairs_of_keys(spark):
    plan = _pivot(*_frames(spark))._jdf.queryExecution().executedPlan().toString()
    aggregates = [x for x in plan.splitlines() if "HashAggregate(keys=" in x]
    assert len(aggregates) == 2 and not any("_k1" in x or "_k2" in x for x in aggregates), plan


def test_pivot_odd_rows(spark):
    """Null keys, times and names, keys and names that come twice on either side, facts without a dimension row."""
    fact = [
        (i, d, j, t)
        for i, (d, j, t) in enumerate(
            (d, j, t)
            for d in (1, 1, 2, 3, 9, None)
            for j in (1, 2, 2, 9, None)
            for t in (None, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2021, 4, 1), dt.datetime(2021, 6, 30, 23, 59, 59))
        )
    ]
    deps, jobs = [(1, "Sales"), (1, "Sales"), (2, None), (3, "Sales"), (None, "None")], [(1, "Clerk"), (2, "Lead"), (2, None), (None, "None")]
    counts = {}
    for _, d, j, t in fact:
        for n1 in (n for k, n in deps if t and k is not None and k == d):
            for n2 in (n for k, n in jobs if k is not None and k == j):
                counts.setdefault((t.year, n1, n2), [0] * 4)[(t.month - 1) // 3] += 1
    for kind in ("timestamp_ntz", "timestamp"):
        out = _pivot(
            spark.createDataFrame(fact, f"id int, department_id int, job_id int, datetime {kind}"),
            spark.createDataFrame(deps, "id int, name string"),
            spark.createDataFrame(jobs, "id int, name string"),
        )
        assert dict(out.dtypes) == {"year": "int", "department": "string", "job": "string"} | {f"q{q}": "bigint" for q in (1, 2, 3, 4)}
        rows = out.collect()
        assert len(rows) == len(counts) and {tuple(r[:3]): [*r[3:]] for r in rows} == counts


def test_pivot_splits_a_hot_key(spark):
    """Where no dimension is broadcast, the facts of one key are dealt to several tasks of either join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    was = {k: spark.conf.get(k, None) for k in conf}
    hot = "CAST(IF(id % 5 < 4, 7, id % 1000) AS int)"
    fact = spark.range(0, 200_000, 1, 16).selectExpr(
        f"{hot} AS department_id", f"{hot} AS job_id", "timestamp_ntz'2021-01-01' + make_dt_interval(CAST(id % 365 AS int)) AS datetime"
    )
    dim = spark.range(1000).selectExpr("CAST(id AS int) AS id", "CAST(id % 10 AS string) AS name")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = _pivot(fact, dim, dim)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("SortMergeJoin(skew=true)") == 2, plan
    assert {r.department for r in rows} == {"4", "7", "9"} and sum(sum(r[3:]) for r in rows) == 200_000


def test_pivot_year_filter_and_quarter_sum_law(spark):
    fact, deps, jobs = _frames(spark)
    assert [r.year for r in _pivot(fact, deps, jobs, year=2022).collect()] == [2022]
    out = _pivot(fact, deps, jobs).agg(F.sum(F.col("q1") + F.col("q2") + F.col("q3") + F.col("q4"))).first()[0]
    assert out == fact.count()


def test_above_average_golden(spark):
    fact, deps, _ = _frames(spark)
    out = metrics.above_average(
        fact, deps, ts="datetime", fk="department_id", fact_id="id", dim_key="id", dim_name="name"
    )
    assert [tuple(r) for r in out.collect()] == [(2021, 1, "Sales", 3, 2.0)]


def test_above_average_include_zero(spark):
    fact, deps, _ = _frames(spark)
    out = metrics.above_average(
        fact, deps, ts="datetime", fk="department_id", fact_id="id", dim_key="id", dim_name="name", include_zero=True
    )
    # 2021 mean over three departments is 4/3; 2022 mean 1/3, so Sales is above both
    assert sorted((r.year, r.id) for r in out.collect()) == [(2021, 1), (2022, 1)]


def test_year_filter_reaches_scan(spark):
    from starload.plans.metric_plans import quarterly_pivot_year

    plan = quarterly_pivot_year(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
