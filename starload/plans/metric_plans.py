"""Metric queries on the star analogue: lineitem (fact) × supplier (unique names) × part
(``p_brand`` repeats, so grouping by name really merges ids)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.operators import metrics
from starload.plans.registry import register
from starload.plans.tables import table

YEAR = 1998

def _in_year(year: int | None) -> str:
    return "l_shipdate IS NOT NULL" if year is None else f"l_shipdate >= DATE '{year}-01-01' AND l_shipdate < DATE '{year + 1}-01-01'"


def _pivot_sql(year: int | None) -> str:
    """Counts per quarter as filtered counts over one star join."""
    quarters = ", ".join(f"count(*) FILTER (quarter(l_shipdate) = {q}) AS q{q}" for q in (1, 2, 3, 4))
    return f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, s_name AS department, p_brand AS job, {quarters}
FROM lineitem, supplier, part
WHERE l_suppkey = s_suppkey AND l_partkey = p_partkey AND {_in_year(year)}
GROUP BY ALL"""


def _above_sql(year: int | None) -> str:
    """Yearly counts of the suppliers that have any, held against their mean by a window."""
    return f"""SELECT year, id, department, hired, avg_hires FROM (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, s_suppkey AS id, s_name AS department, count(l_orderkey) AS hired,
         avg(count(l_orderkey)) OVER (PARTITION BY year(l_shipdate)) AS avg_hires
  FROM lineitem, supplier
  WHERE l_suppkey = s_suppkey AND {_in_year(year)}
  GROUP BY year(l_shipdate), s_suppkey, s_name)
WHERE hired > avg_hires"""


def _pivot(spark: SparkSession, sf_dir: str, year: int | None) -> DataFrame:
    return metrics.quarterly_pivot(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "supplier"),
        table(spark, sf_dir, "part"),
        ts="l_shipdate", fk1="l_suppkey", fk2="l_partkey",
        dim1_key="s_suppkey", dim1_name="s_name", dim2_key="p_partkey", dim2_name="p_brand",
        year=year,
    )


def _above(spark: SparkSession, sf_dir: str, year: int | None) -> DataFrame:
    return metrics.above_average(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "supplier"),
        ts="l_shipdate", fk="l_suppkey", fact_id="l_orderkey",
        dim_key="s_suppkey", dim_name="s_name", year=year,
    )


@register("quarterly_pivot", oracle=_pivot_sql(None), ids=("M1", "A1", "A2", "E1", "E2", "O1"))
def quarterly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir, None)


@register(
    "quarterly_pivot_year",
    oracle=_pivot_sql(YEAR),
    ids=("M1", "F10"),
)
def quarterly_pivot_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir, YEAR)


@register("above_average", oracle=_above_sql(None), ids=("M2", "J3", "A3", "A4", "A5", "O2"))
def above_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _above(spark, sf_dir, None)


@register(
    "above_average_year",
    oracle=_above_sql(YEAR),
    ids=("M2", "F10"),
)
def above_average_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _above(spark, sf_dir, YEAR)


@register(
    "star_join",
    oracle="""
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, l.l_shipdate,
       s.s_name AS department, p.p_brand AS job
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
""",
    ids=("J1",),
)
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    out = metrics.star_join(
        fact, table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part"),
        fk1="l_suppkey", fk2="l_partkey", dim1_key="s_suppkey", dim2_key="p_partkey",
        dim1_cols={"s_name": "department"}, dim2_cols={"p_brand": "job"},
    )
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "department", "job")


@register(
    "left_join_on_filter",
    oracle=f"""
SELECT s.s_suppkey, s.s_name, l.l_orderkey, l.l_linenumber, l.l_shipdate
FROM supplier s
LEFT JOIN lineitem l ON s.s_suppkey = l.l_suppkey AND EXTRACT(YEAR FROM l.l_shipdate) = {YEAR}
""",
    ids=("J2",),
)
def left_join_on_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    dim = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    out = metrics.left_join_on_filter(dim, fact, dim_key="s_suppkey", fk="l_suppkey", ts="l_shipdate", year=YEAR)
    return out.select("s_suppkey", "s_name", "l_orderkey", "l_linenumber", "l_shipdate")


_ENVELOPE_SQL = (
    "WITH r AS ("
    + _above_sql(YEAR)
    + f""")
SELECT '{YEAR}' AS filtered_year,
       to_json({{'year': year, 'id': id, 'department': department, 'hired': hired, 'avg_hires': avg_hires}}) AS data,
       (SELECT COUNT(*) FROM r) AS total_records
FROM r"""
)


@register("metric_envelope", oracle=_ENVELOPE_SQL, ids=("S15", "A12"))
def metric_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metric_envelope(_above(spark, sf_dir, YEAR), filtered_year=YEAR)
