"""The two metrics: hires per quarter by dimension names, and groups above their yearly mean.

Both are declared with the DataFrame API and planned by Catalyst. Four user-level rewrites keep
the plan cheap at scale:

* the optional year is a half-open range on the raw timestamp, so it reaches the Parquet scan;
* the pivot's facts meet the dimensions as (key, key, quarter) and are counted once, by year and
  names: pairs of keys hardly repeat, so counts by them would take memory and merge nothing. Small
  dimensions are broadcast and hot names combined by the scan; a hot key in a shuffle join is split
  by AQE;
* above average, the fact is pre-aggregated by its one foreign key before it meets the dimension, so
  the join sees one row per (key, year) instead of one per fact row;
* the per-year mean is a tiny aggregate joined back on ``year`` instead of a second scan of the
  fact; AQE broadcasts it after measuring it, and splits a skewed year otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.parse import year_range


def _year_filter(fact: DataFrame, ts: str, year: int | None) -> DataFrame:
    if year is None:
        return fact
    return fact.where(year_range(ts, int(year), fact.schema[ts].dataType))


def quarterly_pivot(
    fact: DataFrame,
    dim1: DataFrame,
    dim2: DataFrame,
    *,
    ts: str,
    fk1: str,
    fk2: str,
    dim1_key: str,
    dim1_name: str,
    dim2_key: str,
    dim2_name: str,
    year: int | None = None,
    names: tuple[str, str] = ("department", "job"),
    ordered: bool = True,
) -> DataFrame:
    """Year, dimension names and fact counts per quarter (q1..q4), optional year filter.

    Inner joins: facts without a matching dimension row drop out. Groups are by *names*, so two
    dimension rows sharing a name fall into one group. The first dimension is joined last, so that
    after a shuffle join the tasks hold few of its names each: let it be the one with more names.
    """
    f = _year_filter(fact.select(fk1, fk2, ts), ts, year).where(F.col(ts).isNotNull())
    f = f.select(F.col(fk1).alias("_k1"), F.col(fk2).alias("_k2"), F.trunc(ts, "quarter").alias("_from"))
    d1 = dim1.select(F.col(dim1_key).alias("_k1"), F.col(dim1_name).alias(names[0]))
    d2 = dim2.select(F.col(dim2_key).alias("_k2"), F.col(dim2_name).alias(names[1]))
    joined = f.join(d2, "_k2").join(d1, "_k1")
    quarter = F.quarter("_from")
    out = joined.groupBy(F.year("_from").alias("year"), names[0], names[1]).agg(
        *[F.count_if(quarter == q).alias(f"q{q}") for q in (1, 2, 3, 4)]
    )
    if ordered:
        out = out.orderBy(F.desc("year"), F.asc(names[0]), F.asc(names[1]))
    return out


def above_average(
    fact: DataFrame,
    dim: DataFrame,
    *,
    ts: str,
    fk: str,
    fact_id: str,
    dim_key: str,
    dim_name: str,
    year: int | None = None,
    name: str = "department",
    include_zero: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Per year, the dimension rows whose fact count is strictly above that year's mean.

    The mean is over dimension rows with at least one fact that year (a row with none has no
    year and never meets the mean). ``include_zero=True`` divides by all dimension rows instead.
    Counting ``fact_id`` skips facts whose id is null.
    """
    f = _year_filter(fact.select(fk, ts, fact_id), ts, year).where(F.col(ts).isNotNull())
    per_key = f.groupBy(F.col(fk).alias("id"), F.year(ts).alias("year")).agg(F.count(fact_id).alias("hired"))
    d = dim.select(F.col(dim_key).alias("id"), F.col(dim_name).alias(name))
    yearly = per_key.join(d, "id")
    if include_zero:
        n_dim = d.select(F.count(F.lit(1))).scalar()
        avgs = yearly.groupBy("year").agg((F.sum("hired") / n_dim).alias("avg_hires"))
    else:
        avgs = yearly.groupBy("year").agg(F.avg("hired").alias("avg_hires"))
    out = yearly.join(avgs, "year").where(F.col("hired") > F.col("avg_hires"))
    out = out.select("year", "id", name, "hired", "avg_hires")
    if ordered:
        out = out.orderBy(F.desc("year"), F.desc("hired"), F.asc("id"))
    return out


def star_join(
    fact: DataFrame,
    dim1: DataFrame,
    dim2: DataFrame,
    *,
    fk1: str,
    fk2: str,
    dim1_key: str,
    dim2_key: str,
    dim1_cols: dict[str, str],
    dim2_cols: dict[str, str],
) -> DataFrame:
    """Fact rows with the named columns of both dimensions (inner equi-joins)."""
    d1 = dim1.select(F.col(dim1_key).alias(fk1), *[F.col(k).alias(v) for k, v in dim1_cols.items()])
    d2 = dim2.select(F.col(dim2_key).alias(fk2), *[F.col(k).alias(v) for k, v in dim2_cols.items()])
    return fact.join(d1, fk1).join(d2, fk2)


def left_join_on_filter(
    dim: DataFrame,
    fact: DataFrame,
    *,
    dim_key: str,
    fk: str,
    ts: str,
    year: int | None = None,
) -> DataFrame:
    """Every dimension row, joined to its facts of ``year`` (predicate in the ON clause).

    A left join cannot split a hot key on its right side, which is the fact's. So the matches are an
    inner join, whose fact side can be split, and the dimension rows without one come from an
    anti-join with the fact's distinct keys, pre-aggregated.
    """
    f = _year_filter(fact, ts, year)
    matched = dim.join(f, F.col(dim_key) == F.col(fk))
    keys = f.select(F.col(fk).alias("_fk")).distinct()
    alone = dim.join(keys, F.col(dim_key) == F.col("_fk"), "left_anti")
    nulls = [F.lit(None).cast(c.dataType).alias(c.name) for c in fact.schema.fields]
    return matched.unionByName(alone.select("*", *nulls))


def metric_envelope(result: DataFrame, filtered_year: int | str | None = None) -> DataFrame:
    """The reply envelope ``{filtered_year, data, total_records}`` in streamable form.

    One output row per result row: the row as JSON text next to the envelope fields. The total is
    a scalar subquery, so nothing is gathered into one task and the result may be any size.
    """
    total = result.select(F.count(F.lit(1))).scalar()
    year = F.lit(None if filtered_year is None else str(filtered_year)).cast("string")
    return result.select(
        year.alias("filtered_year"),
        F.to_json(F.struct(*result.columns), {"ignoreNullFields": "false"}).alias("data"),
        total.alias("total_records"),
    )
