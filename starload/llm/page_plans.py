"""Queries over web pages: main text (5), URL filters (6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import table
from starload.llm.html_text import extract
from starload.llm.registry import query
from starload.llm.url_filter import judge, mine

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): a page shows the document that the last number of its path names; it is bad if that one is junk or toxic."""
    number = F.expr("try_cast(regexp_extract(url, '://[^?#]*/([0-9]+)[^/?#]*/?([?#]|$)', 1) as bigint)")
    known = labels.groupBy("doc_id").agg((F.min("quality") == 0).alias("junk"), (F.max("toxic") == 1).alias("toxic"))
    bad = F.coalesce(F.col("junk"), F.lit(False)) | F.coalesce(F.col("toxic"), F.lit(False))
    return pages.select("url", number.alias("number")).join(known, F.col("number") == F.col("doc_id")).select("url", bad.alias("bad"))


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages, RULES, mine(labelled_urls(pages, table(spark, sf_dir, "labels"))))
