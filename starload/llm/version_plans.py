"""Document fingerprints (12) as a query. SQL can't express the peeling; tests hold it against sets of paragraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm.common import table
from starload.llm.fingerprint import edit_fingerprints
from starload.llm.registry import query


@query("op12_fingerprint")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))
