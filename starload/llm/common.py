"""Helpers that the training-data operators share: reading tables, staged writes, work columns."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import ensure_session_defaults, scratch_path

#: Rows of one Arrow batch that goes to a Python worker, so that long texts do not add up.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    ensure_session_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors.

    An aggregate that is joined back on its own key is staged too: joined in the aggregate's own stage, the other
    side's hot keys could not be split; as a table of its own, both sides are plain exchanges, which Spark splits.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``text_hash`` alone: clashing or extra columns of the input never get further.

    A row is known by (doc_id, text_hash): a null id, a repeated row and one id with two texts all stay apart
    from one another without a row number.
    """
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20, tokens: bool = False) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches of at most about ``most`` bytes of text (or one row), with the text column, null as empty.

    Workers are reused: a task that makes no ``tokens`` lets go of the unit caches that an earlier one has left.
    """
    if not tokens and (module := sys.modules.get("starload.llm.tokens")):
        module.encoder.cache_clear()
    for batch in batches:
        text = pc.fill_null(batch.column(column), "").cast(pa.large_string())
        sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(sizes):
            if i > start and size + n > most:
                yield batch.slice(start, i - start), text.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if start < len(sizes):
            yield batch.slice(start), text.slice(start)
