"""Queries of the operators on token ids: counts after edits (2), packing (3), token files (8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import table
from starload.llm.packing import pack
from starload.llm.registry import query
from starload.llm.token_counts import edited_counts
from starload.llm.token_file import read_tokens, write_tokens
from starload.session import scratch_path


def derived_edits() -> F.Column:
    """Three edits of each text that follow from its own length and words: a line of the source's name comes in near the
    front, twelve characters go near the middle, and a word of the text is said again near the end."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    word = F.coalesce(F.split("text", " ", 2)[0], F.lit(""))
    edit = lambda at, gone, new: F.struct(at.cast("long").alias("position"), F.lit(gone).cast("long").alias("removed"), new.alias("inserted"))
    return F.array(
        edit(n / 7, 0, F.concat(F.lit("\n"), F.coalesce("source", F.lit("?")), F.lit("'s copy\n"))),
        edit(n / 2, 12, F.lit("")),
        edit(n * 6 / 7, 3, F.concat(F.lit(" "), word)),
    )


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edited_counts(docs.withColumn("edits", derived_edits()))


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op8_token_file")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "token-images")
    write_tokens(docs, path)
    return read_tokens(spark, path)
