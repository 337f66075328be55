"""A corpus pipeline of the training-data operators: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes what the one before it kept and returns the columns of ``documents``, the last one the packed pieces.
``run`` writes each stage to the shared folder, so that a lost executor costs one stage's tasks and not the whole run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import staged, table
from starload.llm.decontamination import without_leaks
from starload.llm.near_dup import one_of_each
from starload.llm.packing import pack
from starload.llm.quality import fit, good_documents
from starload.llm.substring_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones of its own input, held-out fold aside.

    Documents on which it has no evidence (no usable labels, no neighbour that votes) stay."""
    return good_documents(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of a similarity of 0.8 or more on five-word shingles."""
    return one_of_each(docs, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows of 35 words that start elsewhere too; ``n_chars`` follows the text."""
    cut = remove_repeats(docs, carry=True)
    columns = {"text": F.col("kept_text")} | {c: F.col("document").getField(c) for c in docs.columns if c != "text"}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    if docs.schema["text"].nullable:  # a null text stays null
        columns["text"] = F.when(F.col("text_hash") == F.xxhash64(F.lit(None).cast("string")), F.lit(None)).otherwise(columns["text"])
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 ids."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packing),
]

#: SQL can't express the latent-semantic vectors nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
