"""L7 by delta: a dimension is replaced, and of the fact table only the files that hold a lost key are written again.

1. Lost keys are the old dimension's keys that the new one has not: a difference of two dimensions, no look at the fact.
2. One pass over the foreign-key columns alone finds the files (``_metadata.file_path``) that hold a lost key. Up to
   ``PUSHED_KEYS`` lost keys go down as values, so row groups whose statistics exclude them are skipped.
3. The rows of those files that keep all their keys are written to a folder beside the data that readers don't see.
4. A journal names what comes and what goes. From then on the change is made whole by anyone: ``finish`` deletes and moves
   what the journal names and may be run again. Old files go before new ones come, so a reader in between may miss
   rows of the files at hand, but sees no row twice and none without its dimension.

Equal to ``cascade_keep`` on a table whose keys were all there before; rows with a null key stay. File names travel through
the driver, rows don't. The table's files lie in one folder. One cascade at a time runs on a table: an unfinished one is finished first.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import create_new, delete_path, list_dirs, list_files, read_text, rename_path

#: So many lost keys are compared as values in the scan; more are joined.
PUSHED_KEYS = 1000


@dataclass(frozen=True)
class Cascade:
    files_touched: int
    files_kept: int


def lost_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys (first columns) of the old dimension that the new one has not."""
    a, b = (d.select(F.col(d.columns[0]).alias("_lost")) for d in (old, new))
    return a.where("_lost is not null").distinct().join(b, "_lost", "left_anti")


def _holding(fact: DataFrame, fk: str, lost: DataFrame) -> DataFrame:
    """Rows of ``fact`` whose key is lost."""
    few = lost.limit(PUSHED_KEYS + 1).collect()
    if len(few) <= PUSHED_KEYS:
        return fact.where(F.col(fk).isin([r[0] for r in few])) if few else fact.where(F.lit(False))
    return fact.join(lost, fact[fk] == lost["_lost"], "left_semi")


def cascade_replace(spark: SparkSession, fact_path: str, dims: dict[str, tuple[DataFrame, DataFrame]]) -> Cascade:
    """Takes the rows out of the Parquet table whose keys ``dims`` lose: foreign key -> (old dimension, new dimension)."""
    finish(spark, fact_path)
    fact = spark.read.parquet(fact_path)
    files = fact.inputFiles()
    lost = {fk: lost_keys(old, new) for fk, (old, new) in dims.items()}
    held = None
    for fk, keys in lost.items():
        named = _holding(fact.select(fk, F.col("_metadata.file_path").alias("_file")), fk, keys).select("_file")
        held = named if held is None else held.unionByName(named)
    touched = [] if held is None else sorted(r._file.rpartition("/")[2] for r in held.distinct().collect())
    if not touched:
        return Cascade(0, len(files))
    kept = spark.read.schema(fact.schema).parquet(*[f"{fact_path}/{t}" for t in touched])
    for fk, keys in lost.items():
        kept = kept.join(keys, kept[fk] == keys["_lost"], "left_anti")
    name = uuid.uuid4().hex
    coming = f"{fact_path}/_cascade-{name}"
    kept.write.parquet(coming)
    journal = f"{fact_path}/_journal-{name}"
    create_new(spark, f"{fact_path}/_draft-{name}", json.dumps({"out": touched, "in": coming.rpartition("/")[2]}))
    if not rename_path(spark, f"{fact_path}/_draft-{name}", journal):
        raise OSError(f"could not write {journal}")
    finish(spark, fact_path)
    return Cascade(len(touched), len(files) - len(touched))


def finish(spark: SparkSession, fact_path: str) -> bool:
    """Makes an unfinished cascade whole; true if there was one. Each step may have been done before."""
    journals = [n for n in list_files(spark, fact_path, hidden=True) if n.startswith("_journal-")]
    for journal in journals:
        change = json.loads(read_text(spark, f"{fact_path}/{journal}"))
        for old in change["out"]:
            delete_path(spark, f"{fact_path}/{old}")
        folder = f"{fact_path}/{change['in']}"
        for part in list_files(spark, folder):
            if not rename_path(spark, f"{folder}/{part}", f"{fact_path}/{part}"):
                raise OSError(f"could not move {part} into {fact_path}")
        delete_path(spark, folder)
        delete_path(spark, f"{fact_path}/{journal}")
    for draft in [n for n in list_files(spark, fact_path, hidden=True) if n.startswith("_draft-")]:
        delete_path(spark, f"{fact_path}/{draft}")  # never became a journal: nothing has happened
    for folder in [n for n in list_dirs(spark, fact_path) if n.startswith("_cascade-")]:
        delete_path(spark, f"{fact_path}/{folder}")
    spark.catalog.refreshByPath(fact_path)
    return bool(journals)
