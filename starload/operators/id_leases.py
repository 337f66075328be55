"""L4: durable ranges of ids. A batch leases blocks of ids before it uses them, so stored ids are never searched for their maximum.

Block ``b`` of a store with ``size`` ids a block covers ``first + b * size`` and the ``size - 1`` ids after it. A block is
taken by creating an empty file of its number, which fails if the file is there: the name says all, so there are no
half-written leases, and two writers never get the same block where the file system creates in one step (HDFS, stores with
conditional writes; a local disk, as in tests, looks first). A batch number belongs to one writer. Files lie in groups of a thousand; only the last group is
listed, so the cost of a lease does not grow with the leases before it.

What a batch has leased is written as one file (renamed into place when it is whole) before its ids are used:

* a replay of the batch finds that file and gives the same ids again;
* a batch that failed between its blocks and that file leases new ones: the ids of the old blocks are never used;
* the rest of a batch's last block is never used. Gaps are the price; order among batches is kept for one writer.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.loading import positions
from starload.session import create_new, list_dirs, list_files, path_exists, read_text, rename_path

GROUP = 1000
#: Leases of one call that other writers may get in the way of before it gives up.
TRIES = 1000


@dataclass(frozen=True)
class IdLeases:
    """``size`` is fixed by the first caller of ``begin``; later ones read it."""

    spark: SparkSession
    path: str

    def begin(self, highest: int = 0, size: int = 1000) -> None:
        """Ids go on after ``highest``. Only the first call of a store counts."""
        if size < 1:
            raise ValueError("size must be 1 or more")
        if not self.begun():
            self._place("begin", {"first": highest + 1, "size": size})

    def begun(self) -> bool:
        return path_exists(self.spark, f"{self.path}/begin")

    def _place(self, name: str, what: object) -> None:
        """Writes a whole file under ``name``, unless there is one."""
        folder, slash, _ = f"{self.path}/{name}".rpartition("/")
        new = f"{folder}{slash}_new-{uuid.uuid4().hex}"
        create_new(self.spark, new, json.dumps(what))
        if not path_exists(self.spark, f"{self.path}/{name}"):
            rename_path(self.spark, new, f"{self.path}/{name}")

    def _settings(self) -> tuple[int, int]:
        held = json.loads(read_text(self.spark, f"{self.path}/begin"))
        return held["first"], held["size"]

    def _next(self) -> int:
        """The block after the last one that is taken."""
        groups = list_dirs(self.spark, f"{self.path}/blocks")
        if not groups:
            return 0
        return max((int(n) for n in list_files(self.spark, f"{self.path}/blocks/{groups[-1]}")), default=int(groups[-1]) * GROUP - 1) + 1

    def _take(self, block: int) -> bool:
        return create_new(self.spark, f"{self.path}/blocks/{block // GROUP:016d}/{block:019d}", "")

    def pass_over(self, explicit: int) -> None:
        """An id that a record brings along is not given out later: its block is taken, and with it all blocks below are behind."""
        first, size = self._settings()
        if explicit >= first and (explicit - first) // size >= self._next():
            self._take((explicit - first) // size)

    def lease(self, batch: int, n: int) -> list[tuple[int, int]]:
        """Runs (first id, number of ids) that hold ``n`` ids, the same ones whenever the batch asks for as many again."""
        record = f"batches/{batch // GROUP:016d}/{batch:019d}-{n}"
        first, size = self._settings()
        if not path_exists(self.spark, f"{self.path}/{record}"):
            blocks: list[int] = []
            tries, block = 0, self._next()
            while len(blocks) * size < n:
                if self._take(block):
                    blocks.append(block)
                elif (tries := tries + 1) > TRIES:
                    raise OSError(f"no block of ids could be leased in {self.path}")
                block += 1
            runs: list[list[int]] = []
            for b in blocks:
                if runs and runs[-1][0] + runs[-1][1] == b:
                    runs[-1][1] += 1
                else:
                    runs.append([b, 1])
            self._place(record, [[first + b * size, count * size] for b, count in runs])
        return [(a, count) for a, count in json.loads(read_text(self.spark, f"{self.path}/{record}"))]


def assign_leased(df: DataFrame, leases: IdLeases, batch: int, *, order: list[str] | tuple[str, ...], id_col: str = "id") -> DataFrame:
    """Rows without an id get the leased ids of ``batch`` in ``order`` (unique, and the same when the batch is replayed).

    Rows are ranked once and written (``positions``), counted, and only then numbered: no stored row is read. Ids that rows
    bring along are passed over first. A rank finds its run by the runs' bounds: one run, unless writers met.
    """
    given = df.where(F.col(id_col).isNotNull()).withColumn(id_col, F.col(id_col).cast("bigint"))
    ranked = positions(df.where(F.col(id_col).isNull()), order)
    n = ranked.count()
    top = given.agg(F.max(id_col).alias("top")).first().top
    if top is not None:
        leases.pass_over(top)
    place = F.col("_position")
    new, before = place, 0
    for k, (first, count) in enumerate(leases.lease(batch, n)):
        here = place + F.lit(first - before).cast("bigint")
        new = F.when(place >= before, here).otherwise(new) if k else here
        before += count
    numbered = ranked.withColumn(id_col, new)
    return given.select(*df.columns).unionByName(numbered.select(*df.columns))
