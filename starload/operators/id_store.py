"""Stored ids, probed without reading them all.

A batch asks which of its ids are stored already. Reading or shuffling all stored ids for that costs more with every batch that
was ever loaded. Here ids lie in Spark-bucketed Parquet runs, sorted by id within a bucket, with Bloom filters on the id:

* A batch that names few ids (``LITERALS``, as many as a call or a flush holds) pushes them down as values: only their buckets are
  opened, and of these only row groups whose statistics and Bloom filter let an id through.
* A larger one is dealt to the runs' buckets and joined there. The stored side isn't shuffled.

New batches are small folders of their own, so a batch that is run again replaces what it wrote. ``compact`` merges ``FAN`` of them
into a run, and ``FAN`` runs of one size into the next size, so there are a logarithm of runs and each id is rewritten as often. A
run is named after the batches it holds and its highest id, and counts once it is written whole; what lies inside another run is left out, so a
merge that is broken off at any point, before or after the old ones are deleted, changes no answer.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import delete_path, list_dirs, path_exists

LITERALS, FAN = 1000, 8
#: Of a run: bytes of a row group, so that a probe reads little, and the distinct ids that its Bloom filter is made for.
GROUP_BYTES = 1 << 20
#: The batch before all others: ids that were there when the store began.
GIVEN = -1


@dataclass(frozen=True)
class Run:
    first: int
    last: int
    buckets: int
    highest: int

    @property
    def name(self) -> str:
        return f"{self.first}_{self.last}_{self.buckets}_{self.highest}"

    @property
    def level(self) -> int:
        return int(math.log(self.last - self.first + 1, FAN) + 1e-9)


class IdStore:
    """The ids of one table, in ``path``. ``buckets`` of new runs: the session's shuffle partitions unless given."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def add(self, ids: DataFrame, batch_id: int) -> None:
        """Ids of a batch; adding the batch again replaces them."""
        rows = ids.select(F.col(ids.columns[0]).cast("bigint").alias("id")).where("id is not null")
        rows.write.mode("overwrite").parquet(f"{self.path}/recent/batch_id={batch_id}")

    def runs(self) -> list[Run]:
        """Whole runs that lie in no other, by their batches."""
        names = [n for n in list_dirs(self.spark, f"{self.path}/runs") if path_exists(self.spark, f"{self.path}/runs/{n}/_SUCCESS")]
        found = sorted((Run(*map(int, n.split("_"))) for n in names), key=lambda r: (r.first, -r.last))
        out: list[Run] = []
        for r in found:
            if not out or r.last > out[-1].last:
                out.append(r)
        return out

    def recent(self) -> list[int]:
        """Batches that no run holds."""
        runs = self.runs()
        numbers = (int(n.split("=")[1]) for n in list_dirs(self.spark, f"{self.path}/recent") if n.startswith("batch_id="))
        return sorted(b for b in numbers if not any(r.first <= b <= r.last for r in runs))

    def _table(self, run: Run) -> DataFrame:
        """The run as a bucketed table. Its definition is the run's name, so any session can make it again."""
        where, name = f"{self.path}/runs/{run.name}", self._name(run)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id BIGINT) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {run.buckets} BUCKETS LOCATION '{where}'")
        return self.spark.table(name)

    def _name(self, run: Run) -> str:
        return f"starload_ids_{zlib.crc32(self.path.encode()):08x}_{run.name.replace('-', 'm')}"

    def _batch(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema("id bigint").parquet(f"{self.path}/recent/batch_id={batch_id}")

    def _parts(self, before: int | None) -> list[DataFrame]:
        runs, recent = self.runs(), self.recent()
        if before is not None:
            if any(r.last >= before for r in runs):
                raise ValueError(f"a run holds batch {before} already")
            recent = [b for b in recent if b < before]
        return [*(self._table(r) for r in runs), *(self._batch(b) for b in recent)]

    def all(self, before: int | None = None) -> DataFrame:
        return self._union(self._parts(before))

    def highest(self, before: int | None = None) -> int:
        """The highest stored id, or 0: of runs from their names, of the few other batches by reading them."""
        recent = [self._batch(b) for b in self.recent() if before is None or b < before]
        return max([0, *(r.highest for r in self.runs()), self._highest(recent)])

    def _highest(self, parts: list[DataFrame]) -> int:
        return self._union(parts).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] if parts else 0

    def _union(self, parts: list[DataFrame]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], "id bigint")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def probe(self, wanted: DataFrame, before: int | None = None) -> DataFrame:
        """The distinct ids of ``wanted`` that are stored, by batches below ``before``."""
        parts = self._parts(before)
        asked = wanted.select(F.col(wanted.columns[0]).cast("bigint").alias("id")).where("id is not null").distinct()
        few = [r.id for r in asked.limit(LITERALS + 1).collect()]
        if len(few) <= LITERALS:
            hits = [p.where(F.col("id").isin(few)) for p in parts] if few else []
        else:
            hits = [p.join(asked, "id", "left_semi") for p in parts]
        return self._union(hits).distinct()

    def begin(self, given: DataFrame) -> None:
        """Takes the ids that are there before the first batch, once."""
        if not path_exists(self.spark, f"{self.path}/recent/batch_id={GIVEN}/_SUCCESS") and not any(r.first == GIVEN for r in self.runs()):
            self.add(given, GIVEN)

    def compact(self, before: int) -> None:
        """Merges batches below ``before`` (all of them are done), and runs of one size, as long as there are ``FAN`` of them."""
        recent = [b for b in self.recent() if b < before]
        if GIVEN in recent:
            self._merge([self._batch(GIVEN)], GIVEN, GIVEN, self._highest([self._batch(GIVEN)]))
            recent.remove(GIVEN)
        while len(recent) >= FAN:
            take, recent = recent[:FAN], recent[FAN:]
            parts = [self._batch(b) for b in take]
            self._merge(parts, take[0], take[-1], self._highest(parts))
        while True:
            runs = [r for r in self.runs() if r.first > GIVEN]
            same = next((runs[i : i + FAN] for i in range(len(runs) - FAN + 1) if len({r.level for r in runs[i : i + FAN]}) == 1), None)
            if same is None:
                break
            self._merge([self._table(r) for r in same], same[0].first, same[-1].last, max(r.highest for r in same))
        self._clean()

    def _merge(self, parts: list[DataFrame], first: int, last: int, highest: int) -> None:
        run = Run(first, last, self.buckets, highest)
        where = f"{self.path}/runs/{run.name}"
        if path_exists(self.spark, f"{where}/_SUCCESS"):
            return
        delete_path(self.spark, where)
        draft = f"draft_{self._name(run)}"
        self.spark.sql(f"DROP TABLE IF EXISTS {draft}")
        rows = self._union(parts).distinct().repartition(self.buckets, "id")
        writer = rows.write.format("parquet").option("path", where).option("parquet.bloom.filter.enabled#id", "true").option("parquet.block.size", str(GROUP_BYTES))
        writer = writer.option("parquet.bloom.filter.expected.ndv#id", str(GROUP_BYTES // 8)).option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.bucketBy(self.buckets, "id").sortBy("id").saveAsTable(draft)
        self.spark.sql(f"DROP TABLE {draft}")  # the files stay: the table is external

    def _clean(self) -> None:
        """Deletes what lies in a run now."""
        runs = self.runs()
        for name in list_dirs(self.spark, f"{self.path}/runs"):
            old = Run(*map(int, name.split("_")))
            if any(r.first <= old.first and old.last <= r.last and r != old for r in runs):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(old)}")
                delete_path(self.spark, f"{self.path}/runs/{name}")
        for name in list_dirs(self.spark, f"{self.path}/recent"):
            if any(r.first <= int(name.split("=")[1]) <= r.last for r in runs):
                delete_path(self.spark, f"{self.path}/recent/{name}")
