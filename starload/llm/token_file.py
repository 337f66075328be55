"""Token-id files: documents in ascending id, encoded as images of a range asymmetric numeral system (see rans.py).

Documents are range-partitioned and sorted by id; each task encodes its documents and closes an image when it holds
``IMAGE_IDS`` ids, so memory is bounded by that or one document. Images are rows of a Parquet dataset: Spark's commit
protocol makes the write safe against lost executors, and any store that Spark writes will do.

Defined results: a null or empty text is the end id alone; null ids come first; rows that share an id follow one
another; an empty table writes and reads back nothing; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm import rans
from starload.llm.common import prepare, slices, text_rows
from starload.llm.tokens import encoder, vocabulary_path

IMAGE_IDS = 2 << 20
IMAGES = "part int, image int, n_docs long, n_ids long, bytes binary"
DOCS = "part int, image int, place int, doc_id long, before long, n_tokens long, ids_crc32 long"


def _images(path: str, end_id: int, image_ids: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, image = TaskContext.get().partitionId(), 0
        encode = encoder(path).encode
        doc_ids: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            data = rans.encode(ids, doc_ids, np.array([len(p) // 4 for p in parts]))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([image], pa.int32()), pa.array([len(parts)]), pa.array([held]), pa.array([data], pa.binary())],
                names=["part", "image", "n_docs", "n_ids", "bytes"],
            )

        for batch, text in slices(batches, "text", tokens=True):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(text.to_pylist()), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= image_ids:
                    yield close()
                    doc_ids, parts, held, image = [], [], 0, image + 1
        if parts:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, end_id: int = 2, vocabulary: str | None = None, image_ids: int = IMAGE_IDS) -> None:
    """Writes the images of all documents below ``path``. Rows of one id are spread over a range's tasks by a row number."""
    prepare(docs.sparkSession)
    rows = text_rows(docs).select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(F.col("doc_id"), F.col("row")).sortWithinPartitions("doc_id", "row")
    images = ordered.select("doc_id", "text").mapInArrow(_images(vocabulary or vocabulary_path(), end_id, image_ids), IMAGES)
    images.write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part, number = batch.column("part")[row].as_py(), batch.column("image")[row].as_py()
            image = rans.decode(batch.column("bytes")[row].as_py())
            after = np.cumsum(image.lengths.astype(np.int64))
            before = after - image.lengths
            raw = image.ids.astype("<u4")
            sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(before.tolist(), after.tolist(), strict=True)]
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(image.doc_ids, pa.int64()),
                    pa.array(before), pa.array(image.lengths.astype(np.int64)), pa.array(sums, pa.int64()),
                ],
                names=["part", "image", "place", "doc_id", "before", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document in the files: its place, its number of ids, their checksum, and the ids of all documents before it.

    Only image headers are summed: within a part by a window, over the parts (one row each) in one task. A worker holds one
    Arrow batch of images, which ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB) bounds, and one decoded image.
    """
    prepare(spark)
    images = spark.read.schema(IMAGES).parquet(path)
    heads = images.select("part", "image", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    base = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    within = Window.partitionBy("part").orderBy("image")
    starts = heads.select("part", "image", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("skipped")).join(base, "part")
    docs = images.select("part", "image", "bytes").mapInArrow(_documents, DOCS)
    out = docs.join(starts, ["part", "image"]).select("doc_id", (F.col("base") + F.col("skipped") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    return out
