"""Text quality by votes of the nearest labelled documents in a latent-semantic space.

1. A text's terms are hashed into a fixed number of columns: three-grams of character classes (so that shapes count and
   languages do not), lower-cased words, and a few counts of word lengths and repetitions. Each kind is log-scaled and
   brought to the same length.
2. The latent space is the leading right singular vectors of a bounded sample of labelled documents (``SAMPLE``, the least
   by a hash of the id), fitted on the driver from its terms; its vectors and labels are broadcast (their size is bounded).
3. Every document is projected, compared with all labelled vectors by exact cosine products in blocks of rows, and scored
   by the labels of the ``NEIGHBOURS`` most similar, weighted by a power of the similarity.

Labels, language, source and id are no inputs of a score. Defined results: a null or empty text, and any text if nothing is
labelled, gets the labelled share of good documents (one half without labels); several labels of one id count as their
mean; rows of equal id or null id are scored each by its text; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepare, slices
from starload.llm.words import words_of

SAMPLE, RANK, NEIGHBOURS, POWER = 4096, 32, 15, 8.0
COLUMNS, COUNTS = 1024, 64
WIDTH = 2 * COLUMNS + COUNTS
GOOD = 0.7
_ROWS = 256


def _classes() -> np.ndarray:
    """Class of each byte: 1 beyond ASCII or control, 2 lower case, 3 upper case, 4 digit, 5 space, 6 line feed, then each ASCII mark its own."""
    out = np.ones(256, np.int64)
    out[97:123], out[65:91], out[48:58], out[32], out[10] = 2, 3, 4, 5, 6
    marks = [b for b in range(33, 127) if out[b] == 1]
    out[marks] = np.arange(7, 7 + len(marks))
    return out


_CLASS = _classes()


def terms(text: pa.Array) -> np.ndarray:
    """(rows, WIDTH): hashed term counts of each text; ``text`` is a large_string array without nulls."""
    w = words_of(text, lower=True)
    sizes = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    classes, lengths = _CLASS[w.data], np.minimum(w.end - w.start, 31)
    out = np.zeros((len(text), WIDTH), np.float32)
    for i in range(len(text)):
        x = classes[bounds[i] : bounds[i + 1]]
        if len(x) > 1:  # a run of one letter class counts once, a run of marks does not
            x = x[np.concatenate([[True], (x[1:] != x[:-1]) | (x[1:] >= 7)])]
        if len(x) > 2:
            gram = (x[:-2] * 64 + x[1:-1]) * 64 + x[2:]
            out[i, :COLUMNS] = np.bincount((gram * 0x9E3779B1 >> 8) & (COLUMNS - 1), minlength=COLUMNS)
        a, b = w.first[i], w.first[i + 1]
        if b > a:
            h = w.hash[a:b]
            out[i, COLUMNS : 2 * COLUMNS] = np.bincount((h >> np.uint64(7)).astype(np.int64) & (COLUMNS - 1), minlength=COLUMNS)
            out[i, 2 * COLUMNS : 2 * COLUMNS + 32] = np.bincount(lengths[a:b], minlength=32)
            distinct = len(np.unique(h))
            out[i, 2 * COLUMNS + 32 : 2 * COLUMNS + 35] = b - a - distinct, distinct, (h[1:] == h[:-1]).sum()
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    out = np.log1p(counts)
    for a, b in ((0, COLUMNS), (COLUMNS, 2 * COLUMNS), (2 * COLUMNS, WIDTH)):
        out[:, a:b] /= np.maximum(np.linalg.norm(out[:, a:b], axis=1, keepdims=True), 1e-9)
    return out


@dataclass
class QualityModel:
    """``axes``: (WIDTH, rank); ``vectors``: unit rows of the labelled documents; ``labels``: 0 to 1; ``share``: their mean."""

    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def score(self, text: pa.Array) -> np.ndarray:
        return self.judged(text)[0]

    def judged(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The score of each text, and whether any neighbour voted: without, the score is the share and tells nothing of the text."""
        if not len(self.labels):
            return np.full(len(text), self.share), np.zeros(len(text), bool)
        x = scaled(terms(text)) @ self.axes
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        near = (x / np.maximum(norm, 1e-9)) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** POWER
        total = weight.sum(axis=1)
        vote = (weight * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-30)
        voted = (total > 1e-12) & (norm[:, 0] > 1e-9)
        return np.clip(np.where(voted, vote, self.share), 0, 1), voted


def leading_axes(x: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration: little more memory than ``x`` itself."""
    q = np.random.default_rng(7).standard_normal((x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32)
    for _ in range(20):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :rank].astype(np.float32)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, text in slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.float64()), pa.array([r.tobytes() for r in terms(text)], pa.binary())], names=["doc_id", "label", "terms"])


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learnt from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = RANK) -> QualityModel:
    """Learns from at most ``sample`` labelled documents outside of the held-out fold."""
    prepare(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.avg("quality").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = texts.mapInArrow(_terms, "doc_id long, label double, terms binary").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r.doc_id)
    y = np.array([r.label for r in rows], np.float64)
    if not rows:
        return QualityModel(np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5)
    x = np.empty((len(rows), WIDTH), np.float32)
    for i in range(len(rows)):
        x[i] = scaled(np.frombuffer(rows[i].terms, np.float32)[None])[0]
        rows[i] = None
    axes = leading_axes(x, rank)
    points = x @ axes
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    return QualityModel(axes, points.astype(np.float32), y, float(y.mean()))


def _scores(model, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text"):
            for at in range(0, batch.num_rows, _ROWS):
                score = model.value.score(text.slice(at, _ROWS))
                yield pa.RecordBatch.from_arrays([*(batch.slice(at, _ROWS).column(c) for c in columns), pa.array(score)], names=[*columns, "score"])

    return run


def _kept(model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text"):
            for at in range(0, batch.num_rows, _ROWS):
                score, voted = model.value.judged(text.slice(at, _ROWS))
                yield batch.slice(at, _ROWS).filter(pa.array((score >= least) | ~voted))

    return run


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per document: id, held-out fold, score and the decision at ``GOOD``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    out = rows.mapInArrow(_scores(shared, ["doc_id", "held_out"]), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def good_documents(docs: DataFrame, model: QualityModel, least: float = GOOD) -> DataFrame:
    """The rows of ``docs``, unchanged, that score ``least`` or more, or of which the model knows nothing (no labels, no votes)."""
    prepare(docs.sparkSession)
    return docs.mapInArrow(_kept(docs.sparkSession.sparkContext.broadcast(model), least), docs.schema)
