"""Main text of web pages: flat text blocks judged by a decision tree over their own and their neighbours' shape.

A page becomes flat blocks (html_blocks.py). Features are word count and link density of a block, of the one before and
the one after, and where it stands. The tree is a Spark ML decision tree, trained on the small labelled table of
html_labels.py; its nodes (at most 2**MAX_DEPTH leaves) go to the tasks, where each page is judged on its own.

Defined results: null, empty and text-free html have an empty text; repeated rows and null ids keep their rows; broken
markup (unclosed, cut off) is read as far as it goes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession

from starload.llm.common import prepare, slices
from starload.llm.html_blocks import blocks, features
from starload.llm.html_labels import PAGES

MAX_DEPTH = 6
Node = tuple | float


def labelled(spark: SparkSession, pages: list[str]) -> DataFrame:
    """The labelled blocks (label, features) of pages whose blocks begin with + or -."""
    rows = []
    for page in pages:
        found = blocks(page)
        rows += [(float(b.text[0] == "+"), Vectors.dense(f)) for b, f in zip(found, features(found), strict=True)]
    return spark.createDataFrame(rows, ["label", "features"]).coalesce(1)


def train(spark: SparkSession, pages: list[str] | None = None) -> Node:
    """The tree as nested (feature, threshold, left, right), leaves being 0.0 or 1.0."""
    table = labelled(spark, PAGES if pages is None else pages)
    model = DecisionTreeClassifier(maxDepth=MAX_DEPTH, minInstancesPerNode=1, seed=1).fit(table)

    def read(node) -> Node:
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        split = node.split()
        return (int(split.featureIndex()), float(split.threshold()), read(node.leftChild()), read(node.rightChild()))

    return read(model._call_java("rootNode"))


def judge(tree: Node, x: np.ndarray) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, left, right = tree
        tree = left if x[feature] <= threshold else right
    return tree > 0.5


def main_text(tree: Node, page: str) -> str:
    found = blocks(page)
    return " ".join(b.text for b, x in zip(found, features(found), strict=True) if judge(tree, x))


def _texts(tree: Node):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, page in slices(batches, "html"):
            texts = [main_text(tree, p) for p in page.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame, tree: Node | None = None) -> DataFrame:
    """One row per page: id, url, main text and its code points."""
    prepare(pages.sparkSession)
    tree = train(pages.sparkSession) if tree is None else tree
    return pages.select("page_id", "url", "html").mapInArrow(_texts(tree), "page_id long, url string, text string, n_chars long")
