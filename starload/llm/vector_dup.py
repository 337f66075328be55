"""Near-duplicate vectors by a pivot-permutation index: inverted lists of shared nearest pivots, then exact cosines.

1. Pivots are rows of the table itself, from a bounded sample (twice ``pivot_count``), the least by a hash of the row. One
   that is close to an earlier pivot is left out: among pivots of one crowd the order would be chance.
2. Every vector is described by its ``NEAREST`` nearest pivots in order. Its inverted lists are the pairs of them, so two
   vectors meet in a list if they share two pivots, and in more lists the more they share.
3. Lists are compared in blocks of bounded size. A pair of vectors is looked at in the one list of their two lowest
   shared pivots, and it counts if its cosine in double precision is at least the threshold.
4. Links of a block are counted per vector, and only what connects the block goes on to the components.

Recall against brute force is measured in the tests (at least 0.9 is asked for; pairs at 0.9 itself are the hardest).
Equal vectors are one class before all this, so a vector with very many copies is compared once.

Defined results: null vectors, zero ones, ones with null or non-finite parts, and vectors of another length than the
pivots link with nothing (n_links 0, their own component, kept); repeated rows link with one another; a null id takes
part and gets the least id of its component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.blocks import BLOCK_KEYS, dealt, in_blocks, whole_groups
from starload.llm.common import prepare, staged
from starload.llm.components import connected

#: Nearest pivots of a vector; its lists are the pairs of these.
NEAREST = 8
#: Bounds of the number of pivots, which grows with the square root of the number of vectors.
PIVOTS_LEAST, PIVOTS_MOST = 64, 4096
CHUNK = 1024
#: Cosine from which on a vector is too close to a pivot to be one too.
APART = 0.5


def pivot_count(n: int) -> int:
    return int(min(max(2 * n**0.5, PIVOTS_LEAST), PIVOTS_MOST))


def spread_out(unit: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` rows, in order, that are not close to one taken before."""
    taken = np.zeros((0, unit.shape[1]))
    for v in unit:
        if len(taken) < most and not (taken @ v >= APART).any():
            taken = np.vstack([taken, v])
    return taken


def _unit(raw: pa.Array, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw.to_pylist()), np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles, scaled so that their squares neither overflow nor vanish; null for one that links with nothing."""
    for batch in batches:
        out = []
        for v in batch.column("embedding").to_pylist():
            x = None if not v or any(c is None for c in v) else np.array(v, np.float64)
            top = 0.0 if x is None else float(np.abs(x).max())
            out.append((x / top + 0.0).tobytes() if x is not None and np.isfinite(x).all() and top > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").cast(pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "vector"])


def _described(pivots: np.ndarray):
    """The ordered nearest pivots of each vector, and the keys of its lists."""
    dim = pivots.shape[1]
    near = min(NEAREST, len(pivots))
    one, two = np.triu_indices(near, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = np.array([len(v) == 8 * dim for v in batch.column("vector").to_pylist()], bool)
            batch = batch.filter(pa.array(fits))
            if not batch.num_rows:
                continue
            product = _unit(batch.column("vector"), dim) @ pivots.T
            order = np.argsort(-product, axis=1, kind="stable")[:, :near].astype(np.int64)
            ranked = np.sort(order, axis=1)
            keys = ranked[:, one] << 32 | ranked[:, two]
            if near < 2:
                keys = ranked << 32
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("copies"), batch.column("vector"), pa.array(order.tolist(), pa.list_(pa.int32())), pa.array(keys.tolist(), pa.list_(pa.int64()))],
                names=["class", "copies", "vector", "pivots", "keys"],
            )

    return run


def _linked(threshold: float):
    """Per block: the weight of the links of each member, and the links that connect the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, BLOCK_KEYS):
            dim = len(table.column("vector")[0].as_py()) // 8
            x = _unit(table.column("vector"), dim)
            order = np.sort(np.array(table.column("pivots").to_pylist(), np.int64), axis=1)
            copies, classes = table.column("copies").to_numpy(), table.column("class").to_numpy()
            chunk, key = table.column("chunk").to_numpy(), table.column("list_key").to_numpy()
            two = table.column("chunk_i").to_numpy() != table.column("chunk_j").to_numpy()
            who, weight, a_of, b_of = [], [], [], []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                near = x[s:e] @ x[s:e].T >= threshold
                np.fill_diagonal(near, False)
                if two[s]:
                    near &= chunk[s:e, None] != chunk[None, s:e]
                a, b = np.nonzero(np.triu(near))
                if not len(a):
                    continue
                least = _two_lowest(order[s + a], order[s + b])
                a, b = a[least == key[s]], b[least == key[s]]
                if not len(a):
                    continue
                n = e - s
                total = np.bincount(a, copies[s + b], n) + np.bincount(b, copies[s + a], n)
                at = np.flatnonzero(total)
                who.append(classes[s + at])
                weight.append(total[at].astype(np.int64))
                root = np.arange(n)
                while True:  # least label over the links, with pointer jumping
                    low = np.minimum(root[a], root[b])
                    new = root.copy()
                    np.minimum.at(new, root[a], low)
                    np.minimum.at(new, root[b], low)
                    new = new[new]
                    if (new == root).all():
                        break
                    root = new
                child = np.flatnonzero(root != np.arange(n))
                a_of.append(classes[s + child])
                b_of.append(classes[s + root[child]])
            for left, right, kind in ((who, weight, 0), (a_of, b_of, 1)):
                if left:
                    one, other = np.concatenate(left), np.concatenate(right)
                    yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(other), pa.array(np.full(len(one), kind, np.int32))], names=["class", "value", "kind"])

    return run


def _two_lowest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """List key of the two lowest shared pivots of each pair of sorted rows; -1 if there are not two."""
    if a.shape[1] < 2:
        return np.where(a[:, 0] == b[:, 0], a[:, 0] << 32, -1)
    shared = np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, np.int64(1) << 31)
    low = np.sort(shared, axis=1)[:, :2]
    return np.where(low[:, 1] < 1 << 31, low[:, 0] << 32 | low[:, 1], -1)


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per vector: other vectors linked directly, the least id of its component, and whether it is that one."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = staged(rows.mapInArrow(_packed, "vec_id long, vector binary"), "vectors")
    classes = rows.where("vector is not null").groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    classes = staged(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("vector"), "class").limit(2 * pivot_count(n)).select("vector").collect()
    dims = [len(r.vector) for r in sample]
    dim = max(set(dims), key=dims.count) if dims else 8
    raw = np.frombuffer(b"".join(r.vector for r in sample if len(r.vector) == dim), np.float64).reshape(-1, dim // 8)
    pivots = spread_out(raw / np.linalg.norm(raw, axis=1)[:, None], pivot_count(n)) if len(raw) else np.ones((1, dim // 8))
    described = classes.select("class", "copies", "vector").mapInArrow(_described(pivots), "class long, copies long, vector binary, pivots array<int>, keys array<long>")
    described = staged(described, "described")
    members = in_blocks(described.select("class", F.explode("keys").alias("list_key")), "class", CHUNK)
    found = dealt(members.join(described.drop("keys"), "class")).mapInArrow(_linked(threshold), "class long, value long, kind int")
    found = staged(found, "vector-links")
    links = found.where("kind = 0").groupBy("class").agg(F.sum("value").alias("links"))
    roots = connected(found.where("kind = 1").select(F.col("class").alias("a"), F.col("value").alias("b")), "a", "b")
    named = classes.select("class", "vector", "copies", "low").join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = staged(named.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    per_class = named.join(least, "root").join(links, "class", "left").select("vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(per_class, "vector", "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
