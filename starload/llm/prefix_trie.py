"""Prefix trie of conversations that share their first turns: nodes by digest, minimal perfect hashes, parent-slot sums.

1. Turns get their place by one range-partitioned ranking of the whole table, so a conversation of any length is spread
   over tasks. Rebuilt conversations are rows (conversation, depth) with a 128-bit digest of the first ``depth`` turns:
   each turn is hashed with its depth, and a running exclusive or makes prefixes of it, in blocks of ``BLOCK`` turns.
2. Distinct digests are the nodes. A digest must go with one parent and one last turn, else the query fails. Nodes know
   their members' rows below them, a bound of the nodes in their subtree.
3. The trie is cut under the nodes with more than ``SHARD`` such rows (the top). What hangs below are subtrees of bounded
   size, the shards, whatever first turns a third of all conversations share. In a shard a minimal perfect hash gives each
   digest its slot, checked against the stored digests; ends are scattered into flat arrays by slot and summed through the
   parent-slot array from the deepest level up.
4. Top nodes sum what is below them along the paths of conversations: every top node and shard has its value on the path
   of its smallest member, and the sum of a path from a depth on, over all members, is the sum of the subtree.
5. The ids that end at a node are joined to pieces of up to a batch in range partitions; a node's pieces are hashed in order.

Defined results: rows with a null ``conv_id`` are left out; the remainder of a negative id has its sign; turns with equal numbers are taken in the order of role and
then of the text's digest; an empty table gives no rows, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.blocks import whole_groups
from starload.llm.common import prepare, staged
from starload.llm.words import mix
from starload.operators.loading import positions

#: Most member rows below the nodes of a shard, and turns of a block of a running value.
SHARD, BLOCK = 65_536, 65_536
#: Fixed values of the rebuilding: conversations of a family, and one more than the most turns taken from its first.
FAMILY, TAKEN = 20, 4
NODE = ["depth", "x1", "x2"]
_NONE = np.iinfo(np.int64).max


def running(rows: DataFrame, order: list[Column], how, values: dict[str, Column], downwards: bool = False) -> DataFrame:
    """``how`` of ``values`` along each conversation, in blocks of depths: what lies in earlier blocks is carried over.

    ``downwards`` runs from the deepest turn. Only conversations longer than a block have something to carry."""
    cut = rows.withColumn("block", F.floor(F.col("depth") / BLOCK)).withColumns({f"in_{n}": v for n, v in values.items()})
    inside = Window.partitionBy("conv_id", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    blocks = cut.where(F.col("len") >= BLOCK).groupBy("conv_id", "block").agg(*[how(f"in_{n}").alias(f"in_{n}") for n in values])
    along = Window.partitionBy("conv_id").orderBy(F.desc("block") if downwards else F.asc("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = staged(blocks.select("conv_id", "block", *[how(f"in_{n}").over(along).alias(f"before_{n}") for n in values]), "carried")
    out = cut.withColumns({n: how(f"in_{n}").over(inside) for n in values}).join(carried, ["conv_id", "block"], "left")
    plus = (lambda a, b: a.bitwiseXOR(b)) if how is F.bit_xor else (lambda a, b: a + b)
    return out.withColumns({n: plus(F.col(n), F.coalesce(f"before_{n}", F.lit(0))) for n in values}).select(*rows.columns, *values)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation (conv_id, len) and its rebuilt turns: conv_id, len, depth, t1, t2 (digest), words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("turn"), text, role).alias("t2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    ranked = positions(turns, ["conv_id", "turn", "role", "t1", "t2"])
    sizes = staged(ranked.groupBy("conv_id").agg(F.min("_position").alias("first"), F.count("*").alias("n")), "conversations")
    at = F.col("_position") - F.col("first")
    first = ranked.where(F.col("conv_id") % FAMILY == 0).join(sizes, "conv_id").where(at < TAKEN - 1)
    heads = staged(first.groupBy(F.col("conv_id").alias("of")).agg(F.sort_array(F.collect_list(F.struct(at.alias("at"), "t1", "t2", "words"))).alias("head")), "heads")
    taken = sizes.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % TAKEN).cast("int"))
    taken = taken.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("of"), "left")
    taken = taken.withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")))
    long = F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    plan = staged(taken.select("conv_id", "first", "h", "head", F.size("head").alias("before"), long.alias("len")), "rebuilding")
    front = plan.select("conv_id", "len", F.posexplode("head").alias("place", "turn")).select(
        "conv_id", "len", (F.col("place") + 1).cast("long").alias("depth"), "turn.t1", "turn.t2", "turn.words"
    )
    own = ranked.join(plan.drop("head"), "conv_id").where(at >= F.col("h"))
    own = own.select("conv_id", "len", (F.col("before") + at - F.col("h") + 1).cast("long").alias("depth"), "t1", "t2", "words")
    return plan.select("conv_id", "len"), front.unionByName(own)


def _paths(turns: DataFrame) -> DataFrame:
    """Rebuilt turns with the digest of the prefix that each ends (x1, x2) and of the one before (p1, p2)."""
    v1, v2 = F.xxhash64("depth", "t1", "t2"), F.xxhash64(F.lit("prefix"), "t2", "depth", "t1")
    out = running(turns, [F.asc("depth")], F.bit_xor, {"x1": v1, "x2": v2})
    return out.withColumns({"p1": F.col("x1").bitwiseXOR(v1), "p2": F.col("x2").bitwiseXOR(v2)})


def _nodes(paths: DataFrame) -> DataFrame:
    ends = F.col("len") == F.col("depth")
    same = ["p1", "p2", "t1", "t2"]
    found = paths.groupBy(*NODE).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("owner"), F.sum(F.col("len") - F.col("depth") + 1).alias("below"),
        F.sum(ends.cast("long")).alias("ends"), F.min(F.when(ends, F.col("conv_id"))).alias("least_end"), F.max("words").alias("words"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_high") for c in same],
    )
    one = F.lit(True)
    for c in same:
        one = one & (F.col(c) == F.col(f"{c}_high"))
    checked = F.when(one, F.col("p1")).otherwise(F.raise_error(F.lit("two prefixes have the same digest")).cast("long"))
    return found.withColumn("p1", checked).drop("t1", "t2", *[f"{c}_high" for c in same])


class SlotTable:
    """A minimal perfect hash of distinct 64-bit keys: keys alone at their place in a level get the next slots, the others go on to the next level."""

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[np.ndarray] = []
        done = 0
        while len(keys):
            at = self._at(keys, len(self.levels), 2 * len(keys) + 1)
            alone = np.bincount(at, minlength=2 * len(keys) + 1) == 1
            self.levels.append(np.where(alone, np.cumsum(alone) - 1 + done, -1))
            done += int(alone.sum())
            keys = keys[~alone[at]]

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not put in gets any slot or -1, so what is stored there must be compared."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, slot_at in enumerate(self.levels):
            found = slot_at[self._at(keys[left], level, len(slot_at))]
            out[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
        return out


def _keys(a: np.ndarray, b: np.ndarray, depth: np.ndarray, salt: int) -> np.ndarray:
    return mix(a.view(np.uint64) + np.uint64(salt)) ^ mix(b.view(np.uint64) ^ mix(depth.astype(np.uint64)))


SUMS = "depth long, x1 long, x2 long, p1 long, p2 long, hangs boolean, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _shard(depth, x1, x2, p1, p2, words, ends, least):
    """Arrays by slot, of all nodes of some shards; a node whose parent is not in them hangs from the top."""
    salt = 0
    while len(np.unique(keys := _keys(x1, x2, depth, salt))) < len(keys):
        salt += 1
    table = SlotTable(keys)
    slot = table.slots(keys)
    by_slot = np.empty_like(slot)
    by_slot[slot] = np.arange(len(slot))
    depth, x1, x2, p1, p2, words, n, low = (a[by_slot].copy() for a in (depth, x1, x2, p1, p2, words, ends, least))
    parent = table.slots(_keys(p1, p2, depth - 1, salt))
    parent[(x1[parent] != p1) | (x2[parent] != p2) | (depth[parent] != depth - 1)] = -1
    children, leaves, saved = (np.zeros(len(n), np.int64) for _ in range(3))
    order = np.argsort(depth, kind="stable")
    for level in reversed(np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)):
        leaves[level[children[level] == 0]] = 1
        saved[level] += (n[level] - 1) * words[level]
        inner = level[parent[level] >= 0]
        up = parent[inner]
        np.add.at(children, up, 1)
        for sums in (n, leaves, saved):
            np.add.at(sums, up, sums[inner])
        np.minimum.at(low, up, low[inner])
    return depth, x1, x2, p1, p2, parent, low, n, children, leaves, saved


def _accumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SUMS.split(", ")]
    for part, _ in whole_groups(batches, ["r1", "r2"], SHARD):
        column = lambda c: part.column(c).to_numpy()  # noqa: E731, B023
        *node, parent, low, n, children, leaves, saved = _shard(*(column(c) for c in ("depth", "x1", "x2", "p1", "p2", "words", "ends", "least_end")))
        above = pa.array(low[parent], mask=parent < 0)
        yield pa.RecordBatch.from_arrays([*(pa.array(a) for a in node), pa.array(parent < 0), pa.array(low), above, *(pa.array(a) for a in (n, children, leaves, saved))], names=names)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted rows as text, joined by commas, as far as a batch holds rows of one node."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x1, x2, ids = (batch.column(c).to_numpy() for c in ("x1", "x2", "conv_id"))
        at = np.flatnonzero(np.concatenate([[True], (x1[1:] != x1[:-1]) | (x2[1:] != x2[:-1])]))
        text = [",".join(map(str, part.tolist())).encode() for part in np.split(ids, at[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(x1[at]), pa.array(x2[at]), pa.array(ids[at]), pa.array(text, pa.binary())], names=["x1", "x2", "conv_id", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of sorted pieces; only the running hash of one node is held."""
    node, digest = None, None
    done: list[tuple] = []

    def flush():
        a, b, sha = zip(*done, strict=True)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sha)], names=["x1", "x2", "ends_sha256"])

    for batch in batches:
        for x1, x2, ids in zip(*(batch.column(c).to_pylist() for c in ("x1", "x2", "ids")), strict=True):
            if (x1, x2) == node:
                digest.update(b",")
            else:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (x1, x2), hashlib.sha256()
            digest.update(ids)
        if len(done) >= 4096:
            yield flush()
    if node:
        done.append((*node, digest.hexdigest()))
        yield flush()


def _ends(convs: DataFrame, paths: DataFrame) -> DataFrame:
    nowhere = convs.where("len = 0").select("conv_id", F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"))
    ids = paths.where(F.col("len") == F.col("depth")).select("conv_id", "x1", "x2").unionByName(nowhere)
    spread = ids.repartitionByRange("x1", "x2", "conv_id").sortWithinPartitions("x1", "x2", "conv_id")
    pieces = spread.mapInArrow(_pieces, "x1 long, x2 long, conv_id long, ids binary").repartition("x1", "x2").sortWithinPartitions("x1", "x2", "conv_id")
    return pieces.mapInArrow(_hashed, "x1 long, x2 long, ends_sha256 string")


def _above(node: list[str], under: list[str]) -> list[Column]:
    return [F.col(a).alias(b) for a, b in zip(node, under, strict=True)]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: its smallest member and depth, its parent's smallest member, members, children, leaves and saved tokens of
    its subtree, and the digest of the ids that end there. ``x1`` and ``x2`` are the node's own digest."""
    prepare(conversations.sparkSession)
    convs, turns = rebuilt(conversations)
    paths = staged(_paths(turns), "paths")
    nodes = staged(_nodes(paths), "nodes")
    kept = staged(nodes.where(F.col("below") > SHARD), "top")
    keys = kept.select(*NODE)
    root = F.struct(*[F.lit(0).cast("long").alias(c) for c in NODE])
    parents = staged(kept.select(*NODE, "owner").unionByName(convs.agg(F.min("conv_id").alias("owner")).where("owner is not null").select(root.alias("r"), "owner").select("r.*", "owner")), "parents")

    # shards: the first node of a path that is not in the top, found on the path of every node's owner
    under = (F.col("depth") - 1 == F.col("d0")) & (F.col("p1") == F.col("a1")) & (F.col("p2") == F.col("a2"))
    above = parents.select(*_above(NODE, ["d0", "a1", "a2"]), F.col("owner").alias("parent_owner"))
    hanging = paths.join(keys, NODE, "left_anti").join(above, under, "left_semi").select(F.col("conv_id").alias("owner"), *_above(["x1", "x2"], ["r1", "r2"]))
    low = nodes.where(F.col("below") <= SHARD).withColumn("least_end", F.coalesce("least_end", F.lit(int(_NONE))))
    low = low.join(staged(hanging, "shard-roots"), "owner")
    low = low.select(*NODE, "p1", "p2", "words", "ends", "least_end", "r1", "r2").repartition("r1").sortWithinPartitions("r1", "r2")
    sums = staged(low.mapInArrow(_accumulated, SUMS), "shard-sums")

    # top: children, then values of top nodes and shards on their owners' paths, summed from each depth on
    count = staged(nodes.join(above, under).groupBy("d0", "a1", "a2").agg(F.count("*").alias("n_children")), "children")
    mine = (F.col("depth") == F.col("d0")) & (F.col("x1") == F.col("a1")) & (F.col("x2") == F.col("a2"))
    top = kept.join(count, mine, "left").select(*kept.columns, F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"))
    values = top.select(F.col("owner").alias("conv_id"), "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("words")).alias("saved"))
    values = staged(values.unionByName(sums.where("hangs").select("conv_id", "depth", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))), "values")
    on_paths = paths.join(keys, NODE, "left_semi").join(values, "conv_id", "left_semi").select("conv_id", *NODE, F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    nothing = F.lit(None).cast("long")
    marks = on_paths.unionByName(values.select("conv_id", "depth", nothing.alias("x1"), nothing.alias("x2"), "leaves", "saved")).join(convs, "conv_id")
    summed = running(marks, [F.desc("depth"), F.asc_nulls_first("x1")], F.sum, {"n_leaves": F.col("leaves"), "saved_tokens": F.col("saved")}, downwards=True)
    subtree = staged(summed.where("x1 is not null").groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")), "top-sums")
    top = top.join(subtree, NODE).select(*NODE, "p1", "p2", F.lit(True).alias("hangs"), F.col("owner").alias("conv_id"), nothing.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")

    # parents of shards and top nodes are in the top, or are the root
    all_of = sums.unionByName(top)
    hang = all_of.where("hangs").drop("parent_conv_id").join(above, under).withColumn("parent_conv_id", F.col("parent_owner"))
    out = ["x1", "x2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole = values.agg(F.coalesce(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    base = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"), "conv_id", F.lit(0).cast("long").alias("depth"), nothing.alias("parent_conv_id"), "n_convs",
        F.coalesce(count.where("d0 = 0").select("n_children").scalar(), F.lit(0)).alias("n_children"),
        whole.select("n_leaves").scalar().alias("n_leaves"), whole.select("saved_tokens").scalar().alias("saved_tokens"),
    )
    every = all_of.where("not hangs").select(*out).unionByName(hang.select(*out)).unionByName(base.select(*out))
    empty = hashlib.sha256(b"").hexdigest()
    return every.join(staged(_ends(convs, paths), "ends"), ["x1", "x2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
