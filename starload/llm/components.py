"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is a minimum per node and a join, so a node with very many edges is pre-aggregated and its rows can be
split; nothing is collected. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import staged


def _step(e: DataFrame) -> DataFrame:
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    large = both.where("v > u").join(staged(least, "least"), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    large = staged(large, "large-star")
    low = staged(large.groupBy("hi").agg(F.min("lo").alias("m")), "low")
    small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))"), F.sum(F.expr("xxhash64(lo, hi) % 1000003"))).first())


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node with an edge to another; the root is the least node that it can reach."""
    e = staged(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct(), "edges")
    state = _state(e)
    while state[0]:
        e = staged(_step(e), "edges")
        before, state = state, _state(e)
        if before == state:
            break
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
