"""Order-based building blocks over a global, range-partitioned order (no single-task windows).

``prefix`` computes running sums or maxima in blocks of a fixed number of rows: a window per
block (bounded by the block size, not by the data), plus one row per block for the block bases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 20


def prefix(
    df: DataFrame,
    *,
    position: str,
    value: Column,
    out: str,
    how: str = "sum",
    inclusive: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds ``out`` = running ``how`` ('sum' or 'max') of ``value`` over ``position`` order.

    ``position`` must be dense (0..N-1). Exclusive prefixes leave the row's own value out
    (0 for sums, null for maxima on the first row).
    """
    agg = F.sum if how == "sum" else F.max
    blk = F.floor(F.col(position) / block_rows).cast("bigint")
    base = df.select("*", blk.alias("_blk"), value.alias("_v"))
    frame_end = Window.currentRow if inclusive else -1
    w_in = Window.partitionBy("_blk").orderBy(position).rowsBetween(Window.unboundedPreceding, frame_end)
    inner = base.withColumn("_in", agg("_v").over(w_in))
    totals = base.groupBy("_blk").agg(agg("_v").alias("_tot"))
    # one row per block of ``block_rows`` rows: a bounded table
    w_blocks = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_blk", agg("_tot").over(w_blocks).alias("_base"))
    joined = inner.join(bases, "_blk", "left")
    if how == "sum":
        combined = F.coalesce(F.col("_base"), F.lit(0)) + F.coalesce(F.col("_in"), F.lit(0))
    else:
        combined = F.greatest(F.col("_base"), F.col("_in"))
    return joined.withColumn(out, combined).drop("_blk", "_v", "_in", "_base")
