"""Rate rule re-aimed as burst detection on an event log.

Per key, a counter with a lifetime: at a call at time t the counter is 0 if t ≥ its expiry;
if it has reached ``limit`` the call is flagged (and nothing changes); otherwise the call is
allowed, the counter goes up by one and its expiry becomes t + ttl. Refused calls do not
extend the lifetime, so this is not a session window.

A call that comes ttl or more after the key's previous call always finds the counter expired:
those calls split each key's history into independent bursts. ``burst_flags`` ranks all calls once,
finds these resets by a join on the rank before, the next start of an epoch from any call by a search
in a merged ranking, and marks the starts by pointer doubling; all of it in the JVM and split by rank.
``burst_flags_scan``, a cross-check, runs the rule in one Python pass per burst.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starload import specs


def _scan(limit: int, ttl_us: int):
    """Streaming pass over rows sorted by (key, burst, time, tie); the counter is carried across
    Arrow batches, so memory stays at one batch whatever the size of a burst."""

    def run(batches):
        cur = None
        count = 0
        expires = np.iinfo(np.int64).min
        for pdf in batches:
            k = pdf["_key"].to_numpy()
            b = pdf["_burst"].to_numpy()
            t = pdf["_t"].to_numpy(dtype=np.int64)
            flagged = np.zeros(len(t), dtype=bool)
            for i in range(len(t)):
                group = (k[i], b[i])
                if group != cur:
                    cur, count, expires = group, 0, np.iinfo(np.int64).min
                if t[i] >= expires:
                    count = 0
                if count >= limit:
                    flagged[i] = True
                else:
                    count += 1
                    expires = t[i] + ttl_us
            yield pd.DataFrame({"_key": k, "_tie": pdf["_tie"].to_numpy(), "_burst": b, "flagged": flagged})

    return run


def burst_flags_scan(
    events: DataFrame,
    *,
    key: str,
    ts: str,
    tie: str,
    limit: int = specs.RATE_LIMIT_CALLS,
    ttl_seconds: int = specs.RATE_LIMIT_TTL_SECONDS,
) -> DataFrame:
    """Every event with ``flagged`` and its ``burst`` number within the key.

    Compact form for inputs whose keys and bursts are known to be moderate: bursts come from a
    window per key and each burst is scanned in one pass. ``burst_flags`` is the general form.
    """
    ttl_us = int(ttl_seconds) * 1_000_000
    t_us = F.unix_micros(F.col(ts).cast("timestamp"))
    base = events.select(F.col(key).alias("_key"), t_us.alias("_t"), F.col(tie).alias("_tie"))
    w = Window.partitionBy("_key").orderBy("_t", "_tie")
    gap = F.col("_t") - F.lag("_t").over(w)
    starts = base.withColumn("_start", F.when(gap.isNull() | (gap >= ttl_us), 1).otherwise(0))
    bursts = starts.withColumn("_burst", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    n = max(events.sparkSession.sparkContext.defaultParallelism, 1)
    ordered = bursts.repartition(n, "_key", "_burst").sortWithinPartitions("_key", "_burst", "_t", "_tie")
    schema = f"_key {dict(base.dtypes)['_key']}, _tie {dict(base.dtypes)['_tie']}, _burst bigint, flagged boolean"
    flags = ordered.mapInPandas(_scan(limit, ttl_us), schema)
    return flags.select(
        F.col("_key").alias(key), F.col("_tie").alias(tie), F.col("_burst").alias("burst"), "flagged"
    )


BIG = (1 << 62)


def burst_flags(
    events: DataFrame,
    *,
    key: str,
    ts: str,
    tie: str,
    limit: int = specs.RATE_LIMIT_CALLS,
    ttl_seconds: int = specs.RATE_LIMIT_TTL_SECONDS,
) -> DataFrame:
    """Every event with ``flagged`` (refused by the rule); exact, and no key is ever held by one task.

    All calls get a dense global rank ``g`` by (key, time, tie) from range partitioning. Then:

    1. *Resets*: a call that starts a key, or comes ttl or more after the previous call, always
       finds the counter expired. The ranks of the resets split the order into segments, and
       ``R(i)`` is the start of the next segment.
    2. *Next epoch*: if an epoch (counter from zero) starts at call i, the next one starts at
       ``n(i) = min(R(i), first call at or after t[i+limit-1] + ttl)``. The search is a ranking of
       the calls merged with one search point per i (search points placed before equal times).
    3. *Epoch starts*: the resets, then n(reset), n(n(reset)), … Pointer doubling marks them in
       log2(longest segment, in epochs) rounds of joins on ``g``, checkpointed in between.
    4. A call is flagged when it is ``limit`` or more calls after its epoch start (a running
       maximum of the starts, computed in fixed-size blocks).

    Every join is on unique ranks, so a key holding a third of all rows is spread like any other.
    """
    from starload.operators.loading import positions
    from starload.operators.sequence import prefix
    from starload.session import shared_dir

    spark = events.sparkSession
    shared_dir(spark)
    lim = int(limit)
    ttl_us = int(ttl_seconds) * 1_000_000
    t_us = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = events.select(F.col(key).alias("_key"), t_us.alias("_t"), F.col(tie).alias("_tie"))
    ranked = positions(rows, ["_key", "_t", "_tie"]).withColumnRenamed("_position", "_g").checkpoint()

    # 1. resets and the start of the next segment
    prev = ranked.select((F.col("_g") + 1).alias("_g"), F.col("_key").alias("_pk"), F.col("_t").alias("_pt"))
    r = ranked.join(prev, "_g", "left")
    is_reset = F.col("_pk").isNull() | (F.col("_pk") != F.col("_key")) | ((F.col("_t") - F.col("_pt")) >= ttl_us)
    r = r.select("_g", "_key", "_t", "_tie", is_reset.alias("_reset"))
    r = prefix(r, position="_g", value=F.col("_reset").cast("long"), out="_seg")
    next_start = r.where("_reset").select((F.col("_seg") - 1).alias("_seg"), F.col("_g").alias("_R"))
    r = r.join(next_start, "_seg", "left").withColumn("_R", F.coalesce("_R", F.lit(BIG)))

    # 2. the limit-th call of an epoch starting here, and the search for the next epoch
    jrow = ranked.select((F.col("_g") - (lim - 1)).alias("_g"), F.col("_key").alias("_jk"), F.col("_t").alias("_jt"))
    r = r.join(jrow, "_g", "left")
    has_q = F.col("_jk").isNotNull() & (F.col("_jk") == F.col("_key"))
    queries = r.where(has_q).select("_key", (F.col("_jt") + ttl_us).alias("_t"), F.lit(0).alias("_kind"), F.col("_g").alias("_id"))
    calls = ranked.select("_key", "_t", F.lit(1).alias("_kind"), F.col("_g").alias("_id"))
    merged = positions(queries.unionByName(calls), ["_key", "_t", "_kind", "_id"])
    merged = prefix(merged, position="_position", value=(F.col("_kind") == 0).cast("long"), out="_qb", inclusive=False)
    found = merged.where(F.col("_kind") == 0).select(
        F.col("_id").alias("_g"), (F.col("_position") - F.col("_qb")).alias("_S")
    )
    r = r.join(found, "_g", "left")
    nodes = r.select(
        "_g", "_key", "_tie", "_reset", "_R",
        F.least(F.col("_R"), F.coalesce(F.col("_S"), F.lit(BIG))).alias("_j"),
    ).checkpoint()

    # 3. pointer doubling: level k maps a call to the epoch start 2^k epochs after one starting
    #    there. A pointer that reached its segment's end is final (it can only stay there), so a
    #    level keeps just the pointers still inside their segment: later rounds shrink.
    level = nodes.where(F.col("_j") < F.col("_R")).select("_g", "_R", "_j").checkpoint()
    levels = []
    while level.limit(1).count() > 0:
        levels.append(level)
        hop = level.select(F.col("_g").alias("_j"), F.col("_j").alias("_jj"))
        # a target without an active pointer has already reached the segment end R
        nxt = level.join(hop, "_j", "left").select("_g", "_R", F.coalesce("_jj", F.col("_R")).alias("_j"))
        level = nxt.where(F.col("_j") < F.col("_R")).checkpoint()
    reach = nodes.where("_reset").select("_g", "_R")
    for lvl in levels:
        step = reach.join(lvl.select("_g", "_j"), "_g")
        reach = reach.unionByName(step.select(F.col("_j").alias("_g"), "_R")).checkpoint()

    # 4. epoch start of every call, and the flag
    marked = nodes.join(reach.select("_g", F.lit(True).alias("_start")), "_g", "left")
    marked = prefix(marked, position="_g", value=F.when(F.col("_start"), F.col("_g")), out="_e", how="max")
    return marked.select(
        F.col("_key").alias(key), F.col("_tie").alias(tie), ((F.col("_g") - F.col("_e")) >= lim).alias("flagged")
    )
