"""Burst detection on a live event stream (T8, streaming form): the rate rule in event-time order, late calls set apart.

The rule depends on the order of a key's calls, so a call is decided only once the watermark says that no earlier one is
to come. Until then it waits in a buffer, which is state. Every read or write of state is a round trip between Python and the
JVM, and most keys have one call in a slot, so keys share state: they are dealt by hash to ``buckets``, and a bucket keeps the
calls of its keys as chunks, Arrow batches by span of ``SPAN`` time slots. A timer in event time wakes the bucket at the end of
a chunk's first slot; the slots that are over are read span by span, sorted by key and time, decided and removed. Beside the buffer a
bucket keeps its keys' counters with their expiry, which go when they can't matter any more. The round trips so grow with buckets,
spans and micro-batches, not with calls; a task holds one bucket's span and its live counters at a time, so more keys ask for
more buckets.

Spark drops rows behind the watermark before a stateful operator sees them. Here nothing may vanish: every event passes
the watermark as a tick, which moves it and is then left out, and as a call without a time for Spark to judge. A call
whose slot is over, or that has no time, comes out at once with ``late`` true and no flag. Rows without a key only move the
clock; a source that falls silent sends one to have the last calls decided.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from starload import specs

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NO_TIME = -(1 << 60)
SPAN = 8
CALLS = pa.schema([("key", pa.string()), ("us", pa.int64()), ("tie", pa.int64())])
OUTPUT = "_key string, _tie long, flagged boolean, late boolean"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """A query that is started inside keeps its state in RocksDB, as keyed state with timers needs; the session's own setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _pack(calls: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, CALLS) as writer:
        writer.write_table(calls)
    return sink.getvalue().to_pybytes()


def _unpack(chunk: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(chunk)).read_all()


class RateRule(StatefulProcessor):
    """A bucket's calls that wait, in chunks by span of slots of ``slot_us``, and its keys' counters with expiry."""

    def __init__(self, limit: int, ttl_us: int, slot_us: int) -> None:
        self.limit, self.ttl_us, self.slot_us = limit, ttl_us, slot_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.served = handle, None
        self.waiting = handle.getMapState("waiting", "span long, chunk long", "calls binary")
        self.counters = handle.getValueState("counters", "calls binary")

    def _over(self, slot: Any, watermark_ms: int) -> Any:
        return (slot + 1) * self.slot_us <= watermark_ms * 1000

    def _wait(self, span: int, calls: pa.Table) -> None:
        """One more chunk of the span; what waits there already is not read."""
        self.waiting.updateValue((span, uuid.uuid4().int >> 65), (_pack(calls),))
        first = min(calls.column("us").to_numpy()) // self.slot_us
        self.handle.registerTimer(int(-(-(first + 1) * self.slot_us // 1000)))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for part in rows:
            # by position: the columns of a group come under other names
            us, tied = part.iloc[:, 2].to_numpy("int64"), part.iloc[:, 4].to_numpy("bool")
            ties = pa.array(part.iloc[:, 3].to_numpy("int64"), mask=~tied)
            calls = pa.table([pa.array(part.iloc[:, 1], pa.string()), us, ties], schema=CALLS)
            late = self._over(us // self.slot_us, watermark)
            spans = us // (self.slot_us * SPAN)
            for span in np.unique(spans[~late]).tolist():
                self._wait(span, calls.filter(pa.array(~late & (spans == span))))
            if late.any():
                gone = calls.filter(pa.array(late))
                yield self._out(gone, [None] * gone.num_rows, True)

    def _decided(self, calls: pa.Table, counters: dict[str, tuple[int, int]]) -> list[bool]:
        """Flags of calls in order of key and time; counters are brought up to date."""
        flags = []
        for name, t in zip(calls.column("key").to_pylist(), calls.column("us").to_pylist(), strict=True):
            count, expires = counters.get(name, (0, _NO_TIME))
            if t >= expires:
                count = 0
            flags.append(count >= self.limit)
            counters[name] = (count, expires) if flags[-1] else (count + 1, t + self.ttl_us)
        return flags

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.served == (key, watermark):  # the bucket's first timer of this watermark has done all
            return
        self.served = key, watermark
        chunks: dict[int, list[int]] = {}
        for span, chunk in self.waiting.keys():
            if self._over(span * SPAN, watermark):
                chunks.setdefault(span, []).append(chunk)
        held = _unpack(self.counters.get()[0]).to_pydict() if self.counters.exists() else {"key": [], "us": [], "tie": []}
        counters = {k: (count, expires) for k, expires, count in zip(held["key"], held["us"], held["tie"], strict=True)}
        for span in sorted(chunks):  # each call is in one span, so spans in order and calls in order within a span
            calls = pa.concat_tables([_unpack(self.waiting.getValue((span, c))[0]) for c in chunks[span]])
            for c in chunks[span]:
                self.waiting.removeKey((span, c))
            over = self._over(calls.column("us").to_numpy() // self.slot_us, watermark)
            if not over.all():
                self._wait(span, calls.filter(pa.array(~over)))
            if over.any():
                due = calls.filter(pa.array(over)).sort_by([(c, "ascending") for c in CALLS.names])
                yield self._out(due, self._decided(due, counters), False)
        # a call that may still come lies in a slot that is not over, so at most one slot behind the watermark
        live = {k: c for k, c in counters.items() if c[1] + self.slot_us > watermark * 1000}
        if live:
            self.counters.update((_pack(pa.table([list(live), [e for _, e in live.values()], [n for n, _ in live.values()]], schema=CALLS)),))
            self.handle.registerTimer(-(-(max(e for _, e in live.values()) + self.slot_us) // 1000))
        elif held["key"]:
            self.counters.clear()

    @staticmethod
    def _out(calls: pa.Table, flags: list[bool | None], late: bool) -> pd.DataFrame:
        ties = pd.array(calls.column("tie").to_pylist(), dtype="Int64")
        return pd.DataFrame({"_key": calls.column("key").to_pylist(), "_tie": ties, "flagged": pd.array(flags, dtype="boolean"), "late": [late] * len(flags)})

    def close(self) -> None:
        pass


def burst_flags_stream(
    events: DataFrame,
    *,
    key: str,
    ts: str,
    tie: str,
    limit: int = specs.RATE_LIMIT_CALLS,
    ttl_seconds: int = specs.RATE_LIMIT_TTL_SECONDS,
    watermark: str = "10 minutes",
    slot_seconds: float = 10,
    buckets: int = 256,
) -> DataFrame:
    """Every call with ``flagged``, as ``operators.burst.burst_flags`` gives it for all calls that are not late; late ones
    with ``late`` true and a null flag. ``tie`` orders calls of one time.

    Calls are decided ``watermark`` and up to ``slot_seconds`` after their time. ``buckets`` is fixed by the checkpoint. Start the query inside ``keyed_state``."""
    us = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(_NO_TIME))
    copies = F.array(F.lit(True), F.lit(False))
    rows = events.select(F.col(key).cast("string").alias("_key"), us.alias("_us"), F.col(tie).cast("bigint").alias("_tie"), F.explode(copies).alias("_tick"))
    # only a condition on the event time stays above the watermark; another would be pushed below and hide rows from the clock
    tick = F.when(F.col("_tick") | F.col("_key").isNull(), F.timestamp_micros(F.greatest("_us", F.lit(0))))
    calls = rows.select("_key", "_us", "_tie", tick.alias("_clock")).withWatermark("_clock", watermark).where("_clock is null")
    rule = RateRule(int(limit), int(ttl_seconds) * 1_000_000, int(slot_seconds * 1_000_000))
    tied = F.col("_tie").isNotNull()  # a null among numbers would make them floats in pandas
    dealt = calls.select(F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int").alias("_bucket"), "_key", "_us", F.coalesce("_tie", F.lit(0)).alias("_tie"), tied.alias("_tied"))
    out = dealt.groupBy("_bucket").transformWithStateInPandas(rule, OUTPUT, "append", "eventtime")
    return out.select(F.col("_key").alias(key), F.col("_tie").alias(tie), "flagged", "late")
