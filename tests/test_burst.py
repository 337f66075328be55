import datetime as dt

from starload.operators.burst import burst_flags, burst_flags_scan


def test_burst_golden(spark):
    t0 = dt.datetime(2024, 1, 1)
    times = list(range(70)) + [118, 119, 200]
    rows = [(1, i, t0 + dt.timedelta(seconds=s)) for i, s in enumerate(times)]
    ev = spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp_ntz")
    out = {r.event_id: r.flagged for r in burst_flags(ev, key="user_id", ts="ts", tie="event_id", limit=60, ttl_seconds=60).collect()}
    flagged = sorted(times[i] for i, f in out.items() if f)
    assert flagged == list(range(60, 70)) + [118]
    assert out[times.index(119)] is False and out[times.index(200)] is False


def test_burst_keys_independent(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, k * 100 + i, t0 + dt.timedelta(seconds=i)) for k in (1, 2) for i in range(5)]
    ev = spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp_ntz")
    out = burst_flags(ev, key="user_id", ts="ts", tie="event_id", limit=3, ttl_seconds=60)
    assert sorted(r.event_id for r in out.where("flagged").collect()) == [103, 104, 203, 204]


def test_parallel_equals_scan_with_hot_key(spark):
    from pyspark.sql import functions as F

    # one key holds most calls, dense enough that it never pauses for ttl
    ev = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 11).alias("user_id"),
        F.col("id").alias("event_id"),
        (F.lit(1_700_000_000) + F.col("id") * 7 + (F.col("id") % 5)).cast("timestamp").cast("timestamp_ntz").alias("ts"),
    )
    a = burst_flags(ev, key="user_id", ts="ts", tie="event_id", limit=5, ttl_seconds=120)
    b = burst_flags_scan(ev, key="user_id", ts="ts", tie="event_id", limit=5, ttl_seconds=120).select("user_id", "event_id", "flagged")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.where("flagged").count() > 0


def test_state_is_read_and_written_by_bucket_not_by_call():
    import pandas as pd

    from starload.streaming.burst import RateRule

    class Held:
        def __init__(self):
            self.held, self.trips = {}, 0

        def _trip(self, do):
            self.trips += 1
            return do()

        updateValue = lambda self, k, v: self._trip(lambda: self.held.update({k: v}))
        getValue = lambda self, k: self._trip(lambda: self.held[k])
        containsKey = lambda self, k: self._trip(lambda: k in self.held)
        removeKey = lambda self, k: self._trip(lambda: self.held.pop(k))
        keys = lambda self: self._trip(lambda: list(self.held))
        exists = lambda self: self._trip(lambda: None in self.held)
        get = lambda self: self.getValue(None)
        update = lambda self, v: self.updateValue(None, v)
        clear = lambda self: self._trip(self.held.clear)
        registerTimer = lambda self, ms: self._trip(lambda: None)

    class Handle(Held):
        getMapState = getValueState = lambda self, *a: states.setdefault(a[0], Held())

    class Clock:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    states, handle = {}, Handle()
    rule = RateRule(2, 50_000_000, 1_000_000)
    rule.init(handle)
    calls = [(0, str(i % 100), (i // 100) * 1_000_000, i, True) for i in range(3000)]  # thirty calls of each key, a second apart
    list(rule.handleInputRows((0,), iter([pd.DataFrame(calls)]), Clock(0)))
    out = pd.concat(rule.handleExpiredTimer((0,), Clock(20_000), None))
    assert len(out) == 2000 and out.flagged.sum() == 1800 and set(out._tie) == set(range(2000))
    out = pd.concat(rule.handleExpiredTimer((0,), Clock(200_000), None))
    assert len(out) == 1000 and out.flagged.all()
    assert handle.trips + sum(s.trips for s in states.values()) < 100 and not any(s.held for s in states.values())
