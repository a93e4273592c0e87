"""How many events of a key lie in the seconds up to each: as a stream with keyed state.

An event's count is final when the watermark has passed it: no event before it
can come any more. Until then it waits in its key's state; a timer at the
earliest waiting event wakes the key. Events of the last window's width stay as
times, for the counts of later ones, and go after that, so a key's state is as
large as what came within the watermark's delay and one window. A key that may
hold any part of all events is split into slots of time, as in
:func:`weftline.operators.ledger.sliding_count`: each slot is a key of its own,
and the events of the last window's width of a slot count in the next one too.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.operators.ledger import SLOT_WIDTHS, slotted

#: The state store that keyed state with timers needs.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def store(spark: SparkSession):
    """Runs started within keep their state in the store that they need; the session's own setting comes back."""
    name, kind = STORE
    old = spark.conf.get(name, None)
    spark.conf.set(name, kind)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


class _Count(StatefulProcessor):
    def __init__(self, width: int) -> None:
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, id long, own boolean")
        self.past = handle.getListState("past", "t long")

    def _times(self, state) -> list[tuple]:
        return [tuple(r) for r in state.get()]

    def _wake(self, waiting: list[tuple]) -> None:
        if waiting:
            self.handle.registerTimer(min(t for t, *_ in waiting) // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            new = [(int(t), int(i), bool(o)) for t, i, o in zip(part["t"], part["id"], part["own"])]
            self.waiting.appendList(new)
            self._wake(new)
        yield pd.DataFrame({"id": pd.Series([], dtype="int64"), "in_window": pd.Series([], dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        import numpy as np

        until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self._times(self.waiting))
        final, waiting = [w for w in waiting if w[0] < until], [w for w in waiting if w[0] >= until]
        times = np.array(sorted([t for (t,) in self._times(self.past)] + [t for t, *_ in final]), np.int64)
        own = [(t, i) for t, i, mine in final if mine]
        at = np.array([t for t, _ in own], np.int64)
        counts = np.searchsorted(times, at, "right") - np.searchsorted(times, at - self.width, "right")
        self.waiting.put(waiting) if waiting else self.waiting.clear()
        kept = [(int(t),) for t in times if t > until - self.width]
        if kept and (waiting or until < self._end(key)):
            self.past.put(kept)
        else:
            self.past.clear()
        self._wake(waiting)
        yield pd.DataFrame({"id": pd.Series([i for _, i in own], dtype="int64"), "in_window": pd.Series(counts, dtype="int64")})

    def _end(self, key) -> int:
        """When the slot's last event may be, after which nothing of it is kept."""
        return int(key[1]) + SLOT_WIDTHS * self.width

    def close(self) -> None:
        pass


def sliding_count(events: DataFrame, key: str, ts: str, event_id: str, seconds: int, late: str) -> DataFrame:
    """id, in_window of each event of a stream that is final, in append mode; events that come later than ``late`` after newer ones are left out.

    An event without a time or a key belongs to no window and is left out; one without an id counts and has no row.
    """
    width = seconds * 1_000_000
    timed = events.select(F.col(key).alias("key"), F.col(event_id).cast("long").alias("id"), F.col(ts).cast("timestamp").alias("at")).where("key IS NOT NULL AND at IS NOT NULL").withWatermark("at", late)
    placed = slotted(timed, F.unix_micros("at"), width)
    state = placed.select("key", "slot", "at", "t", F.coalesce("id", F.lit(0)).alias("id"), ((F.col("slot") == F.col("own")) & F.col("id").isNotNull()).alias("own")).groupBy("key", "slot")
    return state.transformWithStateInPandas(statefulProcessor=_Count(width), outputStructType="id long, in_window long", outputMode="Append", timeMode="EventTime")
