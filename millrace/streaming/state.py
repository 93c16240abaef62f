"""Custom state that expires: map state and timers in event time, and state with a time to live.

Both functions need the RocksDB state store, which ``on_rocksdb`` sets for the
queries that start within it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# the processors travel to the workers, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def on_rocksdb(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def _millis(us: int) -> int:
    """The first millisecond at or after a time in microseconds."""
    return -(-us // 1000)


def merged(spans: list[list], gap: int) -> list[list]:
    """[start, end, n, value, purchases] entries, in one where less than or just `gap` lies between them."""
    out: list[list] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1] + gap:
            last = out[-1]
            out[-1] = [last[0], max(last[1], s[1]), last[2] + s[2], last[3] + s[3], last[4] + s[4]]
        else:
            out.append(list(s))
    return out


TOTALS = "user_id long, start timestamp, end timestamp, n long, value double, purchases long"
OPEN = "user array<long>, start array<long>, end array<long>, n array<long>, value array<double>, purchases array<long>"


class GapTotals(StatefulProcessor):
    """Totals of users between gaps: the open spans of a group of users in one value, and a timer for the first of them to be over.

    Rows may come in any order within the watermark's delay: a span may grow at
    either end and meet another one. It is returned, and its state removed, once the
    watermark is past its end by the gap, so a user who stays away holds no state.
    Each key and each call to the state store costs a round trip between Python and
    the JVM, milliseconds that would add up over users and spans; here they are a few
    a group and batch. A group holds the spans of its users that the delay and a batch leave open.
    """

    def __init__(self, gap_us: int):
        self.gap = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _over(self, span: list) -> int:
        return _millis(span[1] + self.gap)

    def _held(self) -> dict[int | None, list[list]]:
        out: dict[int | None, list[list]] = {}
        for user, *span in zip(*(self.open.get() or ())):
            out.setdefault(user, []).append(span)
        return out

    def _hold(self, spans: dict[int | None, list[list]], was: int | None) -> None:
        """Keeps the spans of users, with a timer for the first to be over in place of that at `was`."""
        flat = [(user, *s) for user, own in spans.items() for s in own]
        at = min((self._over(s) for own in spans.values() for s in own), default=None)
        if flat:
            self.open.update(tuple(map(list, zip(*flat))))
        else:
            self.open.clear()
        if was != at:
            if was is not None:
                self.handle.deleteTimer(was)
            if at is not None:
                self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        spans = self._held()
        was = min((self._over(s) for own in spans.values() for s in own), default=None)
        for part in rows:
            us = part["ts"].astype("datetime64[us]").astype("int64")
            new: dict[int | None, list[list]] = {}
            for user, known, t, v, p in zip(part["user_id"].tolist(), part["known"].tolist(), us.tolist(), part["value"].fillna(0.0).tolist(), (part["event_type"] == "purchase").tolist()):
                new.setdefault(user if known else None, []).append([t, t, 1, v, int(p)])
            # a batch of rows is merged before the next one is read
            for user, own in new.items():
                spans[user] = merged(spans.get(user, []) + own, self.gap)
        self._hold(spans, was)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        past = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        over, rest = [], {}
        for user, own in self._held().items():
            over += [(user, *s) for s in own if self._over(s) <= past]
            if left := [s for s in own if self._over(s) > past]:
                rest[user] = left
        self._hold(rest, None)  # Spark removes the timer that has expired
        yield _totals(over)


def _totals(spans: list[tuple]) -> pd.DataFrame:
    """TOTALS rows."""
    users, starts, ends, n, value, purchases = list(zip(*spans)) or [()] * 6
    at = lambda c: pd.to_datetime(pd.Series(c, dtype="int64"), unit="us", utc=True)
    return pd.DataFrame(
        {
            "user_id": pd.Series(users, dtype="Int64"),
            "start": at(starts),
            "end": at(ends),
            "n": pd.Series(n, dtype="int64"),
            "value": pd.Series(value, dtype="float64"),
            "purchases": pd.Series(purchases, dtype="int64"),
        }
    )


def gap_totals(events: DataFrame, gap: str = "2 hours", delay: str = "1 hour", groups: int = 4096) -> DataFrame:
    """TOTALS rows of each user's spans of events without a longer gap, each once it is over.

    Rows without a user are one user's; rows without a time are dropped, as are rows that come
    after the watermark; missing values add nothing. Users are dealt by a hash to `groups`, each
    of which has one piece of state; a checkpoint goes with their number.
    """
    us = int(pd.Timedelta(gap).total_seconds() * 1_000_000)
    # users stay whole numbers in pandas, which has none beside nulls
    user = [F.coalesce("user_id", F.lit(0)).cast("long").alias("user_id"), F.col("user_id").isNotNull().alias("known")]
    rows = events.select(*user, "ts", "event_type", "value", F.pmod(F.xxhash64("user_id"), F.lit(groups)).alias("_group")).filter("ts is not null").withWatermark("ts", delay)
    return rows.groupBy("_group").transformWithStateInPandas(GapTotals(us), TOTALS, "append", "EventTime")


class FirstSeen(StatefulProcessor):
    """Lets a user's kind of event through once for each time to live."""

    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "event_type string", "event_id long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        for part in rows:
            new = []
            for kind, i in zip(part["event_type"], part["event_id"]):
                if not self.seen.containsKey((kind,)):
                    self.seen.updateValue((kind,), (int(i),))
                    new.append((key[0], kind, int(i)))
            yield pd.DataFrame(new, columns=["user_id", "event_type", "event_id"])


def first_seen(events: DataFrame, ttl: str = "1 hour") -> DataFrame:
    """(user_id, event_type, event_id): the first event of a kind of a user since the state of the last one expired.

    The time to live is in processing time, so what is let through depends on when
    rows arrive; state is bounded by the users and kinds of that time.
    """
    ms = int(pd.Timedelta(ttl).total_seconds() * 1000)
    rows = events.select("user_id", "event_type", "event_id")
    return rows.groupBy("user_id").transformWithStateInPandas(FirstSeen(ms), "user_id long, event_type string, event_id long", "append", "ProcessingTime")
