"""State that expires: by timers in event time, and by a time to live."""

from __future__ import annotations

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace import streaming
from millrace.streaming import state

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def event(i, minute, user=1, kind="view", value=1.0):
    return (i, T0 + timedelta(minutes=minute), user, kind, value)


@pytest.fixture()
def stream(spark, tmp_path):
    """Adds files to a folder, runs the query over what is new from its checkpoint, and returns all rows so far."""
    seen = []

    def go(query, *batches, ends=True):
        for b in batches:
            seen.append(None)
            spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/b{len(seen)}")
        events = streaming.event_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], SCHEMA).schema)
        with state.on_rocksdb(spark):
            out = query(events).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
            q = (out.trigger(availableNow=True) if ends else out).start()
        if ends:
            q.awaitTermination(120)
        else:  # in processing time there is always another batch
            until = time.time() + 60
            while sum(p["numInputRows"] for p in q.recentProgress) < sum(map(len, batches)) and time.time() < until:
                time.sleep(0.2)
            q.stop()
        return spark.read.parquet(f"{tmp_path}/out").collect()

    go.checkpoint = f"{tmp_path}/cp"
    return go


def held(spark, stream):
    return spark.read.format("statestore").option("path", stream.checkpoint).option("stateVarName", "open").load().count()


def spans(rows):
    start = lambda t: round((t.astimezone(timezone.utc).replace(tzinfo=None) - T0).total_seconds() / 60)
    return sorted((r.user_id, start(r.start), start(r.end), r.n, r.value, r.purchases) for r in rows)


def test_state_goes_after_the_gap_and_survives_a_restart(spark, stream):
    query = lambda e: state.gap_totals(e, "30 minutes", "10 minutes")
    assert spans(stream(query, [event(0, 0), event(1, 20, kind="purchase", value=5.0), event(2, 5, user=2)])) == []
    assert held(spark, stream) == 2
    # another run: the first user's span grows, the second one's is over
    assert spans(stream(query, [event(3, 45), event(4, 50, user=3)])) == [(2, 5, 5, 1, 1.0, 0)]
    assert held(spark, stream) == 2
    # both spans are over; a row that comes after the watermark of the batch before is dropped
    got = spans(stream(query, [event(5, 200, user=4)], [event(7, 201, user=4)], [event(6, 60)]))
    assert got == [(1, 0, 45, 3, 7.0, 1), (2, 5, 5, 1, 1.0, 0), (3, 50, 50, 1, 1.0, 0)]
    assert held(spark, stream) == 1


def test_rows_in_any_order_give_the_same_spans(spark, stream):
    rng = random.Random(2)
    rows = [event(i, rng.randrange(900), user=i % 3, kind=rng.choice(["view", "purchase"]), value=float(i % 5)) for i in range(120)]
    rows += [(900, T0, None, None, None)]
    rng.shuffle(rows)
    want = {}
    for user in (0, 1, 2, None):
        own = sorted((int((t - T0).total_seconds() / 60), v or 0.0, k == "purchase") for _, t, u, k, v in rows if u == user)
        found = []
        for t, v, p in own:
            if found and t <= found[-1][1] + 20:
                found[-1] = [found[-1][0], t, found[-1][2] + 1, found[-1][3] + v, found[-1][4] + p]
            else:
                found.append([t, t, 1, v, int(p)])
        want[user] = found
    query = lambda e: state.gap_totals(e, "20 minutes", "2 days")
    got = stream(query, rows[:60], rows[60:], [event(999, 20000, user=9)])
    assert sorted(map(str, spans([r for r in got if r.user_id is not None]))) == sorted(str((u, *s)) for u, found in want.items() if u is not None for s in found)
    assert [r.n for r in got if r.user_id is None] == [1]


def test_many_spans_of_many_users_need_few_calls(spark, stream):
    """A group of users has one piece of state and one timer, however many spans they have open."""
    query = lambda e: state.gap_totals(e, "10 minutes", "20 minutes", groups=2)
    big = 2**60 + 1  # not a float's
    rows = [event(k, 30 * (k % 5), user=big + k // 5) for k in range(60)] + [(60, T0, None, "view", None)]
    # the watermark is just at the end of each one's fourth span and the gap
    got = stream(query, rows)
    assert spans(r for r in got if r.user_id is not None) == [(big + u, 30 * k, 30 * k, 1, 1.0, 0) for u in range(12) for k in range(4)]
    assert [(r.user_id, r.n, r.value) for r in got if r.user_id is None] == [(None, 1, 0.0)]
    assert held(spark, stream) == 2
    assert len(stream(query, [event(61, 1000, user=big)])) == 12 * 5 + 1
    assert held(spark, stream) == 1


def test_a_table_of_several_files_loses_no_row(spark, tmp_path):
    """Files whose times overlap, the latest rows in the first file."""
    from millrace.plans import streams

    rows = spark.createDataFrame([event(k, 200 * k, user=k % 2) for k in range(12)], SCHEMA).withColumn("props", F.lit("{}"))
    for k in (1, 0):
        rows.filter(f"event_id % 2 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert streams.gap_totals(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == 11


def test_a_time_to_live_lets_a_kind_through_again(stream):
    query = lambda e: state.first_seen(e, "3 seconds")
    first = stream(query, [event(0, 0), event(1, 1), event(2, 2, kind="click")], ends=False)
    assert sorted(r.event_id for r in first) == [0, 2]
    time.sleep(4)
    assert sorted(r.event_id for r in stream(query, [event(3, 3), event(4, 4)], ends=False)) == [0, 2, 3]


def test_spans_that_touch_are_one():
    assert state.merged([[10, 20, 1, 1.0, 0], [31, 31, 1, 1.0, 1], [25, 26, 1, 0.5, 0]], 5) == [[10, 31, 3, 2.5, 1]]
