from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest

from millrace import streaming

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def rows(*times, first=0, kind="view", user=1):
    return [(first + i, T0 + timedelta(minutes=m), user, kind, 1.0) for i, m in enumerate(times)]


@pytest.fixture()
def run(spark, tmp_path):
    def go(batches, query, mode="append"):
        folder = tmp_path / "in"
        for i, b in enumerate(batches):
            # one file a batch, in the order of their times of change
            spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / f"b{i}"))
        stream = streaming.event_stream(spark, str(folder / "*"), spark.createDataFrame([], SCHEMA).schema)
        name = f"q{abs(hash(str(tmp_path)))}"
        q = query(stream).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return [tuple(r) for r in spark.table(name).collect()]

    return go


def test_late_rows_are_dropped_once_the_watermark_is_past(run):
    batches = [rows(0, 10, 70), rows(400, first=10), rows(410, first=15), rows(5, first=20), rows(800, first=30)]
    got = run(batches, streaming.tumbling)
    counts = {(r[0] - T0).total_seconds() / 3600: r[2] for r in got}
    assert counts[0.0] == 2 and counts[1.0] == 1  # the row at minute 5 came too late


def test_sliding_windows_count_each_row_twice(run):
    got = run([rows(0, 30, 90), rows(1000, first=9)], streaming.sliding)
    assert Counter({int((r[0] - T0).total_seconds() // 3600): r[1] for r in got}) == Counter({-1: 2, 0: 3, 1: 1})


def test_sessions_close_after_the_gap(run):
    got = run([rows(0, 20, 45), rows(120, first=5), rows(1000, first=9)], streaming.sessions)
    assert sorted(r[3] for r in got) == [1, 3]


def test_duplicates_within_the_watermark(run):
    assert len(run([rows(0, 1, 2), rows(0, 1, 2, 3)], streaming.deduplicated)) == 4


def test_interval_join(run):
    got = run([rows(0, 30, 100) + rows(61, first=50, kind="purchase")], streaming.interval_join)
    assert [(r[0], r[1]) for r in got] == [(50, 1)]


def test_running_totals(run):
    got = run([rows(0, 1), rows(2, first=5)], streaming.running_totals, "update")
    assert max(r[1] for r in got) == 3
