"""Physical layouts by their plans, stored sketches by their bounds, the sink by its failures, and outer joins of streams."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace import plans, streaming
from millrace.operators import sketches
from millrace.sources import layout
from millrace.streaming import joins, sink

DATA = os.environ.get("MILLRACE_DATA", "/root/testdata/sf0.001")
T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no fixtures here")
def test_bucketed_tables_join_without_an_exchange(spark):
    found = plan(plans.queries()["bucketed_join"](spark, DATA))
    assert "Exchange" not in found and "SortMergeJoin" in found and found.count("Bucketed: true") == 2


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no fixtures here")
def test_partitions_are_pruned_by_what_the_join_finds(spark):
    df = plans.queries()["partition_pruning"](spark, DATA)
    assert "dynamicpruning" in plan(df)
    assert {r.year for r in df.collect()} == {1997, 1998}


def test_layouts_keep_all_rows(spark, tmp_path):
    rows = spark.range(500).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    for out in (layout.bucketed(rows, f"{tmp_path}/b", ["k"], 4), layout.partitioned(rows, f"{tmp_path}/p", ["k"], 3)):
        assert sorted(map(str, out.select("k", "v").collect())) == sorted(str(r) for r in rows.collect())
    assert len(os.listdir(f"{tmp_path}/b")) <= 2 * (4 + 1)  # a file for each bucket, and its checksum


def test_sketches_merge_and_meet(spark):
    df = spark.range(60000).select((F.col("id") % 6).alias("day"), F.when(F.col("id") % 10 > 0, F.col("id") % 20000).alias("user"), (F.col("id") * 7919 % 60000).cast("double").alias("value"))
    days = sketches.stored(df, ["day"], "user", "value")
    all_, one = sketches.merged(days), sketches.merged(days.filter("day = 1")).select(F.col("items").alias("other"))
    r = all_.crossJoin(one).select(sketches.distinct("items").alias("n"), sketches.common("items", "other").alias("both"), sketches.quantile("vals", 0.25).alias("q"), F.col("n").alias("rows")).first()
    users = df.filter("user is not null").agg(F.countDistinct("user")).first()[0]
    some = df.filter("day = 1 and user is not null").agg(F.countDistinct("user")).first()[0]
    assert r.rows == 60000 and abs(r.n - users) <= 0.05 * users and abs(r.both - some) <= 0.05 * users and abs(r.q - 15000) <= 0.02 * 60000
    assert sketches.merged(days.limit(0), ["day"]).count() == 0


def files(spark, tmp_path, *batches):
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/b{len(os.listdir(f'{tmp_path}/in')) if os.path.isdir(f'{tmp_path}/in') else i}")
    return streaming.event_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], SCHEMA).schema)


def event(i, minute, user=1, kind="view"):
    return (i, T0 + timedelta(minutes=minute), user, kind, 1.0)


def test_a_batch_that_failed_is_written_once(spark, tmp_path):
    events = files(spark, tmp_path, [event(k, k) for k in range(20)], [event(k, k, kind="click") for k in range(20, 50)])
    write, tries = sink.exactly_once(f"{tmp_path}/out", ["event_type"]), []

    def fails(batch, batch_id):
        tries.append(batch_id)
        if len(tries) == 1:  # half of the rows, then nothing
            write(batch.filter("event_id % 2 = 0"), batch_id)
            raise RuntimeError("lost")
        write(batch, batch_id)
        if len(tries) == 3:  # all rows, but the offsets are not committed
            raise RuntimeError("lost again")

    def run():
        events.writeStream.foreachBatch(fails).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination(120)

    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert tries == [0, 0, 1, 1]
    got = sink.written(spark, f"{tmp_path}/out", spark.createDataFrame([], SCHEMA).schema)
    assert sorted(r.event_id for r in got.collect()) == list(range(50))
    assert got.filter("event_type = 'click'").count() == 30


def test_unmatched_rows_come_once_no_match_can(spark, tmp_path):
    first = [event(1, 0), event(2, 30, kind="purchase"), event(3, 40, user=2, kind="purchase"), event(4, 200, user=9), event(5, 200, user=9, kind="purchase")]
    # user 2's view is behind the watermark by then
    late = [event(6, 35, user=2), event(7, 201, user=9), event(8, 202, user=9, kind="purchase"), event(9, 203, user=8, kind="purchase")]
    query = lambda events: joins.answered(events, "1 hour", "10 minutes").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination(120)
    query(files(spark, tmp_path, first))
    got = lambda: sorted(((r.event_id, r.view_id) for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=str)
    assert got() == [(2, 1), (3, None), (5, 4)]
    query(files(spark, tmp_path, late))
    assert got() == [(2, 1), (3, None), (5, 4), (8, 4), (8, 7)]


def test_stream_joins_a_table(spark, tmp_path):
    users = spark.createDataFrame([(1, "one")], "id long, name string")
    out = joins.known_users(files(spark, tmp_path, [event(1, 0), event(2, 1, user=5)]), users, "id")
    out.select("event_id", "name").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, "one"), (2, None)]
