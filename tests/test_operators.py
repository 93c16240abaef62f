from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace import operators

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_asof_join(spark):
    left = spark.createDataFrame([(1, 1, at(5)), (2, 1, at(0)), (3, 2, at(9)), (4, None, at(9))], "id int, k int, t timestamp_ntz")
    right = spark.createDataFrame([(1, at(5), 10.0), (1, at(4), 7.0), (1, at(5), 11.0), (1, at(6), 99.0)], "k int, s timestamp_ntz, v double")
    out = operators.asof_join(left, right, ["k"], "t", "s", "v", "last")
    assert {r.id: r["last"] for r in out.collect()} == {1: 11.0, 2: None, 3: None, 4: None}
    assert operators.asof_join(left.limit(0), right, ["k"], "t", "s", "v", "last").count() == 0


def test_range_join_matches_a_theta_join(spark):
    points = spark.range(200).select(F.col("id").alias("p"), (F.col("id") * 1.7 - 50).alias("x"))
    ranges = spark.range(20).select(F.col("id").alias("r"), (F.col("id") * 13.0 - 60).alias("low"), (F.col("id") * 13.0 - 60 + F.col("id") * 2).alias("high"))
    got = {(r.p, r.r) for r in operators.range_join(points, ranges, "x", "low", "high", 10.0).collect()}
    want = {(p.p, r.r) for p in points.collect() for r in ranges.collect() if r.low <= p.x < r.high}
    assert got == want and want


def test_range_join_is_no_nested_loop(spark):
    points, ranges = spark.range(10).select(F.col("id").cast("double").alias("x")), spark.range(3).select(F.col("id").cast("double").alias("low"), (F.col("id") + 2.0).alias("high"))
    plan = operators.range_join(points, ranges, "x", "low", "high", 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_top_n_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = operators.top_n(df, ["k"], [F.desc("id")], 2)
    assert sorted((r.k, r.id) for r in out.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_sessions_and_salted_count(spark):
    df = spark.createDataFrame([("a", at(0)), ("a", at(10)), ("a", at(21)), ("b", at(0))], "k string, t timestamp_ntz")
    got = sorted((r.k, r.t, r.session) for r in operators.sessions(df, "k", "t", "10 MINUTES").collect())
    assert [x[2] for x in got] == [1, 1, 2, 1]
    assert {r.k: r.n for r in operators.salted_count(df, ["k"]).collect()} == {"a": 3, "b": 1}
