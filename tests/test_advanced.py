"""Recursion, overlaps, scans, quantiles and triangles against plain versions, with nulls, ties and hot keys."""

from __future__ import annotations

import random
import statistics
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import intervals, scans
from millrace.operators.graph import triangles, triangles_of_kinds
from millrace.operators.intervals import overlap_join
from millrace.operators.quantiles import quantiles
from millrace.operators.recursion import reachable

T0 = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reachable_is_a_breadth_first_search(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)] + [(3, 3), (None, 4), (5, None), (200, 201)] + [(0, k) for k in range(300, 340)]
    want, level, k = {0: 0}, [0], 0
    while level:
        k += 1
        level = [v for v in dict.fromkeys(b for a, b in edges if a in level and b is not None) if v not in want]
        want |= dict.fromkeys(level, k)
    e = spark.createDataFrame(edges + edges[:5], "src long, dst long")
    start = spark.createDataFrame([(0,), (0,), (None,)], "node long")
    assert {r.node: r.depth for r in reachable(e, start).collect()} == want
    assert reachable(e, start).count() == len(want)
    assert {r.node for r in reachable(e, start, most=1).collect()} == {v for v, d in want.items() if d <= 1}
    assert reachable(e, start.limit(0)).count() == 0
    assert [tuple(r) for r in reachable(e.limit(0), start).collect()] == [(0, 0)]


@pytest.mark.parametrize("kind", ["long", "timestamp_ntz"])
def test_overlap_join_is_a_theta_join(spark, kind):
    rng = random.Random(7)
    make = lambda n, most: [(k, rng.choice(["a", "b", None]), (s := rng.randrange(10**9)), s + int(rng.random() ** 4 * most)) for k in range(n)]
    left, right = make(80, 10**9), make(60, 3 * 10**8)
    left += [(900, "a", 5, 4), (901, "a", None, 7), (902, "a", 7, 7), (903, "a", -(10**9), 3 * 10**9), (903, "a", -(10**9), 3 * 10**9)]
    right += [(800, "a", 7, 7), (801, "b", 0, None), (802, "a", 8, 2**20), (803, "a", 2**20, 2**20 + 1)]
    at = (lambda x: x) if kind == "long" else lambda x: None if x is None else T0 + timedelta(microseconds=x)
    frame = lambda rows: spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in rows], f"id long, a string, b {kind}, be {kind}")
    got = overlap_join(frame(left), frame(right), ["a"], ("b", "be"), ("b", "be"))
    some = lambda x: None not in (x[2], x[3]) and x[2] <= x[3]
    want = [(x[0], y[0]) for x in left for y in right if x[1] and x[1] == y[1] and some(x) and some(y) and x[2] <= y[3] and y[2] <= x[3]]
    assert Counter((r.a.id, r.b.id) for r in got.collect()) == Counter(want) and len(want) > 100
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert overlap_join(frame(left).limit(0), frame(right), ["a"], ("b", "be"), ("b", "be")).count() == 0


def test_long_intervals_have_few_copies(spark):
    spans = spark.range(2000).select(F.col("id"), (F.col("id") * 10**7).alias("s"), (F.col("id") * 10**7 + F.when(F.col("id") == 0, F.lit(2 * 10**10)).otherwise(1000)).alias("e"))
    got = overlap_join(spans, spans, [], ("s", "e"), ("s", "e"))
    rows = got.collect()
    assert len(rows) == 2000 + 2 * 1999
    nodes = got._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    assert "Generate" in nodes


def test_no_side_of_an_overlap_join_is_sent_whole(spark):
    """Spark's estimate of a small table leaves out its copies on the grids."""
    spans = spark.createDataFrame([(k, k * 10, k * 10 + 15) for k in range(50)], "id long, s long, e long")
    got = overlap_join(spans, spans, [], ("s", "e"), ("s", "e"))
    assert got.count() == 50 + 2 * 49
    assert "Broadcast" not in plan(got)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_overlaps_over_many_blocks(spark, monkeypatch, coalesce):
    """Blocks of four to sixteen rows, that cut through equal starts, keys and repeated rows, in one partition and in several."""
    monkeypatch.setattr(intervals, "LEAST", 2)
    monkeypatch.setattr(intervals, "MOST", 4)
    rng = random.Random(23)
    make = lambda n: [(k, rng.choice(["a", "a", "b", "c", None]), (s := rng.choice([50, 400, rng.randrange(1000)])), s + rng.choice([-1, 0, 0, 0, 3, 40, 1000])) for k in range(n)]
    left, right = make(150), make(90)
    left += [(500, "d", 7, 9)] * 12 + [(501, "e", 0, None), (502, "e", -5, 5)]
    frame = lambda rows: spark.createDataFrame(rows, "id long, k string, s long, e long")
    meet = lambda x, y, keyed: None not in (x[3], y[3]) and x[2] <= x[3] and y[2] <= y[3] and (not keyed or x[1] and x[1] == y[1]) and x[2] <= y[3] and y[2] <= x[3]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        for by in (["k"], []):
            want = Counter((x[0], y[0]) for x in left for y in right if meet(x, y, by))
            got = overlap_join(frame(left), frame(right), by, ("s", "e"), ("s", "e"))
            assert Counter((r.a.id, r.b.id) for r in got.collect()) == want and len(want) > 500
            want = Counter(tuple(sorted((x[0], y[0]))) for i, x in enumerate(left) for y in left[:i] if meet(x, y, by))
            found = intervals.overlaps(frame(left), by, ("s", "e")).collect()
            assert Counter(tuple(sorted((r.a.id, r.b.id))) for r in found) == want and len(want) > 500
            assert all(r.a.s <= r.b.s for r in found)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_overlaps_shuffle_few_copies(spark):
    """Lengths of sixteen magnitudes: a short row isn't sent once for each of them."""
    length = F.when(F.col("id") % 50 == 0, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") / 50 % 16 + 20).cast("int"))).otherwise(0)
    spans = spark.range(20_000).select("id", (F.col("id") * 10**7).alias("s"), (F.col("id") * 10**7 + length).alias("e"))
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    before = written()
    assert overlap_join(spans, spans, [], ("s", "e"), ("s", "e")).selectExpr("count(a.id) n", "count(distinct b.id) d").first().d == 20_000
    time.sleep(1)  # the store lags behind
    assert 0 < written() - before < 2 * 20_000 * 120


@pytest.mark.parametrize("kind", ["double", "long"])
def test_range_counts_is_a_counted_theta_join(spark, kind):
    rng = random.Random(11)
    of = float if kind == "double" else int
    points = [of(rng.randrange(-20, 60)) for _ in range(300)] + [of(7)] * 50 + [None]
    ranges = [(rng.choice([1, 2, 3, None]), of(x := rng.randrange(-30, 60)), of(x + rng.randrange(-3, 25))) for _ in range(60)] + [(4, of(900), of(950)), (5, None, of(3)), (6, of(3), None), (7, of(7), of(8)), (7, of(7), of(8))]
    if kind == "double":
        points += [float("nan"), float("inf"), -0.0]
        ranges += [(8, float("-inf"), float("nan")), (9, 0.0, 0.5), (10, -0.5, -0.0), (11, float("nan"), float("nan"))]
    p = spark.createDataFrame([(k, x) for k, x in enumerate(points)], f"id long, x {kind}").repartition(5)
    r = spark.createDataFrame(ranges, f"k long, low {kind}, high {kind}").repartition(3)
    want = p.join(r, (F.col("x") >= F.col("low")) & (F.col("x") < F.col("high"))).groupBy("k").count()
    got = scans.range_counts(p, r, ["k"], "x", "low", "high")
    assert got.columns == ["k", "n"] and got.count() == want.count() > 3
    assert {x.k: x.n for x in got.collect()} == {x.k: x["count"] for x in want.collect()}
    assert scans.range_counts(p.limit(0), r, ["k"], "x", "low", "high").count() == 0


def test_range_counts_forms_no_pairs(spark):
    """A million pairs of one value: each of 1,000 ranges holds all of 1,000 points, and no row is read more than a few times."""
    p, r = spark.range(1000).select(F.lit(5.0).alias("x")), spark.range(1000).select("id", F.lit(5.0).alias("low"), F.lit(6.0).alias("high"))
    got = scans.range_counts(p, r, ["id"], "x", "low", "high")
    assert got.filter("n = 1000").count() == 1000
    assert plan(got).count("Join") <= 1 and "NestedLoop" not in plan(got)


def test_range_buckets_joins_no_points_with_ranges(spark):
    from millrace.plans import relational

    out = relational.range_buckets(spark, "/root/testdata/sf0.001")
    assert "c_acctbal" not in plan(out)  # customers are in a written running sum by then


def test_running_and_ranks(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["x", "x", "x", "y", None]), rng.choice([1, 1, 1, 2, 3, None]), rng.choice([0.5, 2.0, None])) for k in range(300)] + [(300, "z", 1, None)]
    df = spark.createDataFrame(rows, "id long, k string, v int, w double").repartition(6)
    up = lambda r: (r[2] is not None, r[2] or 0, r[0])
    want, ranks = {}, {}
    for key in ("x", "y", "z", None):
        own, total = sorted((r for r in rows if r[1] == key), key=up), None
        values = [r[2] for r in own]
        distinct = sorted(set(values), key=lambda v: (v is not None, v or 0))
        for i, r in enumerate(own):
            total = total if r[3] is None else (total or 0.0) + r[3]
            want[r[0]] = (i + 1, len(own), total)
            first, n = values.index(r[2]), values.count(r[2])
            ranks[r[0]] = (first + 1, distinct.index(r[2]) + 1, round(first / (len(own) - 1), 9) if len(own) > 1 else 0.0, round((first + n) / len(own), 9))
    got = scans.running(df, ["k"], [("v", True), ("id", True)], {"total": F.col("w")})
    assert {r.id: (r.position, r["size"], r.total) for r in got.collect()} == want
    found = scans.ranked(df, ["k"], [("v", True)])
    assert {r.id: (r["rank"], r.dense_rank, round(r.percent_rank, 9), round(r.cume_dist, 9)) for r in found.collect()} == ranks
    assert scans.running(df.limit(0), [], [("v", True)]).count() == 0
    descending = scans.running(df, [], [("v", False), ("id", False)]).collect()
    assert [r.id for r in sorted(descending, key=lambda r: r.position)] == [r[0] for r in sorted(rows, key=up, reverse=True)]


def test_a_group_is_spread_over_tasks(spark):
    df = spark.range(20000).select("id", (F.col("id") * 7919 % 20000).alias("v"))
    out = scans.running(df, [], [("v", True)], {"total": F.col("v")})
    assert out.filter("position <> v + 1 or total <> v * (v + 1) / 2").isEmpty()
    assert "SinglePartition" not in plan(out)
    assert [r.t for r in spark.range(11).select(scans.tile(4, F.col("id") + 1, F.lit(11)).alias("t")).collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4]
    assert [r.t for r in spark.range(2).select(scans.tile(4, F.col("id") + 1, F.lit(2)).alias("t")).collect()] == [1, 2]


@pytest.mark.parametrize("bins", [3, 1024])
def test_quantiles(spark, bins):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1), 7.0, rng.lognormvariate(0, 40)])) for _ in range(400)] + [("c", 1.5), ("d", None), ("e", float("nan")), ("a", float("inf")), ("b", None)] + [("f", -1.7e308), ("f", 1.7e308)]
    at = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = quantiles(spark.createDataFrame(rows, "k string, _v double"), ["k"], "_v", at, bins=bins)
    assert got.columns == ["k", "q0", "q1", "q2", "q3", "q4"]
    values = {k: sorted(v for x, v in rows if x == k and v is not None and abs(v) < float("inf")) for k, _ in rows}
    found = {r.k: r[1:] for r in got.collect()}
    assert found.keys() == values.keys()
    for k, v in values.items():
        if not v:
            assert found[k] == (None,) * 5
            continue
        for q, x in zip(at, found[k]):
            p = q * (len(v) - 1)
            i = int(p)
            want = v[i] if p == i else v[i] + (p - i) * (v[i + 1] - v[i])
            assert x == pytest.approx(want, rel=1e-12)
    assert found["c"] == (1.5,) * 5 and statistics.median(values["a"]) == pytest.approx(found["a"][2])
    assert quantiles(spark.createDataFrame([], "k string, _v double"), ["k"], "_v", at).count() == 0


def test_triangles(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(200)] + [(0, k) for k in range(1, 40)] + [(2, 2), (None, 1), (500, 501)]
    near = {}
    for u, v in edges:
        if u is not None and u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    want = {u: sum(w in near[v] for v in near[u] for w in near[u] if v < w) for u in near}
    e = spark.createDataFrame(edges + [(v, u) for u, v in edges[:50]], "u long, v long")
    assert {r.node: r.n for r in triangles(e).collect()} == want and sum(want.values()) > 0
    assert triangles(e.limit(0)).count() == 0


def test_a_hub_forms_no_pairs(spark):
    """A star of 3,000 edges has no pair of edges to look at."""
    star = spark.range(1, 3001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    out = triangles(star)
    assert out.agg(F.sum("n"), F.count("n")).first()[:] == (0, 3001)


@pytest.mark.parametrize("blocks", [1, 5])
def test_triangles_of_kinds(spark, blocks):
    rng = random.Random(13)
    some = lambda n: rng.choice([None, *range(n)] if rng.random() < 0.2 else range(n))
    rows = [(some(12), some(7), some(15)) for _ in range(150)] + [(0, k % 7, k) for k in range(40)] + [(None, None, None)]
    edge = lambda i, j: {(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None}
    ab, bc, ac = edge(0, 1), edge(1, 2), edge(0, 2)
    want = Counter(x for a, c in ac for b in range(7) if (a, b) in ab and (b, c) in bc for x in ((0, a), (1, b), (2, c)))
    df = spark.createDataFrame(rows, "a long, b long, c long")
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    assert {(r.kind, r.id): r.n for r in triangles_of_kinds(df, blocks).collect()} == want
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    assert triangles_of_kinds(df.limit(0), blocks).count() == 0


def test_open_triangles_become_no_rows(spark, monkeypatch):
    """The plan that counts joins lists in place: ids are exploded after the last exchange before the join."""
    from millrace.scratch import Scratch

    plans, cut = [], Scratch.cut
    monkeypatch.setattr(Scratch, "cut", lambda self, df, *a: plans.append(plan(df)) or cut(self, df, *a))
    triangles_of_kinds(spark.range(50).select((F.col("id") % 5).alias("a"), (F.col("id") % 3).alias("b"), "id").withColumnRenamed("id", "c"), 3)
    (found,) = plans
    join = found[found.index("Join") :]
    assert "ShuffledHashJoin" in found and found.count("Join") == 1
    assert join.index("Generate explode(as") < join.index("Exchange")


def test_trade_triangles_shuffles_no_open_triangles(spark):
    from millrace.plans import advanced

    out = advanced.trade_triangles(spark, "/root/testdata/sf0.001")
    assert "Join" not in plan(out)
