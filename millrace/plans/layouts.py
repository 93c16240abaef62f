"""Bucketed and partitioned tables, and stored sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import revenue
from ..operators import sketches
from ..scratch import Scratch
from ..sources import layout, table


def bucketed_join(spark: SparkSession, d: str) -> DataFrame:
    """Each order's lines and revenue, from tables in buckets: neither the join nor the groups shuffle."""
    root = Scratch(spark, "buckets").root
    o = layout.bucketed(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), f"{root}/orders", ["o_orderkey"], 8)
    x = layout.bucketed(table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount"), f"{root}/lineitem", ["l_orderkey"], 8)
    both = o.join(x.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return both.groupBy("o_orderkey").agg(F.min("o_orderdate").alias("o_orderdate"), F.count(F.lit(1)).alias("lines"), F.round(F.sum(revenue()), 4).alias("revenue"))


def partition_pruning(spark: SparkSession, d: str) -> DataFrame:
    """Lines shipped in years of certain urgent orders; what other years hold isn't read."""
    x = table(spark, d, "lineitem").select("l_returnflag", "l_quantity", F.year("l_shipdate").alias("year"))
    by_year = layout.partitioned(x, f"{Scratch(spark, 'years').root}/lineitem", ["year"], 2)
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT' and o_orderdate >= timestamp_ntz'1997-03-01' and o_orderdate < timestamp_ntz'1998-07-01'")
    years = urgent.select(F.year("o_orderdate").alias("y")).distinct()
    return by_year.join(F.broadcast(years), F.col("year") == F.col("y")).groupBy("year", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


def sketch_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Exact figures of three ranges of days, and whether what sketches stored by day say of them is within their bounds."""
    scratch = Scratch(spark, "sketches")
    e = table(spark, d, "events").select("user_id", "value", F.dayofmonth("ts").alias("day"))
    days = scratch.cut(sketches.stored(e, ["day"], "user_id", "value"), "days")
    out = None
    for name, low, high in (("early", 1, 10), ("late", 11, 31), ("all", 1, 31)):
        inside = F.col("day").between(low, high)
        own = sketches.merged(days.filter(inside))
        exact = e.filter(inside).agg(F.countDistinct("user_id").alias("users"), F.count("value").alias("n"))
        # where the estimated median stands among the values
        found = own.select(sketches.distinct("items").alias("about"), sketches.quantile("vals", 0.5).alias("median"), F.col("n").alias("stored"))
        rank = e.filter(inside).join(F.broadcast(found.select("median")), F.col("value") <= F.col("median")).agg(F.count(F.lit(1)).alias("rank"))
        row = exact.crossJoin(found).crossJoin(rank)  # of one row each
        row = row.select(
            F.lit(name).alias("range"),
            "users",
            "n",
            (F.col("stored") == F.col("n")).alias("all_rows"),
            (F.abs(F.col("about") - F.col("users")) <= 0.05 * F.col("users")).alias("users_hold"),
            (F.abs(F.col("rank") / F.col("n") - 0.5) <= 0.02).alias("median_holds"),
        )
        out = row if out is None else out.unionAll(row)
    return out


QUERIES = {f.__name__: f for f in (bucketed_join, partition_pruning, sketch_ranges)}
ORACLE = {
    "bucketed_join": "SELECT o_orderkey, min(o_orderdate) AS o_orderdate, count(*) AS lines, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey",
    "partition_pruning": """
SELECT year(l_shipdate)::INTEGER AS year, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
WHERE year(l_shipdate) IN (SELECT year(o_orderdate) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1998-07-01') GROUP BY 1, 2""",
    "sketch_ranges": """
SELECT range, count(DISTINCT user_id) AS users, count(value) AS n, true AS all_rows, true AS users_hold, true AS median_holds
FROM events JOIN (VALUES ('early', 1, 10), ('late', 11, 31), ('all', 1, 31)) r(range, low, high) ON day(ts) BETWEEN low AND high GROUP BY range""",
}
