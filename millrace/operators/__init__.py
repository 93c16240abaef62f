"""Joins that Spark has no operator for, composed from those it has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, value: str, name: str) -> DataFrame:
    """left with `name`: the `value` of the last row of right of the same `by` at or before its time.

    One pass: both sides in one sorted sequence for each key, so the cost is a
    sort, however many rows a key has on either side. At equal times a right
    row counts as before a left one; among right rows of one time the largest
    value decides. Null where there is none.
    """
    columns = left.columns
    a = left.select(*by, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.struct(*columns).alias("_row"))
    b = right.select(*by, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"))
    order = Window.partitionBy(*by).orderBy("_t", "_side", F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("_v", F.last("_v", ignorenulls=True).over(order)).filter("_side = 1")
    return out.select("_row.*", F.col("_v").alias(name))


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """points joined with the ranges low <= point < high, as an equi-join on buckets of `width`.

    A range is copied to each bucket it touches; without buckets Spark would
    compare every point with every range.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    p = points.withColumn("_bucket", bucket(point))
    r = ranges.withColumn("_bucket", F.explode(F.sequence(bucket(low), bucket(high))))
    return p.join(r, "_bucket").filter((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("_bucket")


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; Spark cuts groups before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def sessions(df: DataFrame, by: str, time: str, gap: str) -> DataFrame:
    """df with `session`, counted from 1 for each key: a new one after `gap` without a row."""
    w = Window.partitionBy(by).orderBy(time)
    new = F.when(F.lag(time).over(w).isNull() | (F.col(time) > F.lag(time).over(w) + F.expr(f"INTERVAL {gap}")), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def salted_count(df: DataFrame, by: list[str], salts: int = 16) -> DataFrame:
    """Distinct-free counts by key in two steps, for keys too hot for one task."""
    part = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts))).groupBy(*by, "_salt").agg(F.count(F.lit(1)).alias("n"))
    return part.groupBy(*by).agg(F.sum("n").alias("n"))
