"""Positions, running sums and ranks in an order, without a window over a whole group.

A window without a partition, or one over a hot key, is a single task. Here rows
are range partitioned by key and order; what lies before a partition is added up
from one row a partition, and the rest is local to partitions. So a group may
have any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

Order = list[tuple[str, bool]]  # (column, whether ascending)


def _sorted(by: list[str], order: Order) -> list[Column]:
    """Nulls first where ascending, last where descending, as Spark has it."""
    return [*[F.col(c).asc() for c in by], *[F.col(c).asc() if up else F.col(c).desc() for c, up in order]]


def running(df: DataFrame, by: list[str], order: Order, sums: dict[str, Column] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """df with `position`, from 1, `size` of its group, and each sum over the rows up to its own.

    Rows that tie in the order follow by a hash of all their columns. Null keys
    are a group. Nulls add nothing; a sum is null until a value comes. Without
    `by` all rows are one group. Sums of doubles are added by partition, so
    their last digits may differ from a sequential sum's.
    """
    scratch, sums = scratch or Scratch(df.sparkSession, "scan"), sums or {}
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.withColumns({"_tie": tie, **{f"_s{i}": c for i, c in enumerate(sums.values())}})
    keys = [*_sorted(by, order), F.col("_tie").asc()]
    placed = scratch.cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "placed").withColumn("_part", F.shiftright("_at", 33))
    parts = [f"_s{i}" for i in range(len(sums))]
    counts = placed.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in parts])
    # a row for each partition and key
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.cut(
        counts.select(*by, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"), F.sum("_n").over(group).alias("size"), *[F.sum(c).over(before).alias(f"{c}b") for c in parts]),
        "starts",
    )
    own = placed.join(starts.withColumnsRenamed({"_part": "_p", **{c: f"_b{i}" for i, c in enumerate(by)}}), _on(by) & (F.col("_part") == F.col("_p")))
    local = Window.partitionBy(*by, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    out = own.withColumn("position", F.col("_at") + F.col("_shift"))
    for name, c in zip(sums, parts):
        mine = F.sum(c).over(local)
        out = out.withColumn(name, F.when(mine.isNull() & F.col(f"{c}b").isNull(), None).otherwise(F.coalesce(mine, F.lit(0)) + F.coalesce(f"{c}b", F.lit(0))))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "position", "size", *sums)


def _on(by: list[str]) -> Column:
    out = F.lit(True)
    for i, c in enumerate(by):
        out = out & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    return out


def ranked(df: DataFrame, by: list[str], order: Order, scratch: Scratch | None = None) -> DataFrame:
    """df with `rank`, `dense_rank`, `percent_rank` and `cume_dist` of each row within `by`.

    Rows that tie are counted first, so a value that very many rows share is one
    row of the scan; ranks are joined back to rows by key and value, whose skewed
    side Spark splits.
    """
    scratch = scratch or Scratch(df.sparkSession, "ranks")
    columns = [*by, *[c for c, _ in order]]
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_count"))
    up_to = running(counts, by, order, {"_up_to": F.col("_count")}, scratch)
    totals = up_to.groupBy(*by).agg(F.max("_up_to").alias("_total"))
    named = up_to.withColumnsRenamed({c: f"_b{i}" for i, c in enumerate(columns)})
    tops = totals.withColumnsRenamed({c: f"_t{i}" for i, c in enumerate(by)})
    of = F.lit(True)
    for i in range(len(by)):
        of = of & F.col(f"_b{i}").eqNullSafe(F.col(f"_t{i}"))
    known = scratch.cut(named.join(tops, of).select(*[f"_b{i}" for i in range(len(columns))], F.col("position").alias("_dense"), "_count", "_up_to", "_total"), "ranks")
    rank = F.col("_up_to") - F.col("_count") + 1
    percent = F.when(F.col("_total") > 1, (rank - 1) / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    out = df.join(known, _on(columns))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], rank.alias("rank"), F.col("_dense").alias("dense_rank"), percent.alias("percent_rank"), (F.col("_up_to") / F.col("_total")).alias("cume_dist"))


def range_counts(points: DataFrame, ranges: DataFrame, by: list[str], point: str, low: str, high: str, scratch: Scratch | None = None) -> DataFrame:
    """(by, n): how many pairs of a range and a point low <= point < high each key of ranges has; keys without any are left out.

    No pair is formed: a range's number is that of the points before its high end
    less that of those before its low one, and both come from one running sum over
    points and ends, so the cost is a sort, however many points a range holds.
    Points of one value are counted first. Null points and ends pair with nothing;
    null keys are a group.
    """
    scratch = scratch or Scratch(points.sparkSession, "counts")
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]
    none = [F.lit(None).cast(ranges.schema[c].dataType).alias(f"_k{i}") for i, c in enumerate(by)]
    held = points.groupBy(F.col(point).alias("_x")).agg(F.count(F.lit(1)).alias("_n")).filter("_x is not null")
    # an end comes before the points of its value
    weighed = held.select(*none, "_x", F.lit(1).alias("_kind"), "_n", F.lit(0).alias("_sign"))
    both = F.explode(F.array(F.struct(F.col(low).alias("_x"), F.lit(-1).alias("_sign")), F.struct(F.col(high).alias("_x"), F.lit(1).alias("_sign"))))
    ends = ranges.filter(F.col(low) < F.col(high)).select(*keys, both.alias("_e")).select(*[f"_k{i}" for i in range(len(by))], "_e._x", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_n"), "_e._sign")
    before = running(weighed.unionByName(ends), [], [("_x", True), ("_kind", True)], {"_before": F.col("_n")}, scratch)
    found = before.filter("_kind = 0").groupBy(*[f"_k{i}" for i in range(len(by))]).agg(F.sum(F.col("_sign") * F.col("_before")).alias("n"))
    return found.filter("n > 0").select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(by)], "n")


def tile(n: int, position: Column, size: Column) -> Column:
    """ntile(n): the first size % n tiles have a row more."""
    small, more = F.floor(size / n), size % n
    long = more * (small + 1)
    return F.when(position <= long, F.floor((position - 1) / (small + 1)) + 1).otherwise(more + F.floor((position - 1 - long) / F.greatest(small, F.lit(1))) + 1)
