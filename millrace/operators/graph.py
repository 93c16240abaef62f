"""Triangles of an undirected graph, and of one between three kinds of nodes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch


def triangles(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, n): the triangles that each node of edges (u, v) is in; nodes in none have 0.

    Edges point to the end of higher degree, of equal ones to the larger node. Then
    no node has more than the square root of twice the number of edges going out, so
    pairs of them are formed at small nodes only and never at a hub; a pair is a
    triangle if an edge joins its ends. Repeated edges and either direction count
    once, loops and null ends are no edges.
    """
    scratch = scratch or Scratch(edges.sparkSession, "triangles")
    own = edges.filter("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    own = scratch.cut(own, "edges")
    degrees = scratch.cut(own.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("d")), "degrees")
    du, dv = degrees.select(F.col("node").alias("u"), F.col("d").alias("du")), degrees.select(F.col("node").alias("v"), F.col("d").alias("dv"))
    up = own.join(du, "u").join(dv, "v")
    turned = F.struct("du", "u") > F.struct("dv", "v")
    out = scratch.cut(up.select(F.when(turned, F.col("v")).otherwise(F.col("u")).alias("low"), F.when(turned, F.col("u")).otherwise(F.col("v")).alias("high"), F.greatest("du", "dv").alias("d")), "out")
    second = out.select("low", F.col("high").alias("other"), F.col("d").alias("od"))
    # the two upper ends in the order in which an edge between them points
    pairs = out.join(second, "low").filter(F.struct("d", "high") < F.struct("od", "other")).select(F.col("low").alias("a"), F.col("high").alias("b"), F.col("other").alias("c"))
    closed = pairs.join(out.select(F.col("low").alias("b"), F.col("high").alias("c")), ["b", "c"])
    counts = closed.select(F.explode(F.array("a", "b", "c")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    return degrees.select("node").join(counts, "node", "left").select("node", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


#: Whether a join shuffles sides again that are partitioned by some of its keys only.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def _joined_in_place(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CO_PARTITION, None)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before) if before else spark.conf.unset(CO_PARTITION)


def triangles_of_kinds(rows: DataFrame, blocks: int, scratch: Scratch | None = None) -> DataFrame:
    """(kind, id, n): the triangles that each a (kind 0), b (1) and c (2) of rows (a, b, c) is in, where there are any.

    Two of a row's three are joined by an edge, so a row is a triangle, and others
    come from edges of different rows. For each edge of an a and a c, the b's of both
    are intersected as lists: no open triangle becomes a row. The a's are dealt to
    `blocks`, and the list of a c goes once to each block that has any of its a's, which
    are told apart there, beside their own lists, which a task of a block holds. A list
    has at most as many ids as there are b's, so b should be the kind with the fewest.
    A row with a null has the edge of its other two.
    """
    scratch = scratch or Scratch(rows.sparkSession, "kinds")
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias("_block")
    apart = 8 * blocks  # so many partitions that few blocks share one
    # rows are moved before they are gathered, as partial lists hold nothing twice and are longer than rows
    mine = rows.filter("a is not null and b is not null").select(block("a"), "a", "b").repartition(apart, "_block").groupBy("_block", "a").agg(F.collect_set("b").alias("own"))
    lists = rows.filter("c is not null").repartition("c").groupBy("c").agg(F.collect_set("b").alias("bs"), F.collect_set("a").alias("as"))
    known = F.array(*[F.lit(k) for k in range(blocks)])
    of = lambda k: F.filter("as", lambda a: F.pmod(F.xxhash64(a), F.lit(blocks)) == k)
    parts = F.filter(F.transform(known, lambda k: F.struct(k.alias("_block"), of(k).alias("as"))), lambda x: F.size(x["as"]) > 0)
    sent = lists.filter("size(bs) > 0").select("c", "bs", F.explode(parts).alias("_p")).select("_p._block", "c", "bs", "_p.as").repartition(apart, "_block")
    met = sent.select("_block", "c", "bs", F.explode("as").alias("a")).join(mine.hint("shuffle_hash"), ["_block", "a"])
    closed = met.select("a", "c", F.array_intersect("own", "bs").alias("bs")).filter("size(bs) > 0")
    one = lambda kind, i, n: F.struct(F.lit(kind).alias("kind"), i.alias("id"), n.cast("long").alias("n"))
    ends = F.array(one(0, F.col("a"), F.size("bs")), one(2, F.col("c"), F.size("bs")))
    each = closed.select(F.explode(F.concat(ends, F.transform("bs", lambda b: one(1, b, F.lit(1))))).alias("e")).select("e.*")
    with _joined_in_place(rows.sparkSession):
        return scratch.cut(each.groupBy("kind", "id").agg(F.sum("n").alias("n")), "counts")
