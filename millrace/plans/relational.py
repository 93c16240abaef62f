"""Relational queries: projections, joins, aggregates, windows, sets and subqueries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import operators
from ..functions import money, timestamp
from ..operators import scans
from ..operators.quantiles import quantiles
from ..sources import table


def filters(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    keep = F.col("c_acctbal").between(100, 5000) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & ~F.col("c_name").like("%7")
    return c.filter(keep | (F.col("c_acctbal") < -900)).select("c_custkey", F.upper("c_mktsegment").alias("segment"), (F.col("c_custkey") % 7).alias("bucket"))


def outer_joins(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    n = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("urgent"))
    s = table(spark, d, "supplier").select((F.col("s_suppkey") * 20).alias("k"), "s_name")
    both = n.join(s, F.col("o_custkey") == F.col("k"), "full")
    return both.select(F.coalesce("o_custkey", "k").alias("key"), "urgent", "s_name")


def semi_join(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity >= 49")
    return table(spark, d, "orders").join(x, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_orderstatus")


def anti_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


def cross_join(spark: SparkSession, d: str) -> DataFrame:
    # both sides are tables of fixed size
    return table(spark, d, "region").select("r_name").crossJoin(table(spark, d, "nation").select("n_name"))


def asof(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    buys = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("seen"), "value")
    return operators.asof_join(buys, views, ["user_id"], "ts", "seen", "value", "last_value")


def range_buckets(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("low"), (F.col("s_acctbal") + 50).alias("high"))
    # counts alone are asked for, and pairs grow with the square of the tables
    return scans.range_counts(c, s, ["s_suppkey"], "c_acctbal", "low", "high").withColumnRenamed("n", "customers")


def statistics(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    out = x.groupBy("l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_quantity").alias("most"),
        F.round(F.stddev("l_quantity"), 6).alias("sd"),
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr"),
        F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey")).alias("dearest"),
    )
    # percentiles would hold a key's distinct values in one task
    med = quantiles(x, ["l_returnflag"], "l_quantity", [0.5]).select("l_returnflag", F.col("q0").alias("med"))
    p90 = quantiles(x, ["l_returnflag"], "l_extendedprice", [0.9]).select("l_returnflag", F.round("q0", 2).alias("p90"))
    return out.join(med, "l_returnflag").join(p90, "l_returnflag")


def rollup(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.rollup("o_orderstatus", "o_orderpriority").agg(money(F.sum("o_totalprice")).alias("total"), F.grouping_id().cast("int").alias("level"))


def cube(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.cube("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("largest"))


def grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.groupingSets([["p_brand"], ["p_type"], []], "p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))


def pivot(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    return o.groupBy("y").pivot("o_orderstatus", ["F", "O", "P"]).count()


def unpivot(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").groupBy("l_returnflag").agg(money(F.sum("l_quantity")).alias("quantity"), money(F.sum("l_tax")).alias("tax"))
    return x.unpivot("l_returnflag", ["quantity", "tax"], "what", "amount")


def string_lists(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("nations"))


def ranks(spark: SparkSession, d: str) -> DataFrame:
    """All ranks within nations, of which there are few, so without a window over one."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    placed = scans.running(c, ["c_nationkey"], [("c_acctbal", False), ("c_custkey", True)])
    known = scans.ranked(placed, ["c_nationkey"], [("c_mktsegment", True)])
    position, size = F.col("position"), F.col("size")
    return known.select(
        "c_custkey",
        position.cast("int").alias("rn"),
        F.col("dense_rank").cast("int").alias("dr"),
        F.col("rank").cast("int").alias("rk"),
        scans.tile(4, position, size).cast("int").alias("quartile"),
        # no two rows tie in balance and key
        F.round(F.when(size > 1, (position - 1) / (size - 1)).otherwise(F.lit(0.0)), 9).alias("pr"),
        F.round(position / size, 9).alias("cd"),
    )


def offsets(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.lag("o_orderkey").over(w).alias("before"),
        F.lead("o_orderkey", 2, -1).over(w).alias("after2"),
        F.first("o_orderkey").over(whole).alias("first"),
        F.nth_value("o_orderkey", 2).over(whole).alias("second"),
    )


def moving_average(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-4, 0)
    return table(spark, d, "events").select("event_id", F.round(F.avg("value").over(w), 6).alias("avg5"))


def trailing_day(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("_millrace_events")
    return spark.sql("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM _millrace_events")


def top_customers(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return operators.top_n(c, ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3)


def top_k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(5).limit(20)


def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    e = operators.sessions(table(spark, d, "events").select("user_id", "ts", "value"), "user_id", "ts", "6 HOURS")
    return e.groupBy("user_id", "session").agg(F.min("ts").alias("start"), F.count(F.lit(1)).alias("n"), money(F.sum("value")).alias("value"))


def hot_keys(spark: SparkSession, d: str) -> DataFrame:
    # counts are partial before the shuffle, so a hot key moves a row a task
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _keys(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = table(spark, d, "lineitem")
    return x.filter("l_quantity > 40").select("l_suppkey", "l_linenumber"), x.filter("l_discount > 0.08").select("l_suppkey", "l_linenumber")


def union_distinct(spark: SparkSession, d: str) -> DataFrame:
    a, b = _keys(spark, d)
    return a.union(b).distinct()


def intersect_all(spark: SparkSession, d: str) -> DataFrame:
    a, b = _keys(spark, d)
    return a.intersectAll(b).groupBy("l_suppkey", "l_linenumber").count().withColumnRenamed("count", "n")


def except_all(spark: SparkSession, d: str) -> DataFrame:
    a, b = _keys(spark, d)
    return a.exceptAll(b).groupBy("l_suppkey", "l_linenumber").count().withColumnRenamed("count", "n")


def intersect_distinct(spark: SparkSession, d: str) -> DataFrame:
    a, b = _keys(spark, d)
    return a.intersect(b)


def except_distinct(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    return x.filter("l_quantity > 40").select("l_partkey").subtract(x.filter("l_discount > 0.08").select("l_partkey"))


def above_average(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    mean = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean"))
    return c.join(mean, "c_nationkey").filter(F.col("c_acctbal") > F.col("mean") + 1000).select("c_custkey")


def correlated_exists(spark: SparkSession, d: str) -> DataFrame:
    for t in ("customer", "orders"):
        table(spark, d, t).createOrReplaceTempView(f"_millrace_{t}")
    return spark.sql("SELECT c_custkey FROM _millrace_customer c WHERE EXISTS (SELECT 1 FROM _millrace_orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 10 * c.c_acctbal + 300000)")


def recursive_cte(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql("WITH RECURSIVE t(n, f) AS (SELECT 1L, 1L UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 15) SELECT n, f FROM t")


def string_functions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id",
        F.length("text").alias("chars"),
        F.octet_length("text").alias("bytes"),
        F.md5("text").alias("md5"),
        F.sha2("text", 256).alias("sha"),
        F.size(F.split(F.trim("text"), r"\s+")).alias("words"),
        F.length(F.regexp_replace("text", "[aeiou]", "")).alias("without_vowels"),
        F.substring("text", 3, 9).alias("part"),
        F.instr("text", "the").alias("the_at"),
        F.reverse(F.substring("text", 1, 5)).alias("backwards"),
        F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("padded"),
    )


def date_functions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.year("o_orderdate").alias("y"),
        F.quarter("o_orderdate").alias("q"),
        F.weekofyear("o_orderdate").alias("w"),
        F.dayofweek("o_orderdate").alias("dow"),
        F.datediff("o_orderdate", timestamp("1995-01-01")).alias("days"),
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"),
        F.last_day("o_orderdate").alias("last"),
        F.add_months(F.to_date("o_orderdate"), 3).alias("later"),
    )


def math_functions(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    x = F.col("c_acctbal")
    return c.select(
        "c_custkey",
        F.round(F.ln(F.abs(x) + 1), 6).alias("ln"),
        F.round(F.sqrt(F.abs(x)), 6).alias("sqrt"),
        F.floor(x).alias("floor"),
        F.ceil(x).alias("ceil"),
        F.sign(x).alias("sign"),
        (F.col("c_custkey") % 13).alias("mod"),
        F.greatest(x, F.lit(0.0)).alias("positive"),
        F.col("c_custkey").bitwiseAND(F.lit(12)).alias("bits"),
    )


def array_functions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    v = F.col("embedding").cast("array<double>")
    return e.select(
        "vec_id",
        F.round(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, b: a + b), 6).alias("norm2"),
        F.size(F.filter(v, lambda x: x > 0)).alias("positive"),
        F.round(F.array_max(v), 6).alias("largest"),
        F.exists(v, lambda x: x > 0.4).alias("spike"),
    )


def explode_words(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "conversations").select("role", F.posexplode(F.split(F.trim("text"), " ")).alias("place", "word"))
    return words.groupBy("role", "place").agg(F.countDistinct("word").alias("words"))


def json_functions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    k = F.from_json("props", "k int")["k"]
    return e.select("event_id", k.alias("k"), F.get_json_object("props", "$.k").alias("text")).filter("k is not null")


def tumbling_batch(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), money(F.sum("value")).alias("value"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "value")


def sliding_batch(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


QUERIES = {
    f.__name__: f
    for f in (
        filters, outer_joins, semi_join, anti_join, cross_join, asof, range_buckets, statistics, rollup, cube, grouping_sets, pivot, unpivot, string_lists, ranks, offsets, moving_average, trailing_day, top_customers, top_k,
        user_sessions, hot_keys, union_distinct, intersect_all, except_all, intersect_distinct, except_distinct, above_average, correlated_exists, recursive_cte, string_functions, date_functions, math_functions, array_functions, explode_words, json_functions, tumbling_batch, sliding_batch,
    )
}

_A = "SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_quantity > 40"
_B = "SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_discount > 0.08::DOUBLE"
ORACLE = {
    "filters": """
SELECT c_custkey, upper(c_mktsegment) AS segment, c_custkey % 7 AS bucket FROM customer
WHERE (c_acctbal BETWEEN 100 AND 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_name NOT LIKE '%7') OR c_acctbal < -900""",
    "outer_joins": """
SELECT coalesce(o_custkey, k) AS key, urgent, s_name FROM (SELECT o_custkey, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
FULL JOIN (SELECT s_suppkey * 20 AS k, s_name FROM supplier) ON o_custkey = k""",
    "semi_join": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49)",
    "anti_join": "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "cross_join": "SELECT r_name, n_name FROM region CROSS JOIN nation",
    "asof": """
SELECT b.event_id, b.user_id, b.ts, v.value AS last_value FROM (SELECT * FROM events WHERE event_type = 'purchase') b
ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'view') v ON b.user_id = v.user_id AND b.ts >= v.ts""",
    "range_buckets": "SELECT s_suppkey, count(*) AS customers FROM customer JOIN supplier ON c_acctbal >= s_acctbal AND c_acctbal < s_acctbal + 50 GROUP BY s_suppkey",
    "statistics": """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(*) FILTER (l_discount > 0.05::DOUBLE) AS discounted, min(l_shipdate) AS first_ship, max(l_quantity) AS most,
  round(stddev(l_quantity), 6) AS sd, round(corr(l_quantity, l_extendedprice), 6) AS corr, median(l_quantity) AS med, round(quantile_cont(l_extendedprice, 0.9), 2) AS p90,
  max_by(l_orderkey, (l_extendedprice, l_orderkey)) AS dearest FROM lineitem GROUP BY l_returnflag""",
    "rollup": "SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total, grouping_id(o_orderstatus, o_orderpriority)::INTEGER AS level FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
    "cube": "SELECT p_brand, p_type, count(*) AS n, max(p_size) AS largest FROM part GROUP BY CUBE (p_brand, p_type)",
    "grouping_sets": "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), ())",
    "pivot": """
SELECT year(o_orderdate)::INTEGER AS y, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS F, nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS O,
  nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS P FROM orders GROUP BY 1""",
    "unpivot": """
SELECT l_returnflag, 'quantity' AS what, round(sum(l_quantity), 2) AS amount FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'tax', round(sum(l_tax), 2) FROM lineitem GROUP BY 1""",
    "string_lists": "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS nations FROM nation GROUP BY n_regionkey",
    "ranks": """
SELECT c_custkey, (row_number() OVER w)::INTEGER AS rn, (dense_rank() OVER s)::INTEGER AS dr, (rank() OVER s)::INTEGER AS rk, (ntile(4) OVER w)::INTEGER AS quartile,
  round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd FROM customer
WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey), s AS (PARTITION BY c_nationkey ORDER BY c_mktsegment)""",
    "offsets": """
SELECT o_orderkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey, 2, -1) OVER w AS after2, first_value(o_orderkey) OVER f AS first, nth_value(o_orderkey, 2) OVER f AS second FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), f AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "moving_average": "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS avg5 FROM events",
    "trailing_day": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM events",
    "top_customers": """
SELECT c_custkey, c_nationkey, c_acctbal, rank FROM (SELECT c_custkey, c_nationkey, c_acctbal,
  (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey))::INTEGER AS rank FROM customer) WHERE rank <= 3""",
    "top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5",
    "user_sessions": """
WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, (sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING))::BIGINT AS session FROM g)
SELECT user_id, session, min(ts) AS start, count(*) AS n, round(sum(value), 2) AS value FROM s GROUP BY 1, 2""",
    "hot_keys": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "union_distinct": f"{_A} UNION {_B}",
    "intersect_all": f"SELECT l_suppkey, l_linenumber, count(*) AS n FROM ({_A} INTERSECT ALL {_B}) GROUP BY 1, 2",
    "except_all": f"SELECT l_suppkey, l_linenumber, count(*) AS n FROM ({_A} EXCEPT ALL {_B}) GROUP BY 1, 2",
    "intersect_distinct": f"{_A} INTERSECT {_B}",
    "except_distinct": "SELECT l_partkey FROM lineitem WHERE l_quantity > 40 EXCEPT SELECT l_partkey FROM lineitem WHERE l_discount > 0.08::DOUBLE",
    "above_average": "SELECT c_custkey FROM customer c WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer x WHERE x.c_nationkey = c.c_nationkey) + 1000",
    "correlated_exists": "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 10 * c.c_acctbal + 300000)",
    "recursive_cte": "WITH RECURSIVE t(n, f) AS (SELECT 1::BIGINT, 1::BIGINT UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 15) SELECT n, f FROM t",
    "string_functions": r"""
SELECT doc_id, length(text)::INTEGER AS chars, strlen(text)::INTEGER AS bytes, md5(text) AS md5, sha256(text) AS sha, len(string_split_regex(trim(text), '\s+'))::INTEGER AS words,
  length(regexp_replace(text, '[aeiou]', '', 'g'))::INTEGER AS without_vowels, substring(text, 3, 9) AS part, instr(text, 'the')::INTEGER AS the_at,
  reverse(substring(text, 1, 5)) AS backwards, lpad(doc_id::VARCHAR, 8, '0') AS padded FROM documents""",
    "date_functions": """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, quarter(o_orderdate)::INTEGER AS q, week(o_orderdate)::INTEGER AS w, (dayofweek(o_orderdate) + 1)::INTEGER AS dow,
  date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::INTEGER AS days, date_trunc('month', o_orderdate)::TIMESTAMP AS month, last_day(o_orderdate) AS last, (o_orderdate::DATE + INTERVAL 3 MONTH)::DATE AS later FROM orders""",
    "math_functions": """
SELECT c_custkey, round(ln(abs(c_acctbal) + 1), 6) AS ln, round(sqrt(abs(c_acctbal)), 6) AS sqrt, floor(c_acctbal)::BIGINT AS floor, ceil(c_acctbal)::BIGINT AS ceil, sign(c_acctbal)::DOUBLE AS sign,
  c_custkey % 13 AS mod, greatest(c_acctbal, 0.0) AS positive, c_custkey & 12 AS bits FROM customer""",
    "array_functions": """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS norm2, len(list_filter(embedding, lambda x: x > 0))::INTEGER AS positive,
  round(list_max(embedding)::DOUBLE, 6) AS largest, len(list_filter(embedding, lambda x: x::DOUBLE > 0.4::DOUBLE)) > 0 AS spike FROM embeddings""",
    "explode_words": """
SELECT role, place::INTEGER AS place, count(DISTINCT word) AS words FROM (SELECT role, unnest(range(0, len(w))) AS place, unnest(w) AS word FROM (SELECT role, string_split(trim(text), ' ') AS w FROM conversations)) GROUP BY 1, 2""",
    "json_functions": "SELECT event_id, (props::JSON ->> '$.k')::INTEGER AS k, props::JSON ->> '$.k' AS text FROM events WHERE props::JSON ->> '$.k' IS NOT NULL",
    "tumbling_batch": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1, 2",
    "sliding_batch": """
SELECT start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start FROM events UNION ALL SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1""",
}
