"""Queries in the shape of the public TPC-H benchmark, for the columns there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money, revenue, timestamp
from ..sources import table


def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= timestamp("2001-09-02"))
    return x.groupBy("l_returnflag", "l_linestatus").agg(
        money(F.sum("l_quantity")).alias("sum_qty"),
        money(F.sum("l_extendedprice")).alias("sum_base_price"),
        money(F.sum(revenue())).alias("sum_disc_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"),
    )


def shipping_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < timestamp("1998-03-15"))
    x = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") > timestamp("1998-03-15"))
    joined = x.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("l_orderkey", "o_orderdate").agg(money(F.sum(revenue())).alias("revenue")).orderBy(F.desc("revenue"), "l_orderkey").limit(10)


def local_supplier_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    o = t("orders").filter((F.col("o_orderdate") >= timestamp("1996-01-01")) & (F.col("o_orderdate") < timestamp("1999-01-01")))
    n = t("nation").join(t("region").filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = (
        t("lineitem")
        .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.groupBy("n_name").agg(money(F.sum(revenue())).alias("revenue"))


def revenue_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").filter((F.col("l_shipdate") >= timestamp("1996-01-01")) & (F.col("l_shipdate") < timestamp("1997-01-01")) & F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24))
    return x.agg(money(F.sum(F.col("l_extendedprice") * F.col("l_discount"))).alias("revenue"))


def volume_shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    one = t("nation").select(F.col("n_nationkey").alias("k1"), F.col("n_name").alias("supp_nation"))
    two = t("nation").select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("cust_nation"))
    joined = (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(one, F.col("s_nationkey") == F.col("k1"))
        .join(two, F.col("c_nationkey") == F.col("k2"))
        .filter("(supp_nation = 'NATION_1' and cust_nation = 'NATION_2') or (supp_nation = 'NATION_2' and cust_nation = 'NATION_1')")
    )
    return joined.groupBy("supp_nation", "cust_nation", F.year("l_shipdate").alias("l_year")).agg(money(F.sum(revenue())).alias("revenue"))


def returned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter((F.col("o_orderdate") >= timestamp("1996-10-01")) & (F.col("o_orderdate") < timestamp("1997-10-01")))
    x = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    joined = x.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_custkey", "c_name", "c_acctbal").agg(money(F.sum(revenue())).alias("revenue")).orderBy(F.desc("revenue"), "c_custkey").limit(20)


def promotion_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").filter((F.col("l_shipdate") >= timestamp("1997-01-01")) & (F.col("l_shipdate") < timestamp("1997-07-01")))
    joined = x.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    promo = F.sum(F.when(F.col("p_type").startswith("PROMO"), revenue()).otherwise(0.0))
    return joined.agg(F.round(100 * promo / F.sum(revenue()), 6).alias("promo_revenue"))


def large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("sum_qty")).filter("sum_qty > 300")
    o = table(spark, sf_dir, "orders").join(big, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_name", "c_custkey", "o_orderkey", "o_totalprice", money(F.col("sum_qty")).alias("sum_qty"))


def customer_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'")
    each = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("c_count"))
    return each.groupBy("c_count").agg(F.count(F.lit(1)).alias("custdist"))


QUERIES = {f.__name__: f for f in (pricing_summary, shipping_priority, local_supplier_volume, revenue_forecast, volume_shipping, returned_items, promotion_effect, large_orders, customer_distribution)}

_R = "l_extendedprice * (1 - l_discount)"
ORACLE = {
    "pricing_summary": f"""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
  round(sum({_R}), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY l_returnflag, l_linestatus""",
    "shipping_priority": f"""
SELECT l_orderkey, o_orderdate, round(sum({_R}), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15'
GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, l_orderkey LIMIT 10""",
    "local_supplier_volume": f"""
SELECT n_name, round(sum({_R}), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY n_name""",
    "revenue_forecast": """
SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' AND l_discount BETWEEN 0.05::DOUBLE AND 0.07::DOUBLE AND l_quantity < 24""",
    "volume_shipping": f"""
SELECT a.n_name AS supp_nation, b.n_name AS cust_nation, year(l_shipdate)::INTEGER AS l_year, round(sum({_R}), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation a ON s_nationkey = a.n_nationkey JOIN nation b ON c_nationkey = b.n_nationkey
WHERE (a.n_name = 'NATION_1' AND b.n_name = 'NATION_2') OR (a.n_name = 'NATION_2' AND b.n_name = 'NATION_1') GROUP BY 1, 2, 3""",
    "returned_items": f"""
SELECT c_custkey, c_name, c_acctbal, round(sum({_R}), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND o_orderdate >= TIMESTAMP '1996-10-01' AND o_orderdate < TIMESTAMP '1997-10-01'
GROUP BY c_custkey, c_name, c_acctbal ORDER BY revenue DESC, c_custkey LIMIT 20""",
    "promotion_effect": f"""
SELECT round(100 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN {_R} ELSE 0 END) / sum({_R}), 6) AS promo_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-07-01'""",
    "large_orders": """
SELECT c_name, c_custkey, o_orderkey, o_totalprice, round(q, 2) AS sum_qty FROM customer JOIN orders ON c_custkey = o_custkey
JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 300) ON l_orderkey = o_orderkey""",
    "customer_distribution": """
SELECT c_count, count(*) AS custdist FROM (SELECT c_custkey, count(o_orderkey) AS c_count FROM customer
LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority <> '5-LOW' GROUP BY c_custkey) GROUP BY c_count""",
}
