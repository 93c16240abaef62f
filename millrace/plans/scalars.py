"""More joins, aggregates and scalar functions, each over its whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import table


def right_join(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "supplier").filter("s_acctbal > 5000")
    both = rich.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "right")
    return both.groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers"))


def broadcast_hint(spark: SparkSession, d: str) -> DataFrame:
    """nation has 25 rows at any scale."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


def merge_hint(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment").hint("merge")
    return table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"))


def union_all(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"))
    return c.unionAll(s).groupBy("nation", "kind").agg(F.count(F.lit(1)).alias("n"))


def null_tests(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("most")).filter("most > 300000")
    both = table(spark, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left")
    return both.filter(F.col("most").isNull() | F.col("c_mktsegment").ilike("b%")).select(
        "c_custkey", F.col("most").isNotNull().alias("known"), F.col("o_custkey").eqNullSafe(F.lit(None)).alias("none"), F.ifnull("most", F.lit(0.0)).alias("most"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("other")
    )


def patterns(spark: SparkSession, d: str) -> DataFrame:
    numbers = F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))
    return table(spark, d, "documents").select("doc_id", F.size(numbers).alias("numbers"), F.array_join(numbers, ",").alias("all"), F.lower(F.coalesce("source", F.lit("NONE"))).alias("source"))


def arithmetic(spark: SparkSession, d: str) -> DataFrame:
    k, x = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey",
        F.round(x / 7, 6).alias("seventh"),
        ((-k) % 7).alias("negative_rest"),
        F.pmod(-k, F.lit(7)).alias("positive_rest"),
        F.round(F.pow(k % 11, F.lit(3)), 6).alias("cube"),
        F.round(F.exp(x / 10000), 6).alias("exp"),
    )


def skewed(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.groupBy("c_mktsegment").agg(F.round(F.skewness("c_acctbal"), 6).alias("skewness"), F.min_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("poorest"))


def dot_products(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    product = F.zip_with(v, F.reverse(v), lambda a, b: a * b)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(product, F.lit(0.0), lambda a, b: a + b), 6).alias("dot"))


def variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"))


def arrow_udf(spark: SparkSession, d: str) -> DataFrame:
    """A function by value, whose rows come in Arrow batches."""

    def initials(name: str | None) -> str | None:
        return None if name is None else name[:1] + name[-1:]

    return table(spark, d, "customer").select("c_custkey", F.udf(initials, "string", useArrow=True)("c_name").alias("ends"))


def sketch_errors(spark: SparkSession, d: str) -> DataFrame:
    """Whether sketches are within their bounds of the exact figures."""
    e = table(spark, d, "events").groupBy("event_type")
    found = e.agg(
        F.countDistinct("user_id").alias("users"),
        F.approx_count_distinct("user_id", 0.02).alias("approximate"),
        F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 14)).alias("sketch"),
        F.percentile("value", F.array(F.lit(0.48), F.lit(0.52))).alias("exact"),
        F.percentile_approx("value", 0.5, 1000).alias("median"),
    )
    off = lambda c: F.abs(F.col(c) - F.col("users")) <= F.greatest(F.lit(1.0), 0.06 * F.col("users"))
    return found.select("event_type", off("approximate").alias("distinct_near"), off("sketch").alias("sketch_near"), F.col("median").between(F.col("exact")[0], F.col("exact")[1]).alias("median_near"))


QUERIES = {f.__name__: f for f in (right_join, broadcast_hint, merge_hint, union_all, null_tests, patterns, arithmetic, skewed, dot_products, variants, arrow_udf, sketch_errors)}
ORACLE = {
    "right_join": "SELECT n_name, count(s_suppkey) AS suppliers FROM (SELECT * FROM supplier WHERE s_acctbal > 5000) RIGHT JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name",
    "broadcast_hint": "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "merge_hint": "SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment",
    "union_all": """
SELECT nation, kind, count(*) AS n FROM (SELECT c_nationkey AS nation, 'customer' AS kind FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier) GROUP BY nation, kind""",
    "null_tests": """
SELECT c_custkey, most IS NOT NULL AS known, o_custkey IS NOT DISTINCT FROM NULL AS none, coalesce(most, 0) AS most, nullif(c_mktsegment, 'BUILDING') AS other
FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS most FROM orders GROUP BY 1 HAVING max(o_totalprice) > 300000) ON c_custkey = o_custkey
WHERE most IS NULL OR c_mktsegment ILIKE 'b%'""",
    "patterns": """
SELECT doc_id, len(regexp_extract_all(text, '[0-9]+'))::INTEGER AS numbers, array_to_string(regexp_extract_all(text, '[0-9]+'), ',') AS all, lower(coalesce(source, 'NONE')) AS source FROM documents""",
    "arithmetic": """
SELECT c_custkey, round(c_acctbal / 7, 6) AS seventh, (-c_custkey) % 7 AS negative_rest, (((-c_custkey) % 7) + 7) % 7 AS positive_rest, round(pow(c_custkey % 11, 3), 6) AS cube,
  round(exp(c_acctbal / 10000), 6) AS exp FROM customer""",
    "skewed": """
SELECT c_mktsegment, round(avg(pow(c_acctbal - m, 3)) / pow(var_pop(c_acctbal), 1.5), 6) AS skewness, min_by(c_custkey, (c_acctbal, c_custkey)) AS poorest
FROM (SELECT *, avg(c_acctbal) OVER (PARTITION BY c_mktsegment) AS m FROM customer) GROUP BY c_mktsegment""",
    "dot_products": "SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], list_reverse(embedding::DOUBLE[])), 6) AS dot FROM embeddings",
    "variants": "SELECT event_id, (props->>'$.k')::INTEGER AS k FROM events",
    "arrow_udf": "SELECT c_custkey, c_name[1] || c_name[-1] AS ends FROM customer",
    "sketch_errors": "SELECT DISTINCT event_type, true AS distinct_near, true AS sketch_near, true AS median_near FROM events",
}
