"""Python functions of each kind, approximate aggregates and the rest of the scalar functions.

The Python functions take Arrow batches, never single rows. They are defined
inside the queries, so they travel with them to the workers.
"""

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import table


def scalar_udf(spark: SparkSession, d: str) -> DataFrame:
    def digit_sum(x: pd.Series) -> pd.Series:
        return x.map(lambda v: sum(map(int, str(v))))

    return table(spark, d, "orders").select("o_orderkey", F.pandas_udf(digit_sum, "long")("o_orderkey").alias("digits"))


def aggregate_udf(spark: SparkSession, d: str) -> DataFrame:
    def spread(x: pd.Series) -> float:
        return float(x.max() - x.min())

    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.round(F.pandas_udf(spread, "double")("c_acctbal"), 6).alias("spread"))


def table_function(spark: SparkSession, d: str) -> DataFrame:
    class Halvings:
        """n, n // 2, n // 4 and so on, down to 1."""

        def eval(self, n: int):
            step = 0
            while n and n > 0:
                yield step, n
                n, step = n // 2, step + 1

    spark.udtf.register("halvings", F.udtf(Halvings, returnType="step: int, value: long"))
    table(spark, d, "nation").createOrReplaceTempView("_millrace_nation")
    return spark.sql("SELECT n_name, h.step, h.value FROM _millrace_nation, LATERAL halvings(CAST(n_nationkey AS INT)) h")


def grouped_map(spark: SparkSession, d: str) -> DataFrame:
    """Each balance less its nation's mean; for groups that fit in a task, else a window does it."""

    def demeaned(group: pd.DataFrame) -> pd.DataFrame:
        return group.assign(apart=(group["c_acctbal"] - group["c_acctbal"].mean()).round(6))[["c_custkey", "apart"]]

    return table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal").groupBy("c_nationkey").applyInPandas(demeaned, "c_custkey long, apart double")


def arrow_map(spark: SparkSession, d: str) -> DataFrame:
    def named(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pc.binary_join_element_wise(b.column(1), pc.cast(b.column(0), pa.string()), "-")], names=["o_orderkey", "name"])

    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus").mapInArrow(named, "o_orderkey long, name string")


def lateral(spark: SparkSession, d: str) -> DataFrame:
    for t in ("nation", "customer"):
        table(spark, d, t).createOrReplaceTempView(f"_millrace_{t}")
    return spark.sql("SELECT n_name, x.n FROM _millrace_nation n, LATERAL (SELECT count(*) AS n FROM _millrace_customer c WHERE c.c_nationkey = n.n_nationkey AND c.c_acctbal > 5000) x")


def edit_distance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.levenshtein("p_type", F.lit("STANDARD")).alias("distance"))


def url_hosts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").groupBy(F.parse_url("url", F.lit("HOST")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


def distribution(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "customer")
    return x.groupBy("c_mktsegment").agg(F.mode("c_nationkey", deterministic=True).alias("mode"), F.round(F.kurtosis("c_acctbal"), 6).alias("kurtosis"), F.round(F.var_pop("c_acctbal"), 2).alias("variance"))


def approximate(spark: SparkSession, d: str) -> DataFrame:
    """Sketches: a few per cent off, in one pass and bounded memory, so no SQL gives the same."""
    e = table(spark, d, "events")
    return e.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("users"), F.percentile_approx("value", 0.5, 1000).alias("median"))


QUERIES = {f.__name__: f for f in (scalar_udf, aggregate_udf, table_function, grouped_map, arrow_map, lateral, edit_distance, url_hosts, distribution, approximate)}
ORACLE = {
    "scalar_udf": "SELECT o_orderkey, (list_sum(list_transform(string_split(o_orderkey::VARCHAR, ''), lambda c: c::BIGINT)))::BIGINT AS digits FROM orders",
    "aggregate_udf": "SELECT c_nationkey, round(max(c_acctbal) - min(c_acctbal), 6) AS spread FROM customer GROUP BY c_nationkey",
    "table_function": """
WITH RECURSIVE t AS (SELECT n_name, 0 AS step, n_nationkey::BIGINT AS value FROM nation WHERE n_nationkey > 0
UNION ALL SELECT n_name, step + 1, value // 2 FROM t WHERE value // 2 > 0) SELECT n_name, step, value FROM t""",
    "grouped_map": "SELECT c_custkey, round(c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_nationkey), 6) AS apart FROM customer",
    "arrow_map": "SELECT o_orderkey, o_orderstatus || '-' || o_orderkey AS name FROM orders",
    "lateral": "SELECT n_name, (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey AND c.c_acctbal > 5000) AS n FROM nation n",
    "edit_distance": "SELECT p_partkey, levenshtein(p_type, 'STANDARD')::INTEGER AS distance FROM part",
    "url_hosts": "SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, count(*) AS n FROM pages GROUP BY 1",
    "distribution": """
SELECT c_mktsegment, (SELECT c_nationkey FROM customer x WHERE x.c_mktsegment = c.c_mktsegment GROUP BY c_nationkey ORDER BY count(*) DESC, c_nationkey LIMIT 1) AS mode,
  round(kurtosis_pop(c_acctbal), 6) AS kurtosis, round(var_pop(c_acctbal), 2) AS variance FROM customer c GROUP BY c_mktsegment""",
}
