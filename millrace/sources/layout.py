"""Tables laid out for later queries: bucketed for joins, partitioned for pruning."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucketed(df: DataFrame, path: str, by: list[str], buckets: int) -> DataFrame:
    """df written to path in buckets by hash, sorted, and read as such: joins and groups by `by` need no exchange.

    Rows are shuffled once, to a task for each bucket, so a bucket is one file. The table is
    registered under a name of its own, as buckets are known to the catalog only.
    """
    spark, name = df.sparkSession, f"millrace_{uuid.uuid4().hex}"
    df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def partitioned(df: DataFrame, path: str, by: list[str], files: int = 1) -> DataFrame:
    """df written to a folder for each value of `by`, in about `files` files each, and read back.

    Rows are spread over `files` tasks a value before the write, not by value alone, so a large one isn't one task's.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files))
    df.withColumn("_salt", salt).repartition(*by, "_salt").drop("_salt").write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.parquet(path)
