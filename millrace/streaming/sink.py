"""A file sink that holds each row once, whatever fails."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

BATCH = "batch_id"


def exactly_once(path: str, by: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch that writes a batch below path, by its id and the columns `by`.

    A batch replaces the partitions of its own id and no others. If a batch fails
    half-way, or after its files are there but before its offsets are committed, the restarted
    query runs it again from the same offsets under the same id, and writes over what it left.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH, *(by or [])).parquet(path)

    return write


def written(spark: SparkSession, path: str, schema) -> DataFrame:
    """What the sink has, without the ids of batches; schema is that of the rows."""
    known = StructType(schema.fields).add(BATCH, LongType())
    return spark.read.schema(known).parquet(path).drop(BATCH)
