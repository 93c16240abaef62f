"""Events as JSON lines, read by the library's own source as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..sources import lines, table

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props struct<k: long>"


def _written(spark: SparkSession, d: str, root: str) -> str:
    """The events as JSON lines, with their properties as an object."""
    e = table(spark, d, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).withColumn("props", F.from_json("props", "k long"))
    e.select(F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value", "props")).alias("value")).write.text(f"{root}/lines")
    return f"{root}/lines"


def lines_batch(spark: SparkSession, d: str) -> DataFrame:
    """Purchases of more than 50 by user; the reader itself leaves out other lines."""
    own = lines.opened(spark, _written(spark, d, Scratch(spark, "lines").root), SCHEMA, [("event_type", "=", "purchase"), ("value", ">", 50)])
    return own.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("most"), F.sum("props.k").alias("k"), F.min("ts").alias("first"))


def lines_stream(spark: SparkSession, d: str) -> DataFrame:
    """All events, by a stream of the same lines."""
    root = Scratch(spark, "lines").root
    e = lines.opened(spark, _written(spark, d, root), SCHEMA, stream=True)
    out = e.select("event_id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("k"))
    out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


QUERIES = {f.__name__: f for f in (lines_batch, lines_stream)}
ORACLE = {
    "lines_batch": """SELECT user_id, count(*) AS n, max(value) AS most, sum((props->>'k')::BIGINT)::BIGINT AS k, min(ts) AS first
FROM events WHERE event_type = 'purchase' AND value > 50 GROUP BY user_id""",
    "lines_stream": "SELECT event_id, ts, user_id, event_type, value, (props->>'k')::BIGINT AS k FROM events",
}
