"""Streams over the tables, run until all their rows are read; what they wrote is the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming
from ..scratch import Scratch
from ..sources import table
from ..streaming import joins, sink, state


#: Files of a batch whose watermark must not pass rows of files not read yet: a table's files are in no order of time.
ALL = 2**31 - 1


def _events(spark: SparkSession, d: str, files_per_batch: int = 1) -> DataFrame:
    # a glob, as a stream's path must be a folder or a pattern
    return streaming.event_stream(spark, f"{d}/events.parque[t]", table(spark, d, "events").schema, files_per_batch)


def gap_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of each user's spans of events that ended two hours before the last watermark."""
    scratch = Scratch(spark, "stream")
    path, schema = f"{scratch.root}/out", "user_id long, start timestamp, end timestamp, n long, value double, purchases long"
    with state.on_rocksdb(spark):
        out = state.gap_totals(_events(spark, d, ALL))
        out.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{scratch.root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(schema).parquet(path)
    return found.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n", F.round("value", 6).alias("value"), "purchases")


def answered(spark: SparkSession, d: str) -> DataFrame:
    """Purchases with the views before them, and those without one that can get none any more."""
    scratch = Scratch(spark, "stream")
    path = f"{scratch.root}/out"
    out = joins.answered(_events(spark, d, ALL))
    out.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{scratch.root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, user_id long, view_id long").parquet(path)


def exactly_once(spark: SparkSession, d: str) -> DataFrame:
    """What a sink by batch and kind of event holds of all events."""
    scratch = Scratch(spark, "stream")
    rows = _events(spark, d).select("event_id", "value", "event_type")
    rows.writeStream.foreachBatch(sink.exactly_once(f"{scratch.root}/out", ["event_type"])).option("checkpointLocation", f"{scratch.root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return sink.written(spark, f"{scratch.root}/out", rows.schema).select("event_type", "event_id", "value")


QUERIES = {f.__name__: f for f in (gap_totals, answered, exactly_once)}
ORACLE = {
    "gap_totals": """
WITH e AS (SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 2 HOUR, true)::INTEGER AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS span FROM e)
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS n, round(sum(value), 6) AS value, count(*) FILTER (event_type = 'purchase') AS purchases
FROM s GROUP BY user_id, span HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "answered": """
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS view_id, user_id AS viewer, ts AS seen FROM events WHERE event_type = 'view'),
b AS (SELECT event_id, user_id, ts, view_id FROM p LEFT JOIN v ON viewer = user_id AND seen <= ts AND seen >= ts - INTERVAL 1 HOUR),
-- the watermark is that of the side that is behind
w AS (SELECT least((SELECT max(ts) FROM p), (SELECT max(seen) FROM v)) - INTERVAL 1 HOUR AS past)
SELECT event_id, user_id, view_id FROM b, w WHERE view_id IS NOT NULL OR ts < past""",
    "exactly_once": "SELECT event_type, event_id, value FROM events",
}
