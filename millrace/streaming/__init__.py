"""Structured Streaming queries over the event stream.

Each function takes a streaming (or batch) DataFrame of events with `ts` as a
timestamp and returns one; the caller chooses sink, trigger and checkpoint.
State is bounded by the watermark, but for running_totals, which keeps two
numbers of each user for good.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DELAY = "1 hour"


def event_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A stream of the parquet files that arrive in a folder.

    The tables' timestamps have no zone, which watermarks don't take: they
    become timestamps of the session's zone.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", delay: str = DELAY) -> DataFrame:
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type")
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def sliding(events: DataFrame, width: str = "2 hours", slide: str = "1 hour", delay: str = DELAY) -> DataFrame:
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", width, slide).alias("w"))
    return w.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = DELAY) -> DataFrame:
    w = events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return w.agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(events: DataFrame, key: str = "event_id", delay: str = DELAY) -> DataFrame:
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def interval_join(events: DataFrame, within: str = "1 hour", delay: str = DELAY) -> DataFrame:
    """Purchases with the same user's views up to `within` before them."""
    v = events.filter("event_type = 'view'").select(F.col("user_id").alias("viewer"), F.col("ts").alias("seen"), F.col("event_id").alias("view_id")).withWatermark("seen", delay)
    p = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id").withWatermark("ts", delay)
    near = F.expr(f"viewer = user_id AND seen <= ts AND seen >= ts - INTERVAL {within}")
    return p.join(v, near).select("event_id", "view_id", "user_id")


def running_totals(events: DataFrame) -> DataFrame:
    """(user_id, n, value) after each batch that has the user: state of two numbers a user."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, value = state.get if state.exists else (0, 0.0)
        for part in parts:
            n, value = n + len(part), value + float(part["value"].sum())
        state.update((n, value))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "value": [value]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id long, n long, value double", "n long, value double", "update", GroupStateTimeout.NoTimeout)
