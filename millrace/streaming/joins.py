"""Joins of a stream with another one, outer, and with a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import DELAY


def answered(events: DataFrame, within: str = "1 hour", delay: str = DELAY) -> DataFrame:
    """(event_id, user_id, view_id): purchases with the same user's views up to `within` before them, and with null if there is none.

    A purchase without a view comes out once the watermarks of both sides are past
    the times at which one could still arrive, as its state is then evicted; rows
    later than the watermark are dropped, so state is bounded by delay and `within`.
    """
    v = events.filter("event_type = 'view'").select(F.col("user_id").alias("viewer"), F.col("ts").alias("seen"), F.col("event_id").alias("view_id")).withWatermark("seen", delay)
    p = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id").withWatermark("ts", delay)
    near = F.expr(f"viewer = user_id AND seen <= ts AND seen >= ts - INTERVAL {within}")
    return p.join(v, near, "left_outer").select("event_id", "user_id", "view_id")


def known_users(events: DataFrame, users: DataFrame, key: str) -> DataFrame:
    """events with the columns of the table `users` whose `key` is their user, and nulls for unknown ones.

    No state: each batch joins the table as it is when the batch starts.
    """
    return events.join(users, F.col("user_id") == F.col(key), "left_outer")
