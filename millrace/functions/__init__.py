"""Small expressions that several queries share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column) -> Column:
    """A sum of money, rounded so that the order of addition doesn't show."""
    return F.round(amount, 2)


def revenue() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def timestamp(text: str) -> Column:
    """A literal of the tables' own type, a timestamp without a zone."""
    return F.lit(text).cast("timestamp_ntz")
