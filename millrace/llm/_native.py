"""Positions of regular-expression matches with Spark functions alone.

Spark returns what matches but not where. The text between the matches is what
``split`` returns, so the two lists give all offsets, in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


#: Values that are summed up one by one; arrays of more are summed in parts.
PART = 256


def _sums(values: Column) -> Column:
    """Running sums; each step copies those before it."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))

    def step(s: Column, x: Column) -> Column:
        at = (s["at"] + x).cast("int")
        return F.struct(at.alias("at"), F.concat(s["sums"], F.array(at)).alias("sums"))

    return F.aggregate(values, state, step, lambda s: s["sums"])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is evaluated, and stands in the plan, once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column) -> Column:
    """Running sums of an array of int, in parts, so that long ones don't take the square of their length."""

    def moved(inside: Column) -> Column:
        until = F.concat(F.array(F.lit(0)), _sums(F.transform(inside, lambda p: F.element_at(p, -1))))
        return F.flatten(F.zip_with(inside, F.slice(until, 1, F.size(inside)), lambda p, base: F.transform(p, lambda x: x + base)))

    def parts(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / PART).cast("int")), lambda i: _sums(F.slice(v, i * PART + 1, PART)))

    return F.when(F.size(values) > 0, _let(values, lambda v: _let(parts(v), moved))).otherwise(F.array().cast("array<int>"))


def gaps(text: Column, pattern: str, found: Column) -> Column:
    """The text before each match in `found`, back to the match before it."""
    return F.slice(F.split(text, pattern, -1), 1, F.size(found))


def offsets(before: Column, found: Column) -> Column:
    """Start of each match in `found`, the list that matches() gave; `before` are its gaps()."""
    ends = running(F.zip_with(before, found, lambda g, h: F.length(g) + F.length(h)))
    return F.zip_with(ends, found, lambda e, h: (e - F.length(h)).cast("int"))


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def ordered(spans: Column, kinds: list[str], start_first: bool) -> Column:
    """Spans sorted by start and kind, or by kind and start; kinds in the order given."""
    order = F.array(*map(F.lit, kinds))

    def key(s: Column) -> Column:
        kind = F.array_position(order, s["kind"]).cast("int").alias("k")
        first = [s["start"].alias("a"), kind] if start_first else [kind, s["start"].alias("a")]
        return F.struct(*first, s["end"].alias("e"), s["kind"].alias("kind"))

    return F.transform(
        F.array_sort(F.transform(spans, key)),
        lambda s: F.struct(s["kind"].alias("kind"), s["a"].alias("start"), s["e"].alias("end")),
    )
