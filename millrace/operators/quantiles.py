"""Exact quantiles in bounded memory, by counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Bins into which a round cuts what is left of a range.
BINS = 1024


def quantiles(df: DataFrame, by: list[str], value: str, at: list[float], scratch: Scratch | None = None, bins: int = BINS) -> DataFrame:
    """(*by, q0, q1, ...): for each key the quantiles `at`, interpolated between the two nearest ranks.

    Each quantile is one or two ranks. A round counts the values between a rank's
    bounds in `bins` bins, with each bin's least and largest value, and goes on with the
    bin that holds the rank, until its bounds are one value. Counts are summed
    before they are shuffled, so a key's rows never meet, and nothing but counts
    is held: rounds, two to four for spread values, take the place of a buffer.
    A round's bounds are a bin's own least and largest value, which fall into different
    bins of the next, so rounds always end.

    Nulls and non-finite values don't count; a key with no other value has null
    quantiles; null keys are a key.
    """
    scratch = scratch or Scratch(df.sparkSession, "quantiles")
    keys = [f"_k{i}" for i in range(len(by))]
    v = F.col(f"`{value}`").cast("double")
    rows = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)], F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v + F.lit(0.0)).alias("_v"))
    known = scratch.cut(rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "ranges")
    place = [F.lit(float(q)) * (F.col("_n") - 1) for q in at]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in place for f in (F.floor, F.ceil)]))
    todo = scratch.cut(known.filter("_n > 0").select(*keys, "_lo", "_hi", F.explode(ranks).alias("_rank")).withColumn("_skip", F.col("_rank")), "ranks")
    found = [todo.filter("_lo = _hi").select(*keys, "_rank", "_lo")]
    while not (open_ := todo.filter("_lo < _hi")).isEmpty():
        bounds = open_.select(*[F.col(k).alias(f"_o{k}") for k in keys], "_lo", "_hi", "_rank", "_skip")
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_o{k}"))
        # halves, as the difference of two finite numbers may not be one
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        inside = rows.join(bounds, on & F.col("_v").between(F.col("_lo"), F.col("_hi")))
        counts = inside.groupBy(*keys, "_rank", "_skip", F.least(F.floor(share * bins), F.lit(bins - 1)).alias("_bin")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        # at most `bins` rows a key and rank
        up_to = F.sum("_c").over(Window.partitionBy(*keys, "_rank").orderBy("_bin"))
        held = counts.withColumn("_up_to", up_to).filter("_up_to > _skip and _up_to - _c <= _skip")
        todo = scratch.cut(held.select(*keys, "_lo", "_hi", "_rank", (F.col("_skip") - F.col("_up_to") + F.col("_c")).alias("_skip")), "ranks")
        found.append(todo.filter("_lo = _hi").select(*keys, "_rank", "_lo"))
    each = found[0]
    for f in found[1:]:
        each = each.unionAll(f)
    by_rank = each.groupBy(*[F.col(k).alias(f"_o{k}") for k in keys]).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_m"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_o{k}"))
    out = []
    for i, p in enumerate(place):
        low, high = (F.try_element_at("_m", f(p).cast("long")) for f in (F.floor, F.ceil))
        out.append((low + (p - F.floor(p)) * (high - low)).alias(f"q{i}"))
    return known.join(by_rank, on, "left").select(*[F.col(k).alias(c) for k, c in zip(keys, by)], *out)
