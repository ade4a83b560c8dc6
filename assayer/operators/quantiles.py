"""Exact percentiles and order statistics per group without collecting a group.

``percentile()`` keeps every distinct value of a group in one aggregation buffer. Here the values are counted once and the
counts settled. A group of many distinct values is cut into bars of equal counts; the bar that holds the wanted rank is the
only one that is ordered. The result is the exact order statistic, whatever the distribution.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.operators.bars import STEPS, chunks_by_count
from assayer.session import settle

BAR_VALUES = 65_536


def order_statistics(df: DataFrame, keys: list[str], value: str, ranks: Column, values: int = BAR_VALUES, steps: int = STEPS) -> DataFrame:
    """(keys, n, pos, v): the ``pos``-th smallest value (0-based) for each position in ``ranks``.

    ``ranks`` is an array expression over the group size ``n``. NULL and NaN are no readings and are left out; an infinity
    is a value. The input is read once. A task orders one bar: up to ``values`` distinct values, or one in 4^steps of them.
    """
    v = F.col(value).cast("double")
    base = df.select(*keys, v.alias("__v")).where(v.isNotNull() & ~F.isnan(v))
    if not keys:
        base, keys = base.withColumn("__all", F.lit(1)), ["__all"]
    counts = settle(base.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c")), "counts")
    placed = chunks_by_count(counts, keys, "__v", "__bar", values, steps)
    by_bar = Window.partitionBy(*keys).orderBy("__bar").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    hist = placed.groupBy(*keys, "__bar").agg(F.sum("__c").alias("__h"))
    hist = hist.withColumns({"__before": F.coalesce(F.sum("__h").over(by_bar), F.lit(0)), "n": F.sum("__h").over(whole)})
    wanted = F.filter(F.array_distinct(ranks), lambda p: (p >= F.col("__before")) & (p < F.col("__before") + F.col("__h")))
    hits = hist.withColumn("__pos", wanted).where(F.size("__pos") > 0).drop("__h")
    inside = Window.partitionBy(*keys, "__bar").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    cum = placed.join(hits, [*keys, "__bar"]).withColumn("__cum", F.col("__before") + F.sum("__c").over(inside))
    here = F.filter("__pos", lambda p: (p >= F.col("__cum") - F.col("__c")) & (p < F.col("__cum")))
    return cum.select(*keys, "n", F.explode(here).alias("pos"), F.col("__v").alias("v"))


def percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], values: int = BAR_VALUES, steps: int = STEPS) -> DataFrame:
    """One row per group: ``n`` and one column per name in ``probs``, linearly interpolated between neighbours."""
    n = F.col("n")

    def low(p: float) -> Column:
        return F.floor(F.lit(p) * (n - 1)).cast("bigint")

    def high(p: float) -> Column:
        return F.ceil(F.lit(p) * (n - 1)).cast("bigint")

    ranks = F.array(*[f(p) for p in probs.values() for f in (low, high)])
    grouped = [*keys] if keys else ["__all"]
    stats = order_statistics(df, keys, value, ranks, values, steps)
    picks = []
    for name, p in probs.items():
        picks += [F.max(F.when(F.col("pos") == low(p), F.col("v"))).alias(f"__a_{name}"),
                  F.max(F.when(F.col("pos") == high(p), F.col("v"))).alias(f"__b_{name}")]
    wide = stats.groupBy(*grouped, "n").agg(*picks)
    out = [F.col(k) for k in keys] + [n]
    for name, p in probs.items():
        rank = F.lit(p) * (n - 1)
        part = rank - F.floor(rank)
        a, b = F.col(f"__a_{name}"), F.col(f"__b_{name}")
        out.append(F.when((a == b) | (part == 0), a).otherwise(a + (b - a) * part).alias(name))  # infinities have no difference
    return wide.select(*out)


def medians(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per group with ``n`` and the median of several columns (name -> column), from one pass in long form."""
    pairs = F.array(*[F.struct(F.lit(name).alias("__of"), F.col(col).cast("double").alias("__x")) for name, col in columns.items()])
    long = percentiles(df.select(*keys, F.inline(pairs)), [*keys, "__of"], "__x", {"__m": 0.5})
    return long.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("__of") == name, F.col("__m"))).alias(name) for name in columns])


def lower_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """The middle value, the smaller of the two middle ones for an even count."""
    rank = F.array(F.floor((F.col("n") - 1) / 2).cast("bigint"))
    return order_statistics(df, keys, value, rank).select(*keys, "n", F.col("v").alias(name))
