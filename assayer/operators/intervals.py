"""Interval and nearest joins over time, bucketed so that they stay equi-joins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK = 0.05  # fixed value


def _buckets(lo: Column, hi: Column, width: float) -> Column:
    return F.sequence(F.floor(lo / width).cast("bigint"), F.floor(hi / width).cast("bigint"))


def contained(points: DataFrame, windows: DataFrame, on: list[str], slack: float = SLACK, width: float = 16.0,
              start: str = "start_s", end: str = "end_s", lo: str = "spoken_start", hi: str = "spoken_end") -> DataFrame:
    """Intervals of ``points`` that lie inside a window of the same key, with ``slack`` on both ends.

    A window is copied to the time buckets it touches and an interval goes to the bucket of its start, so each match
    is found once, and one long document spreads over its buckets.
    """
    p = points.withColumn("__b", F.floor(F.col(start) / width).cast("bigint"))
    w = windows.where(F.col(hi) + slack >= F.col(lo) - slack).withColumn(
        "__b", F.explode(_buckets(F.col(lo) - slack, F.col(hi) + slack, width)))
    j = p.join(w, [*on, "__b"])
    return j.where((F.col(start) >= F.col(lo) - slack) & (F.col(end) <= F.col(hi) + slack)).drop("__b")


def overlapping(points: DataFrame, windows: DataFrame, on: list[str], width: float = 16.0, start: str = "start_s", end: str = "end_s",
                lo: str = "cue_start", hi: str = "cue_end") -> DataFrame:
    """Intervals that overlap a window of the same key. Both sides go to every bucket they touch; a pair is kept only
    in the first bucket they share."""
    p = points.where(F.col(end) >= F.col(start)).withColumn("__b", F.explode(_buckets(F.col(start), F.col(end), width)))
    w = windows.where(F.col(hi) >= F.col(lo)).withColumn("__b", F.explode(_buckets(F.col(lo), F.col(hi), width)))
    first = F.greatest(F.floor(F.col(start) / width), F.floor(F.col(lo) / width)).cast("bigint")
    j = p.join(w, [*on, "__b"])
    return j.where((F.col("__b") == first) & (F.col(end) > F.col(lo)) & (F.col(start) < F.col(hi))).drop("__b")


def nearest_sample(named: DataFrame, samples: DataFrame, on: list[str], t: str, sample_t: str, tolerance: float) -> DataFrame:
    """Each named time with the nearest sampled time within ``tolerance``, the earlier on a tie, NULL without one.

    Buckets are as wide as the tolerance, so a named time looks into three of them; samples are made distinct first.
    ``named`` needs a unique combination of ``on`` and ``t``.
    """
    s = samples.select(*on, F.col(sample_t).alias("__s")).distinct().withColumn("__b", F.floor(F.col("__s") / tolerance).cast("bigint"))
    q = named.select(*on, F.col(t).alias("__t")).distinct()
    b = F.floor(F.col("__t") / tolerance).cast("bigint")
    look = q.withColumn("__b", F.explode(F.array(b - 1, b, b + 1)))
    gap = F.abs(F.col("__s") - F.col("__t"))
    best = (look.join(s, [*on, "__b"]).where(gap <= tolerance).groupBy(*on, "__t")
            .agg(F.min(F.struct(gap.alias("g"), F.col("__s").alias("s"))).alias("m")))
    return named.join(best.select(*on, F.col("__t").alias(t), F.col("m.s").alias("sample")), [*on, t], "left")


def in_any_span(points: DataFrame, spans: DataFrame, on: list[str], t: str, lo: str, hi: str, width: float, name: str = "inside") -> DataFrame:
    """Flags points that lie in a span of their key (ends included). Points must be unique in (on, t)."""
    w = spans.where(F.col(hi) >= F.col(lo)).select(*on, F.col(lo).alias("__lo"), F.col(hi).alias("__hi"),
                                                   F.explode(_buckets(F.col(lo), F.col(hi), width)).alias("__b"))
    p = points.select(*on, t).withColumn("__b", F.floor(F.col(t) / width).cast("bigint"))
    hit = p.join(w, [*on, "__b"]).where((F.col(t) >= F.col("__lo")) & (F.col(t) <= F.col("__hi"))).select(*on, t).distinct()
    return points.join(hit.withColumn(name, F.lit(True)), [*on, t], "left").withColumn(name, F.coalesce(name, F.lit(False)))
