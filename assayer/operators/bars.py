"""Bars of nearly equal row counts per group, from a mergeable percentile sketch.

Borders follow ranks and not the value range, so one outlier, an infinity or a burst of rows does not crowd a bar. A sketch
may place borders a little off; a bar is *counted* as the borders below a value, hence always in the order of the values,
and whatever builds on bars is exact. Borders are settled before use: two readings of them must agree.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.session import settle

STEPS = 8  # 2 ** 8 bars a level
ACCURACY = 2048


def borders(df: DataFrame, keys: list[str], value: str, steps: int = STEPS) -> DataFrame:
    """(keys, __borders): 2^steps - 1 ascending borders per group; map-side combined, one small row a group."""
    bars = 2 ** steps
    at = [i / bars for i in range(1, bars)]
    return df.groupBy(*keys).agg(F.percentile_approx(value, at, ACCURACY).alias("__borders"))


def in_bars(df: DataFrame, value: str, name: str, steps: int = STEPS) -> DataFrame:
    """Add ``name``, the number of ``__borders`` below ``value``, by binary search; 0 where a row has no borders."""
    df = df.withColumn(name, F.lit(0))
    for step in (2 ** s for s in reversed(range(steps))):
        below = F.get("__borders", F.col(name) + F.lit(step - 1)) < F.col(value)
        df = df.withColumn(name, F.when(below, F.col(name) + F.lit(step)).otherwise(F.col(name)))
    return df


def chunks_by_count(df: DataFrame, keys: list[str], order: str, name: str = "__part", rows: int = 65_536, steps: int = STEPS,
                    then: str | None = None) -> DataFrame:
    """Add ``name``: a chunk number per key, non-decreasing in ``order``, with chunk borders taken from the row counts.

    Keys are counted, and one of more than ``rows`` rows is cut into 2^steps chunks; chunks still above that are cut once
    more, so a chunk of the hottest key holds about one row in 4^steps. A value that is a border has a chunk of its own. Where
    ``rows`` rows of a key are equal in ``order``, they stay together, or are cut by ``then``, the next column of the order. Only
    crowded keys are sketched, and a level at which nothing is crowded costs its count alone. Both columns are numbers or times;
    NULLs come first.
    """
    at = df.withColumn("__x", F.col(order).cast("double")).withColumns({c: F.lit(0) for c in ("__high", "__low", "__tie")})
    if then:
        at = at.withColumn("__y", F.col(then).cast("double"))
    by = [*keys]
    for column in ("__high", "__low", *(["__tie"] if then else [])):
        marks = [f"__k{i}" for i in range(len(by))]
        renamed = [F.col(k).alias(m) for k, m in zip(by, marks, strict=True)]
        value = "__y" if column == "__tie" else "__x"

        def meets(small: DataFrame, frame: DataFrame = at, pairs: tuple = tuple(zip(by, marks, strict=True))) -> Column:
            """Equality of the keys in which NULL meets NULL."""
            return reduce(lambda a, b: a & b, [frame[k].eqNullSafe(small[m]) for k, m in pairs])

        # Settled, so that its true size is known when Spark chooses how to join the rows with it. The next column may cut only
        # what is equal in the first one.
        full = at.groupBy(*by).agg(F.count("__x").alias("__rows"), F.min("__x").alias("__a"), F.max("__x").alias("__b")).where(F.col("__rows") > rows)
        crowded = settle((full.where("__a = __b") if column == "__tie" else full).select(*renamed), "crowded")
        if crowded.isEmpty():
            break
        cut = settle(borders(at.join(crowded, meets(crowded), "left_semi"), by, value, steps).select(*renamed, "__borders"), "borders")
        at = in_bars(at.drop(column).join(cut, meets(cut), "left"), value, column, steps)
        if column != "__tie":
            own = F.coalesce(F.array_contains("__borders", F.col(value)), F.lit(False)).cast("int")
            at = at.withColumn(column, F.col(column) * F.lit(2) + own)
        at = at.drop("__borders", *marks)
        by = [*by, column]
    wide = F.lit(2 ** (steps + 1))
    number = ((F.col("__high").cast("bigint") * wide + F.col("__low")) * F.lit(2 ** steps) + F.col("__tie")).cast("bigint")
    return at.withColumn(name, number).drop("__x", "__y", "__high", "__low", "__tie")
