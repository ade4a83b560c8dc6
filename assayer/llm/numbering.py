"""Places of rows in a global order, without a window over a whole key."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from assayer.session import settle


def same(a: DataFrame, b: DataFrame, keys: list[str], marks: list[str]) -> Column:
    """Equality of key columns in which null meets null."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[m]) for k, m in zip(keys, marks, strict=True)])


def numbered(df: DataFrame, keys: list[str], order: list[Column], place: str = "pos", total: str = "n") -> DataFrame:
    """Add ``place``, from 0, of a row among the rows that share its ``keys`` (nulls too), and ``total``, their number.

    Rows are range-partitioned and sorted by keys and order, and written with a running id. What precedes a partition in its
    key is one count per (key, partition), so a key that holds a third of all rows is numbered by many tasks. ``order`` must
    be total and ``df`` must give the same rows when it is read again; an empty table gives no rows.
    """
    by = [F.col(k).asc_nulls_first() for k in keys] + order
    laid = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    laid = settle(laid.withColumn("_part", F.shiftright("_id", 33)), "ordered")
    counts = laid.groupBy(*keys, "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    key = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    marks = [f"_k{i}" for i in range(len(keys))]
    # One row per key and partition.
    carry = counts.select(*[F.col(k).alias(m) for k, m in zip(keys, marks, strict=True)], F.col("_part").alias("_of"),
                          (F.sum("_rows").over(key.orderBy("_part")) - F.col("_rows") - F.col("_first")).alias("_shift"),
                          F.sum("_rows").over(key).alias(total))
    on = laid["_part"] == carry["_of"]
    joined = laid.join(carry, on & same(laid, carry, keys, marks) if keys else on)
    return joined.select(*df.columns, (F.col("_id") + F.col("_shift")).alias(place), total)
