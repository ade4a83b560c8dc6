"""Ordered computations that do not put a whole group into one task.

A plain ``Window.partitionBy(key).orderBy(t)`` sorts every row of a key in a single task, which fails when one
key holds a large share of the data. Here each key is cut into *chunks* along its order (a day of a ledger, 8,192
positions of a series, a share of its rows by ``bars.chunks_by_count``). The window runs inside (key, chunk); what other
chunks contribute arrives as one summary row per chunk. Summaries are themselves carried in two levels: spans of 1,024
chunks, then chunks inside a span, so no task orders all chunks of a key either.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 8192
SPAN_CHUNKS = 1024


def chunk_of(position: Column | str, width: int = CHUNK_ROWS) -> Column:
    """Chunk number of an integer position."""
    c = F.col(position) if isinstance(position, str) else position
    return F.floor(c / F.lit(width)).cast("bigint")


def day_of(ts: Column | str) -> Column:
    """Chunk number of a timestamp: its day."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")


def outside(summary: DataFrame, keys: list[str], folds: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Per (keys, __chunk), the folded summaries of all earlier chunks of the key; for ``__first`` those of all later ones.

    Spans of chunks are folded first. What lies outside a span enters it as an edge row before and, where later chunks
    matter, one after its chunks.
    """
    def over(df: DataFrame, part: list[str], order: list[str]) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*order)
        earlier, later = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
        return df.withColumns({k: fold(k).over(later if k == "__first" else earlier) for k, fold in folds.items()})

    chunks = summary.withColumn("__span", F.floor(F.col("__chunk") / F.lit(SPAN_CHUNKS)))
    spans = chunks.groupBy(*keys, "__span").agg(*[fold(k).alias(k) for k, fold in folds.items()])
    edges = over(spans, keys, ["__span"]).withColumn("__edge", F.explode(F.array(*[F.lit(e) for e in ((0, 2) if "__first" in folds else (0,))])))
    both = chunks.withColumn("__edge", F.lit(1)).unionByName(edges, allowMissingColumns=True)
    return over(both, [*keys, "__span"], ["__edge", "__chunk"]).where("__edge = 1").drop("__edge", "__span")


def scan_in_order(df: DataFrame, keys: list[str], order: list[str], chunk: Column, *, row_number: str | None = None,
                  sums: dict[str, Column] | None = None, maxes: dict[str, Column] | None = None,
                  fill: dict[str, Column] | None = None, fill_before: dict[str, Column] | None = None,
                  lag: dict[str, Column] | None = None, lead: dict[str, Column] | None = None) -> DataFrame:
    """Add running columns per ``keys`` in ascending ``order``.

    ``row_number``   1-based position
    ``sums``         inclusive running sum
    ``maxes``        inclusive running maximum
    ``fill``         newest non-null value at or before the row
    ``fill_before``  newest non-null value strictly before the row
    ``lag``/``lead`` value on the neighbouring row

    ``chunk`` has to be non-decreasing in ``order``. Result is exact whatever the chunking.
    """
    sums, maxes, fill, fill_before = sums or {}, maxes or {}, fill or {}, fill_before or {}
    lag, lead = lag or {}, lead or {}
    fills = {**fill, **fill_before}
    values = {**{f"__s_{k}": c for k, c in sums.items()}, **{f"__m_{k}": c for k, c in maxes.items()}, **{f"__f_{k}": c for k, c in fills.items()},
              **{f"__g_{k}": c for k, c in lag.items()}, **{f"__h_{k}": c for k, c in lead.items()}}
    rows = df.select("*", chunk.alias("__chunk"), F.lit(1).alias("__flag"), F.lit(1).cast("bigint").alias("__n"), *[c.alias(k) for k, c in values.items()])

    at = [F.col(o) for o in order]
    aggs = [F.sum("__n").alias("__n")]
    aggs += [F.sum(f"__s_{k}").alias(f"__s_{k}") for k in sums] + [F.max(f"__m_{k}").alias(f"__m_{k}") for k in maxes]
    aggs += [F.max(F.when(F.col(f"__f_{k}").isNotNull(), F.struct(*at, F.col(f"__f_{k}").alias("__v")))).alias(f"__f_{k}") for k in fills]
    if lag:
        aggs.append(F.max(F.struct(*at, *[f"__g_{k}" for k in lag])).alias("__last"))
    if lead:
        aggs.append(F.min(F.struct(*at, *[f"__h_{k}" for k in lead])).alias("__first"))
    summary = rows.groupBy(*keys, "__chunk").agg(*aggs)

    folds = {"__n": F.sum, **{f"__s_{k}": F.sum for k in sums}, **{f"__m_{k}": F.max for k in maxes}, **{f"__f_{k}": F.max for k in fills},
             **({"__last": F.max} if lag else {}), **({"__first": F.min} if lead else {})}
    around = outside(summary, keys, folds)
    carried = [F.col(k) for k in folds if k[:4] != "__f_" and k not in ("__last", "__first")]
    carried += [F.col(f"__f_{k}")["__v"].alias(f"__f_{k}") for k in fills]
    carried += [F.col("__last")[f"__g_{k}"].alias(f"__g_{k}") for k in lag]
    carried += [F.col("__first")[f"__h_{k}"].alias(f"__h_{k}") for k in lead]
    # What other chunks contribute joins a chunk as rows of its own, one before its first row and, for ``lead``, one
    # after its last. The window then needs no join: one shuffle and one sort of the rows.
    carry = around.select(*keys, "__chunk", *carried)
    carry = carry.withColumn("__flag", F.explode(F.array(F.lit(0), F.lit(2)))) if lead else carry.withColumn("__flag", F.lit(0))
    both = rows.unionByName(carry, allowMissingColumns=True)

    inside = Window.partitionBy(*keys, "__chunk").orderBy("__flag", *order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    new: list[Column] = []
    if row_number:
        new.append(F.sum("__n").over(upto).cast("bigint").alias(row_number))
    new += [F.coalesce(F.sum(f"__s_{k}").over(upto), F.lit(0)).alias(k) for k in sums]
    new += [F.max(f"__m_{k}").over(upto).alias(k) for k in maxes]
    new += [F.last(f"__f_{k}", True).over(upto).alias(k) for k in fill]
    new += [F.last(f"__f_{k}", True).over(before).alias(k) for k in fill_before]
    new += [F.lag(f"__g_{k}").over(inside).alias(k) for k in lag]
    new += [F.lead(f"__h_{k}").over(inside).alias(k) for k in lead]
    return both.select(*[F.col(c) for c in df.columns], "__flag", *new).where("__flag = 1").drop("__flag")


def with_halo(df: DataFrame, position: str, before: int, after: int, width: int = CHUNK_ROWS) -> DataFrame:
    """Copy rows near a chunk border into the neighbouring chunk.

    Adds ``__chunk`` and ``__own``. Windows over (key, __chunk) with a frame of at most ``before`` rows back and
    ``after`` forward are then complete for rows where ``__own`` is true; the copies are dropped afterwards.
    """
    p, w = F.col(position), F.lit(width)
    first = F.floor((p - F.lit(after)) / w).cast("bigint")
    last = F.floor((p + F.lit(before)) / w).cast("bigint")
    return (df.withColumn("__chunk", F.explode(F.sequence(first, last)))
            .withColumn("__own", F.col("__chunk") == chunk_of(position, width)))


def halo_window(keys: list[str], position: str):
    return Window.partitionBy(*keys, "__chunk").orderBy(position)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where("__own").drop("__chunk", "__own")


def dense_index(df: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """Distinct values of ``column`` numbered 0..n-1 in the order of (md5, value).

    Ordering by a digest spreads any kind of id evenly over 4,096 chunks, so the global numbering never sorts
    the values in one task; only 4,096 chunk counts are.
    """
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    ids = ids.withColumn("__d", F.md5(F.col(column).cast("string")))
    chunk = F.conv(F.substring("__d", 1, 3), 16, 10).cast("bigint")
    out = scan_in_order(ids, [], ["__d", column], chunk, row_number="__rn")
    return out.select(column, (F.col("__rn") - 1).alias(name))


def islands(df: DataFrame, keys: list[str], order: list[str], chunk: Column, starts: Column) -> DataFrame:
    """Number the islands of a key: ``island`` grows by one on each row where ``starts`` is true."""
    flag = starts.cast("bigint")
    return scan_in_order(df, keys, order, chunk, sums={"island": flag})


__all__ = ["CHUNK_ROWS", "chunk_of", "day_of", "dense_index", "drop_halo", "halo_window", "islands", "outside", "scan_in_order",
           "with_halo"]
