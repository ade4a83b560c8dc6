"""Connected components of long-valued nodes by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.session import settle


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.col("b").alias("m")),
                                      F.struct(F.col("b").alias("n"), F.col("a").alias("m")))).alias("x")).select("x.*")


def _large(e: DataFrame) -> DataFrame:
    """Each node tells its larger neighbours the smallest node it knows."""
    two = _both(e)
    least = two.groupBy("n").agg(F.min("m").alias("r")).select("n", F.least("n", "r").alias("r"))
    return two.filter("m > n").join(least, "n").select(F.col("r").alias("a"), F.col("m").alias("b")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours and itself to the smallest of them."""
    least = e.groupBy("b").agg(F.min("a").alias("r"))
    own = least.select(F.col("r").alias("a"), F.col("b"))
    rest = e.join(least, "b").filter("a <> r").select(F.col("r").alias("x"), F.col("a").alias("y"))
    return own.unionByName(rest.select(F.col("x").alias("a"), F.col("y").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the smallest node that can be reached.

    Edges may repeat, point both ways or to themselves; null ends are ignored. Both steps aggregate before they shuffle and
    join on the node, where a hub's edges can be split. Each round is written to the shared folder, so lineage stays short.
    Rounds end when the edge set no longer changes; their number grows with the logarithm of the node count.
    """
    e = settle(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
        if mark == seen or not mark["n"]:
            break
        seen = mark
        e = settle(_small(_large(e)), "links")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
