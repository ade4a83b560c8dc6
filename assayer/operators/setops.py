"""Set operations over ledgers, sources and cohorts."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def backed_edges(*moves: DataFrame) -> DataFrame:
    """Distinct edges any of the move tables takes."""
    return reduce(DataFrame.unionByName, [m.select("src", "dst") for m in moves]).distinct()


def unbacked_edges(edges: DataFrame, stops: DataFrame, backed: DataFrame) -> DataFrame:
    return edges.select("src", "dst").subtract(stops.select("src", "dst")).subtract(backed.select("src", "dst"))


def in_every_group(df: DataFrame, group: str, item: str) -> DataFrame:
    """Items present in every group."""
    pairs = df.select(group, item).distinct()
    groups = pairs.select(group).distinct().agg(F.count(F.lit(1))).scalar()
    return pairs.groupBy(item).agg(F.count(F.lit(1)).alias("groups")).where(F.col("groups") == groups)


def union_ledgers(*parts: DataFrame) -> DataFrame:
    """Rows of all parts; a column one part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def distinct_sources(df: DataFrame, keys: list[str], refs: list[str]) -> DataFrame:
    """Evidence references deduplicated by their JSON with sorted keys."""
    canon = F.to_json(F.struct(*sorted(refs)))
    return df.select(*keys, canon.alias("ref")).distinct()


def cohort_complete(expected: DataFrame, existing: DataFrame, cohort: str, key: str) -> DataFrame:
    """Per cohort: expected keys, how many exist, and whether it can be skipped whole or has to be built whole."""
    have = existing.select(key).distinct().withColumn("__have", F.lit(1))
    g = expected.select(cohort, key).distinct().join(have, key, "left").groupBy(cohort).agg(
        F.count(F.lit(1)).alias("expected"), F.count("__have").alias("existing"))
    return g.withColumn("complete", F.col("expected") == F.col("existing"))


def golden_diff(golden: DataFrame, got: DataFrame) -> DataFrame:
    """Rows on one side only, with multiplicity. One aggregation instead of two exceptAll passes."""
    cols = golden.columns
    tagged = golden.select(*cols, F.lit(1).alias("__w")).unionByName(got.select(*cols, F.lit(-1).alias("__w")))
    g = tagged.groupBy(*cols).agg(F.sum("__w").alias("__n")).where("__n <> 0")
    return g.select(*cols, F.when(F.col("__n") > 0, "missing").otherwise("added").alias("side"), F.abs("__n").alias("copies"))


def only_grew(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of the earlier snapshot the later one lost; empty when the ledger was only appended to."""
    return golden_diff(before, after).where("side = 'missing'").drop("side")


def unseen_flags(raised: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Flags not yet seen in exactly these words."""
    return raised.join(seen.select(*keys).distinct(), keys, "left_anti")
