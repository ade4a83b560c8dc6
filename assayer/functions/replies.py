"""Strict reading of a judge's reply: exactly one JSON object, optionally in a code fence. Variants, no Python."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
FENCED = r"(?s)^```[A-Za-z]*\s*(.*?)\s*```$"
STRING = r'"(?:[^"\\]|\\.)*"'
NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9]+,[0-9]+\))$"


def closings(bare: Column) -> Column:
    """After how many brackets of a text without strings none is open."""
    def step(a: Column, x: Column) -> Column:
        depth = a["depth"] + F.when(x.isin("{", "["), 1).otherwise(-1)
        return F.struct(depth.alias("depth"), (a["closed"] + F.when(depth <= 0, 1).otherwise(0)).alias("closed"))

    brackets = F.filter(F.split(F.regexp_replace(bare, r"[^{}\[\]]", ""), ""), lambda x: x != "")
    return F.aggregate(brackets, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed")), step)["closed"]


def parse_replies(df: DataFrame, text_col: str, axes: tuple[str, ...], lo: float = 1, hi: float = 10) -> DataFrame:
    """Adds the axes as DOUBLE and ``reason``, NULL for an accepted reply.

    Refused: text around the object, a second object, a key twice in one object at any depth, NaN or Infinity, a missing axis, a
    quoted, boolean or null axis, a value out of range. An object may nest others. A null reply is no object.
    """
    raw = F.regexp_replace(F.col(text_col), r"^\s+|\s+$", "")
    body = F.coalesce(F.when(raw.rlike(FENCED), F.regexp_extract(raw, FENCED, 1)).otherwise(raw), F.lit(""))
    d = df.withColumn("__body", body)
    b = F.col("__body")
    d = d.select("*", F.try_parse_json(b).alias("__value"), F.json_object_keys(b).alias("__keys"), F.regexp_replace(b, STRING, '""').alias("__bare"))
    value, keys, bare = F.col("__value"), F.col("__keys"), F.col("__bare")
    # A variant refuses an object that has a key twice; the list of keys doesn't, but takes apostrophes for quotes.
    twin = value.isNull() & keys.isNotNull() & ~bare.contains("'")
    whole = value.isNotNull() & keys.isNotNull() & bare.startswith("{") & bare.endswith("}") & (closings(bare) == 1)
    held = {a: F.try_variant_get(value, f"$['{a}']", "variant") for a in axes}
    number = {a: F.when(F.schema_of_variant(v).rlike(NUMBER), F.try_variant_get(v, "$", "double")) for a, v in held.items()}
    missing, odd, out = F.lit(False), F.lit(False), F.lit(False)
    for a in axes:
        missing = missing | ~F.coalesce(F.array_contains(keys, a), F.lit(False))
        odd = odd | number[a].isNull()
        out = out | ~number[a].between(lo, hi)
    reason = (F.when(F.coalesce(twin, F.lit(False)), "duplicate key").when(~F.coalesce(whole, F.lit(False)), "not one JSON object").when(missing, "missing axis")
              .when(odd, "not a number").when(out, "out of range"))
    d = d.withColumn("reason", reason)
    return d.select("*", *[F.when(F.col("reason").isNull(), number[a]).alias(a) for a in axes]).drop("__body", "__value", "__keys", "__bare")
