"""Row contracts, classification and ranks."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.ordered import scan_in_order


def bounded_rank(df: DataFrame, keys: list[str], value: str, chunk: Column, name: str = "place") -> DataFrame:
    """1 + number of strictly smaller values in the group.

    Values are counted first, then the counts are accumulated chunk-wise; the rows join back on (keys, value).
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    run = scan_in_order(counts, keys, [value], chunk, sums={"__cum": F.col("__c")})
    ranks = run.select(*keys, value, (F.col("__cum") - F.col("__c") + 1).cast("bigint").alias(name))
    return df.join(ranks, [*keys, value])


def row_contract(df: DataFrame, schema_version: str, row_type: str, row_id: str, types: tuple[str, ...], version: int = 1) -> DataFrame:
    """``breach``: the first rule of the row contract a row breaks, NULL when it keeps them all."""
    v, t, i = F.col(schema_version), F.col(row_type), F.col(row_id)
    bad_id = F.coalesce(F.trim(i.cast("string")), F.lit("")) == ""
    return df.withColumn("breach", F.when(~v.eqNullSafe(F.lit(version)) | t.isNull() | ~t.isin(*types), "unsupported ledger row")
                         .when(bad_id, "row has no identity"))


def reserved_clash(df: DataFrame, payload: str, envelope: tuple[str, ...]) -> DataFrame:
    """Rows whose payload map sets a field of the envelope."""
    return df.where(F.arrays_overlap(F.map_keys(payload), F.array(*[F.lit(e) for e in envelope])))


def classify_rows(df: DataFrame, rules: list[tuple[str, Column]], name: str = "row_kind") -> DataFrame:
    """First matching rule names the row. An unmatched row is NULL and has to be looked at, never skipped."""
    out: Column | None = None
    for label, cond in rules:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return df.withColumn(name, out)


IDENTITY_KEYS = ("look", "voice", "avatar", "avatar_id", "voice_id")  # fixed values
LOCAL_PATHS = ("/Users/", "/home/", "/private/", "/var/folders/", "/tmp/")  # fixed values


def raw_identity(df: DataFrame, payload: str, text: Column | None = None) -> DataFrame:
    """Flags ``raw_id`` (an identity key without a fingerprint) and ``local_path`` (a machine path anywhere)."""
    held = F.map_filter(payload, lambda k, v: k.isin(*IDENTITY_KEYS) & v.isNotNull() & (v != "") & ~v.startswith("sha256:"))
    body = F.to_json(payload) if text is None else text
    path = F.lit(False)
    for p in LOCAL_PATHS:
        path = path | body.contains(p)
    return df.withColumn("raw_id", F.size(held) > 0).withColumn("local_path", path)


def scrub(payload: Column, home: str | None = None) -> Column:
    """Identity values become fingerprints, temporary and home paths lose their machine part."""
    from assayer.functions.scalars import fingerprint

    def clean(v: Column) -> Column:
        v = F.regexp_replace(v, "(/private)?/tmp/", "<tmp>/")
        return F.replace(v, F.lit(home), F.lit("~")) if home else v

    return F.transform_values(payload, lambda k, v: F.when(k.isin(*IDENTITY_KEYS), fingerprint(v)).otherwise(clean(v)))


def mask_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Replace per-run fields by their own names, so two runs compare row for row."""
    return df.select(*[F.lit(f"<{c}>").alias(c) if c in fields else F.col(c) for c in df.columns])


WAIVER = r"^([0-9a-f]{12,64}):([^:\x00-\x1f]+):([^\x00-\x1f]+)$"  # fixed value


def read_waivers(lines: DataFrame, line: str = "line") -> DataFrame:
    """``<sha prefix>:<who>:<why>`` per line; blank lines are passed over, anything else is not a waiver (``held`` false)."""
    text = F.trim(F.col(line))
    who, why = F.trim(F.regexp_extract(text, WAIVER, 2)), F.trim(F.regexp_extract(text, WAIVER, 3))
    held = (F.regexp_extract(text, WAIVER, 1) != "") & (who != "") & (why != "")
    out = lines.where(text != "").withColumn("held", held)
    for name, value in (("prefix", F.regexp_extract(text, WAIVER, 1)), ("waived_by", who), ("waiver", why)):
        out = out.withColumn(name, F.when(F.col("held"), value))
    return out


def estimate(scenes: DataFrame, prices: DataFrame, by: list[str], engine: str = "engine") -> DataFrame:
    """Per spot: scenes, priced sum in cents and how many scenes have no price."""
    j = scenes.join(prices.select(engine, "cents"), engine, "left")
    return j.groupBy(*by).agg(F.count(F.lit(1)).alias("scenes"), F.coalesce(F.sum("cents"), F.lit(0)).alias("cents"),
                              F.sum(F.col("cents").isNull().cast("bigint")).alias("unpriced"))


# Cents per scene.
PRICES = {"google/gemini-omni-flash": 64, "google/gemini-omni-flash/reference-to-video": 64,
          "google/gemini-omni-flash/image-to-video": 64, "alibaba/wan-3.0/text-to-video": 100,
          "bytedance/seedance-2.0/text-to-video": 100}
