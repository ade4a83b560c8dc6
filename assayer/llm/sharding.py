"""Two-pass external shuffle into shards of equal row counts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from assayer.session import settle, shared_dir

BUCKET_BYTES = 4 << 20


def bucket_count(total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return max(1, -(-total_bytes // bucket_bytes))


def shuffled(df: DataFrame, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Pass one scatters records by a seeded hash into buckets of about ``bucket_bytes``; pass two shuffles each bucket.

    The second pass is Spark's ``shuffle``, a Fisher-Yates shuffle of an array. A bucket is gathered in the order of its
    records, so a task that runs again makes the same permutation. Returns ``_bucket``, ``_rank`` (from 0) and the columns of
    ``df``, written once and reread, so that ranks are settled. Equal texts with different ids are scattered like any
    other rows. Null ids or texts are hashed as such; rows equal in both share a bucket. An empty table gives no rows.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 64
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    n = bucket_count(int(total), bucket_bytes)
    parts = max(1, min(n, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    row = F.struct(F.xxhash64(F.lit(seed), id_col, text_col).alias("_h"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    gathered = (df.select(F.pmod(F.xxhash64(F.lit(seed), id_col, F.octet_length(text_col), F.crc32(F.col(text_col).cast("binary"))), F.lit(n)).alias("_bucket"), row.alias("_r"))
                .repartition(parts, "_bucket").groupBy("_bucket")
                .agg(F.array_sort(F.collect_list("_r"), lambda a, b: F.when(a["_h"] < b["_h"], -1).when(a["_h"] > b["_h"], 1).otherwise(0)).alias("_rows"))
                .sortWithinPartitions("_bucket"))
    out = gathered.select("_bucket", F.posexplode(F.shuffle("_rows", seed)).alias("_rank", "_r"))
    return settle(out.select("_bucket", "_rank", *[F.col(f"_r._row.`{c}`").alias(c) for c in df.columns]), "shuffled")


def positions(buckets: DataFrame, block: int = 1024) -> DataFrame:
    """(bucket, first): rows in all buckets before it. Bucket counts are summed inside blocks, then over the blocks."""
    counts = buckets.groupBy("_bucket").agg(F.count("*").alias("_n")).withColumn("_block", F.floor(F.col("_bucket") / block))
    before = (counts.groupBy("_block").agg(F.sum("_n").alias("_all"))
              .select("_block", (F.sum("_all").over(W.orderBy("_block")) - F.col("_all")).alias("_before")))
    inside = F.sum("_n").over(W.partitionBy("_block").orderBy("_bucket")) - F.col("_n")
    return counts.withColumn("_inside", inside).join(before, "_block").select("_bucket", (F.col("_before") + F.col("_inside")).alias("_first"))


def shard(df: DataFrame, shards: int = 16, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Adds ``shard`` and gapless ``slot``: the shuffled sequence cut into runs whose lengths differ by one at most.

    Records keep all their columns; columns of ``df`` named ``shard`` or ``slot`` are replaced.
    """
    mixed = shuffled(df.drop("shard", "slot"), seed, bucket_bytes, id_col, text_col)
    firsts = settle(positions(mixed), "bucket-starts")
    n = mixed.count()
    at = F.col("_first") + F.col("_rank")
    s = F.expr(f"CAST((_first + _rank) * {shards} DIV {max(n, 1)} AS INT)")
    start = F.expr(f"CAST((CAST(shard AS BIGINT) * {n} + {shards - 1}) DIV {shards} AS BIGINT)")
    return (mixed.join(firsts, "_bucket").withColumn("shard", s).withColumn("slot", at - start)
            .drop("_bucket", "_rank", "_first"))


def write_shards(df: DataFrame, path: str | None = None, **how) -> str:
    """Write the shards as one folder each, rows of a shard in slot order within a file; returns the path."""
    path = path or shared_dir(df.sparkSession, "shards")
    out = shard(df, **how)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def shard_digest(df: DataFrame, shards: int = 16) -> DataFrame:
    text = F.col("text").cast("binary")
    return shard(df.select("doc_id", "text"), shards).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
