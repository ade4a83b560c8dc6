"""Sinks: an append that is safe to repeat, and a findings export without the matched text."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AppendConflict(ValueError):
    """Proposed rows clash with the record; nothing was written."""


def with_row_hash(df: DataFrame, key: str) -> DataFrame:
    body = [c for c in sorted(df.columns) if c != key]
    return df.withColumn("__hash", F.sha2(F.to_json(F.struct(*body)), 256))


def conflicts(existing: DataFrame, proposed: DataFrame, key: str) -> DataFrame:
    """(key, reason): ids proposed twice, offered ids recorded twice, and ids whose recorded content differs.

    Either side becomes one row per id before the two meet, so an id that repeats on both sides costs no pairs: its count, and
    the least and the greatest of its contents, which are equal if there is one content. Rows are dealt by id before they are
    grouped; most ids come once, and a task that groups what it reads would hold all of its ids.
    """
    halves = {f"__h{i}": F.conv(F.substring("__hash", i, 15), 16, 10).cast("bigint") for i in (1, 16)}  # numbers need no sort to be grouped

    def told(df: DataFrame, side: str) -> DataFrame:
        rows = with_row_hash(df, key).select(key, *[h.alias(name) for name, h in halves.items()]).repartition(key)
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias(f"__n{side}"), *[f(h).alias(f"{h}{low}{side}") for h in halves for low, f in (("a", F.min), ("z", F.max))])

    # A NULL id can be proposed twice, but is none that the record could hold.
    both = told(proposed, "p").join(told(existing.where(F.col(key).isNotNull()), "e"), key, "left")
    one = F.lit(True)
    for h in halves:
        one &= (F.col(f"{h}ap") == F.col(f"{h}zp")) & (F.col(f"{h}ae") == F.col(f"{h}ze")) & (F.col(f"{h}ap") == F.col(f"{h}ae"))
    reasons = F.array(F.when(F.col("__np") > 1, F.lit("proposed twice")), F.when(F.col("__ne") > 1, F.lit("recorded twice")),
                      F.when(F.col("__ne").isNotNull() & ~one, F.lit("recorded with other content")))
    return both.select(key, F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("reason"))


def unseen(existing: DataFrame, proposed: DataFrame, key: str) -> DataFrame:
    return proposed.join(existing.select(key), key, "left_anti")


def append_idempotent(target: str, proposed: DataFrame, key: str) -> int:
    """Append the rows whose id is not in the Parquet table at ``target`` and return how many.

    An identical re-offer adds nothing. Any conflict raises before a byte is written. The write is one Spark commit,
    so a lost executor or a repeated call leaves either all new rows or none.
    """
    spark = proposed.sparkSession
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    exists = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
    if exists:
        existing = spark.read.schema(proposed.schema).parquet(target)
    else:
        existing = proposed.limit(0)
    clash = conflicts(existing, proposed, key).limit(5).collect()
    if clash:
        raise AppendConflict("; ".join(f"{r[key]}: {r['reason']}" for r in clash))
    fresh = unseen(existing, proposed, key)
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(target)
    return n


SEVERITIES = ("BLOCKER", "HIGH", "MEDIUM", "LOW")


def severity_rank(col: str = "severity"):
    out = None
    for i, s in enumerate(SEVERITIES):
        out = F.when(F.col(col) == s, i) if out is None else out.when(F.col(col) == s, i)
    return out.otherwise(len(SEVERITIES))


def export_findings(findings: DataFrame) -> DataFrame:
    """``path:line:CLASS:SEVERITY:label`` once per finding, by severity. The matched text is not a column of it."""
    line = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("line_no").cast("string"), "class", "severity", "label")
    once = findings.dropDuplicates(["doc_id", "line_no", "class", "severity", "label"])
    return once.orderBy(severity_rank(), "doc_id", "line_no", "label").select(line.alias("finding"))
