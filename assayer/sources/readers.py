"""Readers: explicit schemas, provenance columns, and a quarantine for rows that do not parse."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How each probe prints its reading.
READING_PATTERNS = {
    "hand_probe": r"(?m)^HAND gesture ratio ([0-9.]+)\s",
    "bg_detail": r"(?m)^BG (?:SIMPLE|TOO BUSY): detail ([0-9.]+)\s",
    "eye_eval": r"(?m)^EYE (?:PASS|REJECT): bg ([0-9.]+)\s",
    "scene_simplicity": r"(?m)^(?:SIMPLE|TOO BUSY)\s+([0-9.]+)\s",
    "level_probe": r"(?m)\| face ([0-9.]+)\s",
}

LEDGER_SCHEMA = T.StructType([
    T.StructField("schema", T.IntegerType()), T.StructField("run", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("ts", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("step", T.StringType()),
    T.StructField("request_id", T.StringType()), T.StructField("spot", T.StringType()), T.StructField("scene", T.StringType()),
    T.StructField("engine", T.StringType()), T.StructField("leg", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("est_usd", T.DoubleType()), T.StructField("pass", T.BooleanType()), T.StructField("dry", T.BooleanType()),
    T.StructField("trail", T.ArrayType(T.StringType())), T.StructField("id", T.StringType()), T.StructField("roll", T.IntegerType()),
    T.StructField("attempt", T.IntegerType()), T.StructField("why", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("ad", T.StringType()), T.StructField("master", T.StringType()), T.StructField("mouth", T.StringType()),
    T.StructField("gate", T.StringType()), T.StructField("url", T.StringType()), T.StructField("fix", T.StringType()),
    T.StructField("supersedes", T.StringType()), T.StructField("who", T.StringType()), T.StructField("what", T.StringType()),
    T.StructField("seqs", T.ArrayType(T.LongType())),
    T.StructField("withdrawn", T.ArrayType(T.StructType([T.StructField("ad", T.StringType())])))])

EXEMPLAR_SCHEMA = "probe STRING, item STRING, verdict STRING, measured STRING, axis STRING, pixels STRING, note STRING"
VOTE_SCHEMA = "pair_id STRING, rater STRING, winner STRING, study STRING"
CALL_SCHEMA = "clip STRING, judge STRING, rep INT, craft DOUBLE, message DOUBLE, warmth DOUBLE"
SIDE = "STRUCT<engine: STRING, url: STRING>"
PAIR_SCHEMA = f"pair_id STRING, brief STRING, shoot STRING, a {SIDE}, b {SIDE}"


def read_ledger(spark: SparkSession, path: str, schema: T.StructType = LEDGER_SCHEMA) -> DataFrame:
    """JSON lines with the union schema; ``_corrupt`` holds a row that does not parse, ``_file`` its origin."""
    s = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    df = (spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path))
    return df.withColumn("_file", F.col("_metadata.file_path"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, text) of text files, one row per non-blank line, for rows that must be cited by line.

    Each file is read whole, so this is for ledgers and notes of ordinary file size; a large JSON-lines corpus goes
    through :func:`read_ledger`.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = whole.select("file", F.posexplode(F.split("value", "\n", -1)).alias("pos", "text"))
    return lines.where(F.trim("text") != "").select("file", (F.col("pos") + 1).cast("bigint").alias("line_no"), "text")


def split_damaged(df: DataFrame, corrupt: str = "_corrupt") -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and the quarantine. Nothing is deleted.

    Both sides test the same expression, so a row is in exactly one. Where the file is JSON lines Spark refuses to
    answer from the corrupt column alone; the envelope stays in the projection for that reason.
    """
    return df.where(F.col(corrupt).isNull()).drop(corrupt), df.where(F.col(corrupt).isNotNull())


def parse_lines(lines: DataFrame, schema: T.StructType = LEDGER_SCHEMA, text: str = "text") -> DataFrame:
    """Parse JSON text lines keeping their provenance; ``_corrupt`` holds what does not parse."""
    s = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    row = F.from_json(F.col(text), s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.withColumn("__r", row).select(*[c for c in lines.columns if c != text], "__r.*")


def read_exemplars(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Labelled rows with a numeric ``measured``, and the rows whose measure is no number."""
    raw = (spark.read.schema(EXEMPLAR_SCHEMA).option("header", "true").option("comment", "#").csv(path)
           .where(F.coalesce(F.trim("probe"), F.lit("")) != ""))
    typed = raw.withColumn("value", F.col("measured").try_cast("double"))
    good = typed.where("value IS NOT NULL").drop("measured").withColumnRenamed("value", "measured")
    return good, typed.where("value IS NULL").drop("value")


def read_panels(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A panel catalogue as (panel rows, briefs, overrides)."""
    row = "STRUCT<probe: STRING, label: STRING, direction: STRING, bar: DOUBLE>"
    schema = (f"panels MAP<STRING, STRUCT<gate: STRING, rows: ARRAY<{row}>>>, "
              "briefs MAP<STRING, STRUCT<panel_type: STRING, row_overrides: MAP<STRING, STRUCT<label: STRING, direction: STRING, bar: DOUBLE>>>>")
    doc = spark.read.schema(schema).option("multiLine", "true").json(path)
    p = doc.select(F.explode("panels").alias("panel_type", "p"))
    rows = p.select("panel_type", F.col("p.gate").alias("gate"), F.inline("p.rows")).select(
        "panel_type", "probe", "direction", "bar", (F.col("probe") == F.col("gate")).alias("is_gate"))
    b = doc.select(F.explode("briefs").alias("brief", "b"))
    over = b.select("brief", F.explode("b.row_overrides").alias("probe", "o")).select(
        "brief", "probe", "o.direction", "o.bar", F.col("o.bar").isNull().alias("clear_bar"))
    return rows, b.select("brief", "b.panel_type"), over


def parse_reading(probe: Column, text: Column) -> Column:
    """The number a probe printed, NULL when its line is not there."""
    out: Column | None = None
    for name, pattern in READING_PATTERNS.items():
        value = F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double")
        out = F.when(probe == name, value) if out is None else out.when(probe == name, value)
    return out


def read_readings_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """One reading per saved output file; files without a match come second.

    A file is named ``<item>.<probe>.txt``, or lies in folders ``item=.../probe=...`` under any name.
    """
    t = spark.read.text(path, wholetext=True)
    file = F.col("_metadata.file_name").alias("file")
    if "item" in t.columns and "probe" in t.columns:
        t = t.select(file, F.col("item").cast("string").alias("item"), F.col("probe").cast("string").alias("probe"), F.col("value").alias("text"))
    else:
        t = t.select(file, "value").select("file", F.regexp_extract("file", r"^(.*)\.([a-z_]+)\.txt$", 1).alias("item"),
                                           F.regexp_extract("file", r"^(.*)\.([a-z_]+)\.txt$", 2).alias("probe"), F.col("value").alias("text"))
    return _read_and_missed(t)


def read_readings_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``read_readings_text`` of outputs saved as records (item, probe, value) of JSON lines files, many to a file.

    A file of its own for every output costs a listing, a commit and a task's open each; past some ten thousand of them that is
    all the time there is.
    """
    t = spark.read.schema("item STRING, probe STRING, value STRING").json(path)
    return _read_and_missed(t.select(F.col("_metadata.file_name").alias("file"), "item", "probe", F.col("value").alias("text")))


def _read_and_missed(outputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    parsed = outputs.withColumn("reading", parse_reading(F.col("probe"), F.col("text"))).drop("text")
    return parsed.where("reading IS NOT NULL"), parsed.where("reading IS NULL").drop("reading")


def read_votes(spark: SparkSession, path: str, fmt: str = "csv", studies: list[str] | None = None) -> DataFrame:
    """Votes; an empty winner is no preference (NULL). The study filter reaches a columnar scan."""
    r = spark.read.schema(VOTE_SCHEMA)
    df = r.option("header", "true").option("nullValue", "").csv(path) if fmt == "csv" else r.format(fmt).load(path)
    df = df.withColumn("winner", F.nullif("winner", F.lit("")))
    return df.where(F.col("study").isin(studies)) if studies else df


def read_calls(spark: SparkSession, path: str, judge: str | None = None, fmt: str = "json") -> DataFrame:
    df = spark.read.schema(CALL_SCHEMA).format(fmt).load(path)
    return df.where(F.col("judge") == judge) if judge else df


def read_pairs(spark: SparkSession, path: str, shoot: str | None = None, lines: bool = False) -> DataFrame:
    """Pairs with the clip of each side taken from its url; one JSON array, or JSON ``lines`` for large sets."""
    from assayer.functions.scalars import clip_of_url
    df = spark.read.schema(PAIR_SCHEMA).option("multiLine", str(not lines).lower()).json(path)
    df = df.where(F.col("shoot") == shoot) if shoot else df
    return df.select("pair_id", "brief", "shoot", clip_of_url(F.col("a.url")).alias("clip_a"), F.col("a.engine").alias("engine_a"),
                     clip_of_url(F.col("b.url")).alias("clip_b"), F.col("b.engine").alias("engine_b"))


def content_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files."""
    f = spark.read.format("binaryFile").load(path)
    return f.select("path", "length", F.sha2("content", 256).alias("sha256"))


def against_pins(manifest: DataFrame, pins: DataFrame, on: str = "path") -> DataFrame:
    """Files against their recorded hashes: match, differs or unpinned."""
    p = pins.select(on, F.col("sha256").alias("pinned"))
    return manifest.join(p, on, "left").withColumn(
        "state", F.when(F.col("pinned").isNull(), "unpinned").when(F.col("pinned") == F.col("sha256"), "match").otherwise("differs"))
