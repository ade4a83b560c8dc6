"""The ledger semantics as Structured Streaming jobs.

State is keyed by (run, seq) or by id, never by a whole run, so one long run spreads over the state store. Results go
to ``foreachBatch`` sinks that write one folder per batch and overwrite it, so a batch that is retried after a lost
executor leaves what it would have left the first time.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from assayer.operators.ledger import spend_states
from assayer.operators.ordered import chunk_of, scan_in_order
from assayer.session import shared_dir


def stream_ledger(spark: SparkSession, path: str, schema, fmt: str = "parquet", glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Ledger files as a stream, with an explicit schema and a bound on the files of one batch."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


def dedupe_by_id(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Each id once; a repeat within ``delay`` is dropped and its state forgotten after that."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, by: list[str], size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Counts per tumbling or sliding window; a window is final once the watermark passes its end."""
    g = stream.withWatermark(ts, delay).groupBy(F.window(ts, size, slide) if slide else F.window(ts, size), *by)
    return g.agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def session_events(stream: DataFrame, ts: str, by: list[str], gap: str, delay: str = "1 hour") -> DataFrame:
    """Events of a key closer than ``gap`` form a session."""
    g = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), *by)
    return g.agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def request_landing_join(requests: DataFrame, landings: DataFrame, keys: list[str], request_ts: str, landing_ts: str, timeout: str, delay: str = "1 hour") -> DataFrame:
    """Requests with their landings within ``timeout``; one that never landed comes out with NULLs once it cannot any more.

    ``keys`` identify a request, so its state holds its own landings and not those of its whole run.
    """
    r, l = requests.withWatermark(request_ts, delay).alias("r"), landings.withWatermark(landing_ts, delay).alias("l")
    on = (F.col(f"l.{landing_ts}") >= F.col(f"r.{request_ts}")) & (F.col(f"l.{landing_ts}") <= F.col(f"r.{request_ts}") + F.expr(f"INTERVAL {timeout}"))
    for key in keys:
        on = on & (F.col(f"r.{key}") == F.col(f"l.{key}"))
    return r.join(l, on, "left_outer")


def transition_monitor(out: str, edges: DataFrame, ts: str = "ts", delay: str = "1 hour", horizon: str = "30 days") -> Callable[[DataFrame, int], DataFrame]:
    """``transform`` of ``run_to_folder(stream, out, ...)`` for moves without an edge, as they happen; ``moves_of(out)`` reads them.

    A row meets its successor in a join on (run, seq) over the batch and what the batches before left open: rows whose
    successor or predecessor has not come, in a ledger that is appended in order two a run. Only those are kept, beside the
    moves, so a row that has met both is read once and costs no state. An open row is forgotten when it is ``horizon`` and
    ``delay`` older than the newest open one. A (run, seq) comes once; repeats go through ``dedupe_by_id`` before. The edge list is a static table.
    """
    known = edges.select("src", "dst").distinct().withColumn("__edge", F.lit(True))
    far, late = F.expr(f"INTERVAL {horizon}"), F.expr(f"INTERVAL {delay}")

    def moves(df: DataFrame, batch_id: int) -> DataFrame:
        rows = df.where("run IS NOT NULL AND seq IS NOT NULL")
        here = rows.select("run", "seq", F.col("step").alias("src"), F.col(ts).alias("src_ts"))
        nxt = rows.select("run", (F.col("seq") - 1).alias("seq"), F.col("step").alias("dst"), F.col(ts).alias("dst_ts"))
        if batch_id:
            left = _left_open(df.sparkSession, out, batch_id - 1, here, nxt)
            newest = left.agg(F.max(F.coalesce("src_ts", "dst_ts")).alias("t"))
            left = left.crossJoin(newest).where(F.coalesce("src_ts", "dst_ts") >= F.col("t") - far - late)
            here = here.unionByName(left.where("src_ts IS NOT NULL").select(*here.columns))
            nxt = nxt.unionByName(left.where("dst_ts IS NOT NULL").select(*nxt.columns))
        # A row without a time meets nothing, now or later.
        met = here.where("src_ts IS NOT NULL").join(nxt.where("dst_ts IS NOT NULL"), ["run", "seq"], "full_outer")
        met = met.withColumn("open", F.col("src_ts").isNull() | F.col("dst_ts").isNull())
        near = (F.col("dst_ts") >= F.col("src_ts")) & (F.col("dst_ts") <= F.col("src_ts") + far)
        return met.where(F.col("open") | near).join(known, ["src", "dst"], "left").where("open OR __edge IS NULL").drop("__edge")

    return moves


def _left_open(spark: SparkSession, out: str, batch_id: int, here: DataFrame, nxt: DataFrame) -> DataFrame:
    form = StructType([*here.schema.fields, *nxt.schema.fields[2:], StructField("open", BooleanType())])
    return spark.read.schema(form).parquet(batch_path(out, batch_id)).where("open")


def moves_of(spark: SparkSession, out: str) -> DataFrame:
    """(run, seq, src, dst): what ``transition_monitor`` has found so far."""
    return spark.read.parquet(out).where("NOT open").select("run", "seq", "src", "dst")


def batch_path(out: str, batch_id: int) -> str:
    return f"{out}/batch={batch_id}"


def run_to_folder(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", transform: Callable[[DataFrame, int], DataFrame] | None = None) -> StreamingQuery:
    """Write each batch to its own folder under ``out``, after ``transform(batch, batch_id)``."""
    def write(df: DataFrame, batch_id: int) -> None:
        d = transform(df, batch_id) if transform else df
        d.write.mode("overwrite").parquet(batch_path(out, batch_id))

    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(write).start())


def run_batches(rows: DataFrame, batch: str, batches: int, start: Callable[[DataFrame], StreamingQuery], purpose: str) -> None:
    """Feed ``rows`` to a job batch by batch: the rows of one number of ``batch`` are added to the stream's folder, then
    ``start(stream)`` runs over what is new. With one checkpoint over all calls this is a stream with known batch borders."""
    spark, source = rows.sparkSession, shared_dir(rows.sparkSession, purpose)
    for b in range(batches):
        rows.where(F.col(batch) == b).write.mode("append").parquet(source)
        start(stream_ledger(spark, source, rows.schema)).awaitTermination()


def run_available(stream: DataFrame, name: str, mode: str = "append", transform: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """Run a job over what is there now and return what it wrote, with the batch number."""
    spark = stream.sparkSession
    out, check = shared_dir(spark, name), shared_dir(spark, f"{name}-checkpoint")
    run_to_folder(stream, out, check, mode, transform).awaitTermination()
    return spark.read.parquet(out)


def append_once(stream: DataFrame, key: str) -> DataFrame:
    """Each value of ``key`` once over the stream's whole life.

    What was appended before is known to the state store, partitioned by key, so a batch reads nothing of the target.
    Where repeats can only come within a delay, ``dedupe_by_id`` lets the state be forgotten. A NULL key is a value.
    """
    return stream.dropDuplicates([key])


def late_rows(out: str, ts: str, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function routing rows older than the watermark of the batches before to ``out/late``, the others
    to ``out/live``, so a late correction is kept and not lost in a stateful operator. ``out/marks`` keeps the newest time."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        newest = None
        if batch_id > 0:
            marks = spark.read.schema("newest TIMESTAMP, batch BIGINT").parquet(f"{out}/marks").where(F.col("batch") < batch_id)
            newest = marks.agg(F.max("newest")).first()[0]
        mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay_seconds} SECONDS")
        late = F.coalesce(F.col(ts) < mark, F.lit(False)) if newest is not None else F.lit(False)
        df = df.persist()  # written three times
        df.where(late).write.mode("overwrite").parquet(batch_path(f"{out}/late", batch_id))
        df.where(~late).write.mode("overwrite").parquet(batch_path(f"{out}/live", batch_id))
        df.agg(F.max(ts).cast("timestamp").alias("newest")).write.mode("overwrite").parquet(batch_path(f"{out}/marks", batch_id))
        df.unpersist()

    return write


COMPACT_EVERY = 16


def state_paths(out: str, batch_id: int) -> list[str]:
    """Folders that hold the state before ``batch_id``: the newest compacted one and the changes since."""
    return [batch_path(out, b) for b in range((batch_id - 1) // COMPACT_EVERY * COMPACT_EVERY, batch_id)] if batch_id else []


def budget_guard(out: str, budget_cents: int, chunk: Column | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function deciding each request: sent, refused or not sent.

    The carry between batches is one row per run (cents so far, whether it broke its budget) in ``out/state``. A batch
    writes the runs it saw; every 16th batch writes all of them, so the state read is bounded by the runs and 15 batches.
    Within a batch the running sum is chunked, so a run that fills a batch is not summed in one task. A ledger is appended
    in order, so a batch's rows follow those of the batches before.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        form = f"run {df.schema['run'].dataType.simpleString()}, spent0 BIGINT, broken BOOLEAN, at BIGINT"
        paths = state_paths(f"{out}/state", batch_id)
        changes = spark.read.schema(form).parquet(*paths) if paths else spark.createDataFrame([], form)
        state = changes.groupBy("run").agg(F.max_by(F.struct("spent0", "broken"), "at").alias("s")).select("run", "s.*")
        part = chunk_of("seq") if chunk is None else chunk
        s = scan_in_order(df.select("run", "seq", "cents"), ["run"], ["seq"], part, sums={"spent": F.col("cents")}).join(state, "run", "left")
        s = s.withColumn("spent", F.col("spent") + F.coalesce("spent0", F.lit(0)))
        s = spend_states(s.withColumn("bad", F.col("cents").isNull() | (F.col("spent") > budget_cents)), part)
        verdict = F.when(F.coalesce("broken", F.lit(False)), "not sent").otherwise(F.col("state"))
        s.select("run", "seq", "cents", "spent", verdict.alias("state")).write.mode("overwrite").parquet(batch_path(f"{out}/decisions", batch_id))
        # The state follows from the decisions as written, so the batch is evaluated once.
        here = spark.read.schema(f"run {df.schema['run'].dataType.simpleString()}, spent BIGINT, state STRING").parquet(
            batch_path(f"{out}/decisions", batch_id)).groupBy("run").agg(F.max("spent").alias("spent0"), F.max(F.col("state") != "sent").alias("broken"))
        if batch_id % COMPACT_EVERY == 0:
            here = here.unionByName(state.join(here.select("run"), "run", "left_anti"))
        here.withColumn("at", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(batch_path(f"{out}/state", batch_id))

    return write


def run_function(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    start_function(stream, write, checkpoint).awaitTermination()


def start_function(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
