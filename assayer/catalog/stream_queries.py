"""Streaming jobs run over what is there, compared with the batch answer."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayer.catalog.base import Tables, query
from assayer.operators import ledger as L
from assayer.session import settle, shared_dir
from assayer.streaming import jobs as J

c = F.col
WATERMARK = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def events_stream(t: Tables):
    """``events`` as a stream; the time column is cast because a watermark needs an instant."""
    schema = t.read("events").schema
    return J.stream_ledger(t.spark, t.sf_dir, schema, glob="events.parquet").withColumn("ts", c("ts").cast("timestamp"))


BATCHES = 3
#: Batch of an event: its third of the time span; every tenth event arrives one batch late.
PARTED = f"""w AS (SELECT e.*, least({BATCHES - 1}, ((epoch_us(ts) - lo) * {BATCHES}) // (hi - lo + 1) + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END) AS b
  FROM events e, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events) x)"""


def third(rows, ts="ts"):
    """Adds ``b``, the third of the time span that a row lies in."""
    span_ = rows.agg(F.struct(F.min(us(ts)).alias("lo"), F.max(us(ts)).alias("hi"))).scalar()
    x = rows.withColumn("x", span_)
    return x.withColumn("b", F.expr(f"(unix_micros({ts}) - x.lo) * {BATCHES} div (x.hi - x.lo + 1)")).drop("x")


def parted_events(t: Tables):
    late = F.when(c("event_id") % 10 == 3, 1).otherwise(0)
    return third(t.events).withColumn("b", F.least(F.lit(BATCHES - 1), c("b") + late))


def us(col):
    return F.unix_micros(col)


@query("stream_dedupe", "X1,X2", "SELECT event_id FROM events")
def stream_dedupe(t):
    twice = events_stream(t).withColumn("copy", F.explode(F.expr("IF(user_id % 3 = 0, array(1, 2), array(1))")))
    return J.run_available(J.dedupe_by_id(twice, "event_id", "ts", "1 hour"), "dedupe").select("event_id")


@query("stream_tumbling", "X3", f"""
  SELECT epoch_us(date_trunc('hour', ts)) AS start_us, event_type, count(*) AS n FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= {WATERMARK} GROUP BY ALL""")
def stream_tumbling(t):
    d = J.run_available(J.windowed_counts(events_stream(t), "ts", ["event_type"], "1 hour"), "tumbling")
    return d.select(us("start").alias("start_us"), "event_type", "n")


@query("stream_sliding", "X3", f"""
  WITH w AS (SELECT event_type, ts, unnest([0, 1, 2, 3]) AS k FROM events), s AS (SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS st FROM w)
  SELECT epoch_us(st) AS start_us, event_type, count(*) AS n FROM s WHERE st + INTERVAL 1 HOUR <= {WATERMARK} GROUP BY ALL""")
def stream_sliding(t):
    d = J.run_available(J.windowed_counts(events_stream(t), "ts", ["event_type"], "1 hour", "15 minutes"), "sliding")
    return d.select(us("start").alias("start_us"), "event_type", "n")


@query("stream_sessions", "X4", f"""
  WITH p AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM p)
  SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM s GROUP BY user_id, s HAVING max(ts) + INTERVAL 6 HOUR <= {WATERMARK}""")
def stream_sessions(t):
    d = J.run_available(J.session_events(events_stream(t), "ts", ["user_id"], "6 hours"), "sessions")
    return d.select("user_id", us("start").alias("start_us"), "n")


@query("stream_request_landing", "X5", """
  WITH r AS (SELECT id, run, k, ts FROM fx_ledger WHERE kind = 'request'), l AS (SELECT id, run, k, ts FROM fx_ledger WHERE kind = 'landing'),
  wm AS (SELECT least((SELECT max(ts) FROM r), (SELECT max(ts) FROM l)) - INTERVAL 1 HOUR AS w)
  SELECT r.id AS request, l.id AS landing FROM r JOIN l ON l.run = r.run AND l.k = r.k AND l.ts BETWEEN r.ts AND r.ts + INTERVAL 120 HOUR
  UNION ALL SELECT r.id, NULL FROM r, wm WHERE r.ts + INTERVAL 120 HOUR < w AND NOT EXISTS (SELECT 1 FROM l WHERE l.run = r.run AND l.k = r.k AND l.ts BETWEEN r.ts AND r.ts + INTERVAL 120 HOUR)""")
def stream_request_landing(t):
    e = events_stream(t).select("event_id", "event_type", "ts", c("user_id").alias("run"), F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    r = e.where("event_type = 'click'").select(c("event_id").alias("request"), "run", "k", c("ts").alias("rts"))
    l = e.where("event_type = 'purchase'").select(c("event_id").alias("landing"), "run", "k", c("ts").alias("lts"))
    d = J.request_landing_join(r, l, ["run", "k"], "rts", "lts", "120 HOURS").select("request", "landing")
    return J.run_available(d, "landings").select("request", "landing")


@query("stream_transitions", "X6", """
  SELECT run, seq, src, dst FROM fx_moves m WHERE NOT EXISTS (SELECT 1 FROM fx_edges e WHERE e.src = m.src AND e.dst = m.dst)""")
def stream_transitions(t):
    out, check = shared_dir(t.spark, "transitions"), shared_dir(t.spark, "transitions-checkpoint")
    J.run_batches(third(settle(t.ledger, "ledger")), "b", BATCHES,
                  lambda s: J.run_to_folder(s, out, check, transform=J.transition_monitor(out, L.edges(t.spark))), "ledger-files")
    return J.moves_of(t.spark, out)


@query("stream_budget", "X7", f"""
  WITH r AS (SELECT run, seq, ts, CASE WHEN k <> 13 THEN cents END AS cents, sum(CASE WHEN k <> 13 THEN cents END) OVER (PARTITION BY run ORDER BY seq) AS spent FROM fx_ledger WHERE kind = 'request'),
  b AS (SELECT run, min(seq) AS breach FROM r WHERE cents IS NULL OR spent > 30000 GROUP BY run), x AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM r)
  SELECT run, seq, ((epoch_us(ts) - lo) * {BATCHES}) // (hi - lo + 1) AS batch,
    CASE WHEN breach IS NULL OR seq < breach THEN 'sent' WHEN seq = breach THEN 'refused' ELSE 'not sent' END AS state FROM r LEFT JOIN b USING (run), x""")
def stream_budget(t):
    out, check = shared_dir(t.spark, "budget"), shared_dir(t.spark, "budget-checkpoint")
    rows = settle(t.ledger.where("kind = 'request'").selectExpr("run", "seq", "ts", "IF(k <> 13, cents, NULL) AS cents"), "requests")
    J.run_batches(third(rows), "b", BATCHES, lambda s: J.start_function(s, J.budget_guard(out, 30000), check), "request-files")
    return t.spark.read.parquet(f"{out}/decisions").select("run", "seq", c("batch").cast("bigint").alias("batch"), "state")


@query("stream_append", "X8", f"""
  WITH {PARTED} SELECT user_id * 1000 + cast(json_extract_string(props, '$.k') AS BIGINT) AS id, min(b) AS batch FROM w GROUP BY 1""")
def stream_append(t):
    out, check = shared_dir(t.spark, "append"), shared_dir(t.spark, "append-checkpoint")
    rows = parted_events(t).select((c("user_id") * 1000 + F.get_json_object("props", "$.k").cast("bigint")).alias("id"), "b")
    J.run_batches(rows, "b", BATCHES, lambda s: J.run_to_folder(J.append_once(s.select("id"), "id"), out, check), "append-files")
    return t.spark.read.parquet(out).select("id", c("batch").cast("bigint").alias("batch"))


@query("stream_late_rows", "X9", f"""
  WITH {PARTED}, m AS (SELECT b, max(ts) AS newest FROM w GROUP BY b)
  SELECT event_id, b AS batch, coalesce(ts < (SELECT max(newest) FROM m WHERE m.b < w.b) - INTERVAL 1 HOUR, false) AS late FROM w""")
def stream_late_rows(t):
    out, check = shared_dir(t.spark, "late"), shared_dir(t.spark, "late-checkpoint")
    J.run_batches(parted_events(t).select("event_id", "ts", "b"), "b", BATCHES, lambda s: J.start_function(s, J.late_rows(out, "ts", 3600), check), "late-files")
    live, late = t.spark.read.parquet(f"{out}/live"), t.spark.read.parquet(f"{out}/late")
    rows = live.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return rows.select("event_id", c("batch").cast("bigint").alias("batch"), "late")
