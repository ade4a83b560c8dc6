"""Tables, fixture views and the query registry.

``FX`` holds the fixture views as SQL text. The DuckDB side inlines them as CTEs. The Spark side builds the same
relations in :class:`Tables`, with ordered numbering done chunk-wise (see ``operators.ordered``).
"""
from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators import ordered
from assayer.operators.bars import chunks_by_count
from assayer.operators.partitions import spread

FX: dict[str, str] = {
    "fx_calls": """SELECT concat('b',cast(l_orderkey % 5 AS VARCHAR)) AS brief,
      concat('b',cast(l_orderkey % 5 AS VARCHAR),'-e',cast(l_suppkey % 4 AS VARCHAR)) AS item,
      l_returnflag AS judge, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
      1 + cast(l_quantity AS INT) % 10 AS craft, 1 + cast(round(l_discount*100) AS INT) AS message,
      1 + cast(round(l_tax*100) AS INT) AS warmth FROM lineitem""",
    "fx_reps": """SELECT brief, item, judge, craft, message, warmth, row_number() OVER (PARTITION BY item, judge
      ORDER BY l_orderkey,l_linenumber,l_partkey,l_suppkey,l_shipdate,l_extendedprice) AS rep FROM fx_calls""",
    "fx_scores": """SELECT brief, item, judge, craft, message, warmth FROM fx_calls
      WHERE craft BETWEEN 1 AND 10 AND message BETWEEN 1 AND 10 AND warmth BETWEEN 1 AND 10""",
    "fx_totals": """SELECT brief, item, avg(craft + message + warmth) AS total, count(*) AS calls
      FROM fx_scores WHERE judge = 'A' GROUP BY brief, item""",
    "fx_votes": """SELECT vote_id, rater, shoot, brief, concat(brief,'-e',cast(a AS VARCHAR)) AS a,
      concat(brief,'-e',cast(b AS VARCHAR)) AS b,
      CASE st WHEN 'F' THEN concat(brief,'-e',cast(a AS VARCHAR))
              WHEN 'O' THEN concat(brief,'-e',cast(b AS VARCHAR)) END AS winner
      FROM (SELECT o_orderkey AS vote_id, o_custkey AS rater,
             CASE WHEN o_orderpriority < '4' THEN 's1' ELSE 's2' END AS shoot,
             concat('b',cast(o_orderkey % 5 AS VARCHAR)) AS brief, o_orderstatus AS st,
             cast(floor(o_orderkey/5) AS BIGINT) % 4 AS a,
             (cast(floor(o_orderkey/5) AS BIGINT) % 4 + 1 + cast(floor(o_orderkey/20) AS BIGINT) % 3) % 4 AS b
            FROM orders) t""",
    "fx_sides": """SELECT vote_id, rater, brief, a AS x, b AS y,
      CASE WHEN winner = a THEN 2 WHEN winner IS NULL THEN 1 ELSE 0 END AS pts FROM fx_votes
      UNION ALL SELECT vote_id, rater, brief, b, a,
      CASE WHEN winner = b THEN 2 WHEN winner IS NULL THEN 1 ELSE 0 END FROM fx_votes""",
    "fx_rates": """SELECT brief, x, y, cast(sum(pts) AS BIGINT) AS half_points, count(*) AS n
      FROM fx_sides GROUP BY brief, x, y""",
    "fx_values": """SELECT brief, item, value, opponents FROM (
      SELECT brief, x AS item, round(avg(half_points / (2.0 * n)), 12) AS value, count(*) AS opponents,
             count(*) OVER (PARTITION BY brief) AS items FROM fx_rates GROUP BY brief, x) t WHERE items >= 3""",
    "fx_lines": """SELECT brief, count(*) AS items, avg(value) AS uniform,
      (sum(value) - arg_min(value, {'t': total, 'i': item})) / (count(*) - 1) AS gate,
      arg_min(value, {'t': -total, 'i': item}) AS pick,
      (sum(value) - min(value)) / (count(*) - 1) AS oracle,
      arg_min(item, {'t': total, 'i': item}) AS killed, arg_min(value, {'t': total, 'i': item}) AS killed_value,
      arg_min(item, {'t': value, 'i': item}) AS worst, min(value) AS worst_value,
      arg_min(item, {'t': -total, 'i': item}) AS picked
      FROM fx_values JOIN fx_totals USING (brief, item) GROUP BY brief HAVING count(*) >= 3""",
    "fx_readings": """SELECT p_brand AS brief, concat('e',cast(l_suppkey % 4 AS VARCHAR)) AS engine,
      cast(sum(cast(l_quantity AS INT)) AS BIGINT) AS hand, count(*) AS bg, count(DISTINCT l_partkey) AS eye,
      cast(sum(cast(round(l_tax*100) AS INT)) AS BIGINT) AS scene, cast(max(l_linenumber) AS BIGINT) AS level
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_suppkey % 4""",
    "fx_long": """SELECT brief, engine, probe, reading FROM fx_readings
      UNPIVOT (reading FOR probe IN (hand, bg, eye, scene, level))""",
    "fx_ledger": """SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
      event_id AS id, ts, CASE event_type WHEN 'view' THEN 'board' WHEN 'click' THEN 'render'
        WHEN 'error' THEN 'ad_gates' WHEN 'purchase' THEN 'deliver' ELSE 'review' END AS step,
      CASE event_type WHEN 'click' THEN 'request' WHEN 'purchase' THEN 'landing' WHEN 'error' THEN 'gate'
        ELSE event_type END AS kind,
      cast(round(value*100) AS BIGINT) AS cents, cast(json_extract_string(props,'$.k') AS BIGINT) AS k
      FROM events""",
    "fx_series": """SELECT k.event_type AS series, h.pos, coalesce(s.v, 0) AS v
      FROM (SELECT DISTINCT event_type FROM events) k
      CROSS JOIN (SELECT unnest(range(min(epoch(date_trunc('hour', ts))::BIGINT // 3600),
                         max(epoch(date_trunc('hour', ts))::BIGINT // 3600) + 1))
                  - min(epoch(date_trunc('hour', ts))::BIGINT // 3600) AS pos FROM events) h
      LEFT JOIN (SELECT event_type, epoch(date_trunc('hour', ts))::BIGINT // 3600
                   - (SELECT min(epoch(date_trunc('hour', ts))::BIGINT // 3600) FROM events) AS pos, count(*) AS v
                 FROM events GROUP BY 1, 2) s ON s.event_type = k.event_type AND s.pos = h.pos""",
    "fx_exemplars": """SELECT d.doc_id AS item, d.lang AS axis, CASE WHEN l.toxic = 1 THEN 'out-of-domain'
      WHEN l.quality = 1 THEN 'pass' ELSE 'reject' END AS verdict, d.n_chars AS measured
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "fx_edges": """SELECT * FROM (VALUES ('board','render'),('render','render'),('render','closer'),('closer','build'),
      ('build','ad_gates'),('ad_gates','ship_gate'),('ad_gates','eye'),('eye','ship_gate'),('eye','render'),
      ('eye','closer'),('eye','build'),('ship_gate','deliver'),('ship_gate','eye'),('deliver','review'),
      ('review','render'),('review','closer'),('review','build'),('review','ledger'),('board','ledger'),
      ('render','ledger'),('closer','ledger'),('build','ledger'),('ad_gates','ledger'),('eye','ledger'),
      ('ship_gate','ledger')) e(src, dst)""",
    "fx_moves": """SELECT run, seq, step AS src, nxt AS dst FROM (SELECT run, seq, step,
      lead(step) OVER (PARTITION BY run ORDER BY seq) AS nxt FROM fx_ledger) t WHERE nxt IS NOT NULL""",
    "fx_textlines": """SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
      unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents""",
    "fx_words": """SELECT conv_id AS doc, turn, word AS text, cast(i AS DOUBLE) AS start_s, i + 0.8 AS end_s FROM (
      SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word,
      unnest(range(0, len(string_split(text, ' ')))) AS i FROM conversations) t WHERE word <> ''""",
    "fx_cues": """SELECT doc, turn, cast(floor(start_s / 7) AS BIGINT) AS cue,
      min(start_s) - (turn % 3) * 0.4 AS start_s, max(end_s) + (doc % 3) * 0.4 AS end_s,
      min(start_s) AS spoken_start, max(end_s) - (doc % 5) * 0.3 AS spoken_end, count(*) AS words
      FROM fx_words GROUP BY doc, turn, cast(floor(start_s / 7) AS BIGINT)""",
}


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def inline_views(sql: str) -> str:
    """Put the fixture views a statement uses in front of it as CTEs."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+\b", text):
            if name in FX and name not in need:
                visit(FX[name])
                if name not in need:
                    need.append(name)

    visit(sql)
    if not need:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{FX[n]})" for n in need)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].strip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].strip()}"
    return f"WITH {ctes}\n{body}"


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with the SQL it must agree with."""
    def register(fn: Callable[[Tables], DataFrame]):
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(name, ids, lambda spark, sf_dir: fn(Tables(spark, sf_dir)),
                               inline_views(sql) if sql else None)
        return fn
    return register


def span(path: str) -> str:
    return path.rstrip("/")


class Tables:
    """The driver's tables and the fixture relations derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, span(sf_dir)
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings",
                    "pages", "benchmark", "labels", "conversations"):
            return self.read(name)
        raise AttributeError(name)

    def wide(self, df: DataFrame) -> DataFrame:
        """Columns of a table for CPU-heavy work: a table of fewer files than cores is dealt to all of them."""
        cores = self.spark.sparkContext.defaultParallelism
        return spread(df, cores if len(df.inputFiles()) < cores else None)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **frames)

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def calls(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "concat('b', l_orderkey % 5) AS brief", "concat('b', l_orderkey % 5, '-e', l_suppkey % 4) AS item",
            "l_returnflag AS judge", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
            "l_extendedprice", "1 + cast(l_quantity AS INT) % 10 AS craft",
            "1 + cast(round(l_discount * 100) AS INT) AS message", "1 + cast(round(l_tax * 100) AS INT) AS warmth")

    @cached_property
    def numbered_calls(self) -> DataFrame:
        rn = ordered.scan_in_order(
            chunks_by_count(self.calls, ["item", "judge"], "l_orderkey"), ["item", "judge"],
            ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"],
            F.col("__part"), row_number="rep")
        return rn.select("brief", "item", "judge", "craft", "message", "warmth", "rep")

    @cached_property
    def votes(self) -> DataFrame:
        base = self.orders.selectExpr(
            "o_orderkey AS vote_id", "o_custkey AS rater", "CASE WHEN o_orderpriority < '4' THEN 's1' ELSE 's2' END AS shoot",
            "concat('b', o_orderkey % 5) AS brief", "o_orderstatus AS st", "(o_orderkey div 5) % 4 AS na",
            "((o_orderkey div 5) % 4 + 1 + (o_orderkey div 20) % 3) % 4 AS nb")
        return base.selectExpr("vote_id", "rater", "shoot", "brief", "concat(brief, '-e', na) AS a", "concat(brief, '-e', nb) AS b",
                               "CASE st WHEN 'F' THEN concat(brief, '-e', na) WHEN 'O' THEN concat(brief, '-e', nb) END AS winner")

    @cached_property
    def readings(self) -> DataFrame:
        """(brief, engine, probe, value) in long form."""
        j = self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey"))
        wide = j.groupBy(F.col("p_brand").alias("brief"), F.expr("concat('e', l_suppkey % 4)").alias("engine")).agg(
            F.sum(F.col("l_quantity").cast("int")).alias("hand"), F.count(F.lit(1)).alias("bg"),
            F.countDistinct("l_partkey").alias("eye"), F.sum(F.round(F.col("l_tax") * 100).cast("int")).alias("scene"),
            F.max(F.col("l_linenumber").cast("bigint")).alias("level"))
        return wide.unpivot(["brief", "engine"], ["hand", "bg", "eye", "scene", "level"], "probe", "value")

    @cached_property
    def ledger_rows(self) -> DataFrame:
        """Ledger rows without the per-run sequence number: one row per event, no shuffle."""
        return self.events.select(
            F.col("user_id").alias("run"), F.col("event_id").alias("id"), "ts",
            F.expr("CASE event_type WHEN 'view' THEN 'board' WHEN 'click' THEN 'render' WHEN 'error' THEN 'ad_gates' "
                   "WHEN 'purchase' THEN 'deliver' ELSE 'review' END").alias("step"),
            F.expr("CASE event_type WHEN 'click' THEN 'request' WHEN 'purchase' THEN 'landing' WHEN 'error' THEN 'gate' "
                   "ELSE event_type END").alias("kind"),
            F.round(F.col("value") * 100).cast("bigint").alias("cents"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"))

    @cached_property
    def ledger(self) -> DataFrame:
        parted = chunks_by_count(self.ledger_rows, ["run"], "ts", then="id")
        return ordered.scan_in_order(parted, ["run"], ["ts", "id"], F.col("__part"), row_number="seq").drop("__part")

    @cached_property
    def series(self) -> DataFrame:
        """(series, pos, v): events per type and hour, empty hours filled with 0."""
        hour = F.floor(F.unix_seconds("ts") / 3600).cast("bigint")
        counts = self.events.groupBy(F.col("event_type").alias("series"), hour.alias("hr")).agg(F.count(F.lit(1)).alias("v"))
        bounds = counts.groupBy().agg(F.min("hr").alias("h0"), F.max("hr").alias("h1")).first()
        h0, h1 = bounds["h0"], bounds["h1"]
        kinds = counts.select("series").distinct()
        grid = kinds.select("series", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(h1 - h0).cast("bigint"))).alias("pos"))
        have = counts.select("series", (F.col("hr") - F.lit(h0)).alias("pos"), "v")
        return grid.join(have, ["series", "pos"], "left").withColumn("v", F.coalesce("v", F.lit(0)))

    @cached_property
    def exemplars(self) -> DataFrame:
        d = self.documents.select("doc_id", F.col("lang").alias("axis"), F.col("n_chars").alias("measured"))
        return d.join(self.labels, "doc_id").select(
            F.col("doc_id").alias("item"), "axis",
            F.expr("CASE WHEN toxic = 1 THEN 'out-of-domain' WHEN quality = 1 THEN 'pass' ELSE 'reject' END").alias("verdict"),
            "measured")

    @cached_property
    def words(self) -> DataFrame:
        w = self.conversations.select(F.col("conv_id").alias("doc"), "turn",
                                      F.posexplode(F.split("text", " ", -1)).alias("i", "text"))
        return w.where("text <> ''").select("doc", "turn", "text", F.col("i").cast("double").alias("start_s"),
                                            (F.col("i") + F.lit(0.8)).cast("double").alias("end_s"))

    @cached_property
    def cues(self) -> DataFrame:
        g = self.words.groupBy("doc", "turn", F.floor(F.col("start_s") / 7).cast("bigint").alias("cue")).agg(
            F.min("start_s").alias("lo"), F.max("end_s").alias("hi"), F.count(F.lit(1)).alias("words"))
        return g.selectExpr("doc", "turn", "cue", "lo - (turn % 3) * 0.4D AS start_s", "hi + (doc % 3) * 0.4D AS end_s",
                            "lo AS spoken_start", "hi - (doc % 5) * 0.3D AS spoken_end", "words")
