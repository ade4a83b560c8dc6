"""Races over probe readings derived from ``lineitem`` and ``part``."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayer.catalog.base import Tables, query
from assayer.operators import races as R
from assayer.sources.inline import inline_table

PANEL = [("gesture_up", "hand", "up", None, True), ("gesture_up", "bg", "down", 5.5, False), ("gesture_up", "eye", "down", None, False),
         ("gesture_up", "scene", "down", None, False), ("gesture_up", "level", "down", None, False),
         ("clutter_down", "hand", "down", None, False), ("clutter_down", "bg", "down", None, True), ("clutter_down", "eye", "down", None, False),
         ("clutter_down", "scene", "down", None, False), ("clutter_down", "level", "down", None, False)]


def lit(v):
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


PANEL_SQL = f"""fp(panel_type, probe, direction, bar, is_gate) AS (VALUES {', '.join('(' + ','.join(lit(x) for x in r) + ')' for r in PANEL)}),
  fb AS (SELECT DISTINCT p_brand AS brief, CASE WHEN cast(substr(p_brand, 7) AS INT) % 2 = 0 THEN 'gesture_up' ELSE 'clutter_down' END AS panel_type FROM part),
  fo AS (SELECT brief, 'bg' AS probe, 'up' AS direction, CAST(NULL AS DOUBLE) AS bar, true AS clear_bar FROM fb WHERE cast(substr(brief, 7) AS INT) % 3 = 0),
  panel AS (SELECT b.brief, b.panel_type, p.probe, coalesce(o.direction, p.direction) AS direction,
    CASE WHEN coalesce(o.clear_bar, false) THEN NULL ELSE coalesce(o.bar, p.bar) END::DOUBLE AS bar, p.is_gate
    FROM fb b JOIN fp p USING (panel_type) LEFT JOIN fo o ON o.brief = b.brief AND o.probe = p.probe)"""

SCORE_SQL = f"""{PANEL_SQL},
  r AS (SELECT l.brief, engine, l.probe, is_gate, CASE WHEN direction = 'up' THEN reading ELSE -reading END AS s FROM fx_long l JOIN panel USING (brief, probe)),
  w AS (SELECT brief, engine, probe, is_gate, s, s = max(s) OVER (PARTITION BY brief, probe) AS won FROM r),
  e AS (SELECT brief, engine, count(*) FILTER (won) AS wins, max(s) FILTER (is_gate) AS gate FROM w GROUP BY ALL),
  m AS (SELECT *, max(wins) OVER (PARTITION BY brief) AS top FROM e),
  g AS (SELECT *, max(gate) FILTER (wins = top) OVER (PARTITION BY brief) AS best_gate FROM m),
  score AS (SELECT brief, count(*) AS engines, max(wins) AS top_wins, count(*) FILTER (wins = top) AS leaders,
    CASE WHEN count(*) FILTER (wins = top) = 1 THEN min(engine) FILTER (wins = top)
      WHEN count(*) FILTER (wins = top AND gate = best_gate) = 1 THEN min(engine) FILTER (wins = top AND gate = best_gate) END AS winner,
    CASE WHEN count(*) FILTER (wins = top) = 1 THEN 'row_count' WHEN count(*) FILTER (wins = top AND gate = best_gate) = 1 THEN 'gate'
      ELSE 'unresolved_gate_tie' END AS decided_by FROM g GROUP BY brief)"""


def panel(t: Tables):
    rows = inline_table(t.spark, PANEL, "panel_type STRING, probe STRING, direction STRING, bar DOUBLE, is_gate BOOLEAN")
    briefs = t.part.select(F.col("p_brand").alias("brief")).distinct().withColumn("no", F.substring("brief", 7, 9).cast("int"))
    overrides = briefs.where("no % 3 = 0").selectExpr("brief", "'bg' AS probe", "'up' AS direction", "CAST(NULL AS DOUBLE) AS bar", "true AS clear_bar")
    return R.resolve_panels(briefs.selectExpr("brief", "IF(no % 2 = 0, 'gesture_up', 'clutter_down') AS panel_type"), rows, overrides)


@query("panel_overrides", "J19", f"WITH {PANEL_SQL} SELECT brief, panel_type, probe, direction, bar, is_gate FROM panel")
def panel_overrides(t):
    return panel(t)


@query("race_score", "A31", f"WITH {SCORE_SQL} SELECT * FROM score")
def race_score(t):
    return R.race_score(t.readings, panel(t))


@query("race_row_wins", "A31", f"WITH {SCORE_SQL} SELECT brief, engine, wins, gate::DOUBLE AS gate FROM e")
def race_row_wins(t):
    return R.row_wins(R.row_winners(t.readings, panel(t))).drop("readings")


@query("race_record", "A31", f"""
  WITH {SCORE_SQL} SELECT brief, winner, decided_by, (SELECT string_agg(engine || '=' || wins, ',' ORDER BY engine) FROM e WHERE e.brief = s.brief) AS row_wins,
   (SELECT string_agg(probe || ':' || engs, ',' ORDER BY probe) FROM (SELECT probe, string_agg(engine, '+' ORDER BY engine) AS engs FROM w
     WHERE won AND w.brief = s.brief GROUP BY probe) x) AS row_winners FROM score s""")
def race_record(t):
    d = R.race_record(t.readings, panel(t))
    wins = F.array_join(F.transform(F.map_entries("row_wins"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    rows = F.array_join(F.transform(F.map_entries("row_winners"), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], "+"))), ",")
    return d.select("brief", "winner", "decided_by", wins.alias("row_wins"), rows.alias("row_winners"))


@query("race_missing", "A32", f"""
  WITH {PANEL_SQL}, have AS (SELECT * FROM fx_long WHERE reading % 7 <> 0), en AS (SELECT DISTINCT brief, engine FROM fx_long)
  SELECT n.brief, n.engine, p.probe FROM en n JOIN panel p USING (brief) WHERE NOT EXISTS
    (SELECT 1 FROM have h WHERE h.brief = n.brief AND h.engine = n.engine AND h.probe = p.probe)""")
def race_missing(t):
    gappy = t.readings.withColumn("value", F.when(F.col("value") % 7 != 0, F.col("value")))
    return R.missing_readings(gappy, panel(t))


@query("race_status", "A32", f"""
  WITH {PANEL_SQL}, x AS (SELECT brief, engine, count(*) FILTER (reading % 7 = 0) AS m FROM fx_long GROUP BY ALL)
  SELECT brief, cast(sum(m) AS BIGINT) AS missing, count(*) FILTER (m > 0) AS engines_missing,
    CASE WHEN sum(m) > 0 THEN 'missing_scores' ELSE 'complete' END AS status FROM x GROUP BY brief""")
def race_status(t):
    gappy = t.readings.withColumn("value", F.when(F.col("value") % 7 != 0, F.col("value")))
    return R.race_status(gappy, panel(t))


@query("race_agreement", "A33", f"""
  WITH {SCORE_SQL}, h AS (SELECT brief, CASE WHEN cast(substr(brief, 7) AS INT) % 4 > 0 THEN 'e' || (cast(substr(brief, 7) AS INT) % 4) END AS recorded FROM fb)
  SELECT s.brief, winner, recorded, winner = recorded AS agrees, CASE WHEN winner <> recorded THEN 'Numeric ' || decided_by || ' result selects ' || winner ||
    '; hand record selects ' || recorded END AS disagreement FROM score s LEFT JOIN h USING (brief)""")
def race_agreement(t):
    hand = t.part.select(F.col("p_brand").alias("brief")).distinct().withColumn("no", F.substring("brief", 7, 9).cast("int")).selectExpr(
        "brief", "IF(no % 4 > 0, concat('e', no % 4), NULL) AS recorded")
    return R.race_agreement(R.race_score(t.readings, panel(t)), hand)


@query("reading_agreement", "A34,S5", """
  SELECT c_custkey, CASE WHEN round(c_acctbal / 100, 2) >= 0 THEN round(c_acctbal / 100, 2) END AS value, CASE WHEN c_custkey % 6 > 0 THEN round(c_acctbal / 100, 2) END AS transcribed,
   (c_custkey % 6 > 0) = (round(c_acctbal / 100, 2) >= 0) AS agrees FROM customer""")
def reading_agreement(t):
    from assayer.sources.readers import parse_reading
    rows = t.customer.selectExpr("c_custkey", "'hand_probe' AS probe", "round(c_acctbal / 100, 2) AS truth",
                                                         "concat('noise\\nHAND gesture ratio ', cast(round(c_acctbal / 100, 2) AS DECIMAL(12,2)), '  (x)') AS text")
    parsed = rows.select("c_custkey", parse_reading(F.col("probe"), F.col("text")).alias("value"))
    known = rows.where("c_custkey % 6 > 0").select("c_custkey", F.col("truth").alias("value"))
    return R.reading_agreement(parsed, known, ["c_custkey"])


@query("ledger_source_refs", "J18", """
  SELECT p_partkey, string_split(p_name, ' ')[1] AS brief FROM part WHERE string_split(p_name, ' ')[1] IN
    (SELECT string_split(p_name, ' ')[1] FROM part) AND p_type = 'ECONOMY'""")
def ledger_source_refs(t):
    led = t.part.selectExpr("p_partkey", "replace(p_name, ' ', '-') AS scene", "p_type AS engine")
    briefs = t.part.select(F.element_at(F.split("p_name", " "), 1).alias("brief"))
    return R.ledger_source_refs(led, briefs, engine="ECONOMY").select("p_partkey", "brief")


@query("batch_costs", "A42", """
  WITH o AS (SELECT o_orderpriority AS scope, o_custkey AS batch, max(cast(round(o_totalprice * 100) AS BIGINT)) AS amount, count(*) AS records
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL)
  SELECT scope, count(*) AS batches, cast(sum(amount) AS BIGINT) AS amount, cast(sum(records) AS BIGINT) AS records FROM o GROUP BY scope""")
def batch_costs(t):
    o = t.orders.selectExpr("o_orderpriority AS scope", "o_custkey AS batch", "IF(o_orderstatus <> 'P', bigint(round(o_totalprice * 100)), NULL) AS amount")
    return R.batch_costs(o, ["scope"], "batch", "amount")
