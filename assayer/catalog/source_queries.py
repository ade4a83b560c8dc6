"""Readers over files derived from the tables, written to the shared folder first."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayer.catalog.base import Tables, query
from assayer.catalog.text_queries import MAIL, findings_cte
from assayer.functions.findings import register_scan
from assayer.session import shared_dir
from assayer.sources import readers as R

c = F.col


def json_lines(t: Tables, df, name: str, damaged=None) -> str:
    """``df`` as JSON lines; rows where ``damaged`` holds lose their tail."""
    path = shared_dir(t.spark, name)
    line = F.to_json(F.struct(*df.columns))
    line = line if damaged is None else F.when(damaged, F.substring(line, F.lit(1), F.length(line) - 4)).otherwise(line)
    df.select(line.alias("value")).write.text(path)
    return path


@query("read_ledger", "S1", "SELECT run::VARCHAR AS run, id AS seq, kind, step FROM fx_ledger")
def read_ledger(t):
    path = json_lines(t, t.ledger_rows.select(c("run").cast("string"), c("id").alias("seq"), "kind", "step"), "ledger-json")
    return R.read_ledger(t.spark, path).select("run", "seq", "kind", "step")


@query("split_damaged", "S2", """
  SELECT CASE WHEN id % 50 = 7 THEN 'set aside' ELSE 'kept' END AS side, CASE WHEN id % 50 <> 7 THEN kind END AS kind, count(*) AS n FROM fx_ledger GROUP BY ALL""")
def split_damaged(t):
    path = json_lines(t, t.ledger_rows.select(c("run").cast("string"), c("id").alias("seq"), "kind", "step"), "ledger-damaged", c("seq") % 50 == 7)
    lines = t.spark.read.text(path).withColumnRenamed("value", "text")
    good, bad = R.split_damaged(R.parse_lines(lines))
    both = good.select(F.lit("kept").alias("side"), "kind").unionByName(bad.select(F.lit("set aside").alias("side"), F.lit(None).cast("string").alias("kind")))
    return both.groupBy("side", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("read_exemplars", "S3", """
  SELECT item::VARCHAR AS item, axis, verdict, measured::DOUBLE AS measured, true AS numeric FROM fx_exemplars WHERE item % 10 NOT IN (1, 2, 3)
  UNION ALL SELECT item::VARCHAR, axis, verdict, NULL, false FROM fx_exemplars WHERE item % 10 = 3""")
def read_exemplars(t):
    path = shared_dir(t.spark, "exemplars")
    t.exemplars.selectExpr("CASE item % 10 WHEN 1 THEN '# a note' WHEN 2 THEN NULL ELSE 'probe' END AS probe", "string(item) AS item", "verdict",
                           "IF(item % 10 = 3, 'many', string(measured)) AS measured", "axis", "'' AS pixels", "'' AS note").write.option("header", "true").option("comment", "|").csv(path)
    good, bad = R.read_exemplars(t.spark, path)
    return good.select("item", "axis", "verdict", "measured", F.lit(True).alias("numeric")).unionByName(
        bad.select("item", "axis", "verdict", F.lit(None).cast("double").alias("measured"), F.lit(False).alias("numeric")))


@query("read_panels", "S4", """
  WITH b AS (SELECT p_brand AS brief, min(p_type) AS panel_type FROM part GROUP BY 1), p AS (SELECT DISTINCT p_type AS panel_type, 's' || (p_size % 5) AS probe FROM part)
  SELECT brief, panel_type, probe, CASE WHEN probe = 's1' AND length(brief) > 7 THEN 'up' ELSE 'down' END AS direction, probe = 's0' AS is_gate FROM b JOIN p USING (panel_type)""")
def read_panels(t):
    from assayer.operators.races import resolve_panels
    path = shared_dir(t.spark, "panels")
    rows = t.part.selectExpr("p_type", "concat('s', p_size % 5) AS probe").distinct().groupBy("p_type").agg(
        F.array_sort(F.collect_set(F.struct("probe", F.col("probe").alias("label"), F.lit("down").alias("direction"), F.lit(1.5).alias("bar")))).alias("rows"))
    panels = rows.agg(F.map_from_entries(F.collect_list(F.struct("p_type", F.struct(F.lit("s0").alias("gate"), "rows")))).alias("panels"))
    over = F.expr("IF(length(p_brand) > 7, map('s1', named_struct('label', 'x', 'direction', 'up')), map())")
    briefs = t.part.groupBy("p_brand").agg(F.min("p_type").alias("panel_type")).withColumn("row_overrides", over).agg(
        F.map_from_entries(F.collect_list(F.struct("p_brand", F.struct("panel_type", "row_overrides")))).alias("briefs"))
    # A catalogue is one document: its size is the number of panels and briefs.
    panels.withColumn("briefs", briefs.scalar()).select(F.to_json(F.struct("panels", "briefs")).alias("value")).write.text(path)
    panel_rows, brief_rows, overrides = R.read_panels(t.spark, path)
    return resolve_panels(brief_rows, panel_rows, overrides).select("brief", "panel_type", "probe", "direction", "is_gate")


@query("read_votes", "S6", """
  SELECT pair_id, rater::VARCHAR AS rater, winner, study FROM (SELECT concat(a, '|', b) AS pair_id, rater, winner, shoot AS study FROM fx_votes) v WHERE study = 's1'""")
def read_votes(t):
    path = shared_dir(t.spark, "votes")
    t.votes.select(F.concat_ws("|", "a", "b").alias("pair_id"), "rater", "winner", c("shoot").alias("study")).write.option("header", "true").csv(path)
    return R.read_votes(t.spark, path, studies=["s1"])


@query("read_calls", "S6", """
  SELECT item AS clip, judge, rep::INT AS rep, craft::DOUBLE AS craft, message::DOUBLE AS message, warmth::DOUBLE AS warmth FROM fx_reps WHERE judge = 'R'""")
def read_calls(t):
    d = t.numbered_calls.select(c("item").alias("clip"), "judge", c("rep").cast("int").alias("rep"), "craft", "message", "warmth")
    return R.read_calls(t.spark, json_lines(t, d, "calls"), judge="R")


@query("read_pairs", "S6", """
  SELECT DISTINCT concat(a, '|', b) AS pair_id, brief, a || '-x' AS clip_a, string_split(a, '-')[2] AS engine_a, b || '-x' AS clip_b, string_split(b, '-')[2] AS engine_b FROM fx_votes WHERE shoot = 's2'""")
def read_pairs(t):
    def side(s):
        return F.struct(F.element_at(F.split(s, "-"), -1).alias("engine"), F.concat(F.lit("http://h/"), c(s), F.lit("-x.mp4")).alias("url")).alias(s)
    d = t.votes.select(F.concat_ws("|", "a", "b").alias("pair_id"), "brief", "shoot", side("a"), side("b")).distinct()
    return R.read_pairs(t.spark, json_lines(t, d, "pairs"), shoot="s2", lines=True).drop("shoot")


@query("scan_table_function", "F6", f"WITH {findings_cte(MAIL)} SELECT doc_id, line_no, label FROM f")
def scan_table_function(t):
    register_scan(t.spark, "scan_text", MAIL)
    return t.spark.sql("SELECT d.doc_id, s.line_no, s.label FROM {docs} d, LATERAL scan_text(d.text) s", docs=t.documents)
