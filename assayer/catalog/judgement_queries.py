"""Thresholds, labels, tallies and row validation."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayer.catalog.base import Tables, query
from assayer.functions import scalars as S
from assayer.functions import verdicts as D
from assayer.operators import labels as L
from assayer.operators import validate as C
from assayer.sources.inline import inline_table


def n(name):
    return F.count(F.lit(1)).alias(name)


@query("band_verdict", "P6", """
  WITH r AS (SELECT CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN 'nan'::DOUBLE ELSE l_discount * 4 END AS corr,
    (l_linenumber - 3) * 0.1::DOUBLE AS lag, l_tax * 3 AS jaw, 0.5 + l_discount * 4 AS cover, -18 + l_linenumber * 0.5::DOUBLE AS i,
    -2.5 + l_linenumber * 0.25::DOUBLE AS tp, l_linenumber - 5 AS frames, l_quantity * 4 AS level, l_discount * 2 AS dev,
    CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity / 10 END AS first FROM lineitem)
  SELECT CASE WHEN corr IS NULL OR isnan(corr) THEN 'UNMEASURED' WHEN corr >= 0.25 AND abs(lag) <= 0.2 THEN 'PASS' WHEN corr < 0.1 THEN 'FAIL' ELSE 'REVIEW' END AS sync,
    CASE WHEN cover < 0.7 THEN 'UNMEASURED' WHEN jaw <= 0.17 THEN 'PASS' ELSE 'FAIL' END AS jaw,
    CASE WHEN abs(i + 16) <= 1 AND tp < -1.5 THEN 'PASS' ELSE 'FAIL' END AS loudness,
    CASE WHEN frames BETWEEN -4 AND 2 THEN 'PASS' ELSE 'FAIL' END AS lag_band,
    CASE WHEN level < 70 THEN 'dim' WHEN level <= 120 THEN 'mid' ELSE 'bright' END AS level,
    CASE WHEN dev > 0.15 THEN 'DRIFTED' WHEN dev < 0.075 THEN 'consensus' ELSE 'near' END AS drift,
    coalesce(first > 1.75, false) AS late, count(*) AS n FROM r GROUP BY ALL""")
def band_verdict(t):
    r = t.lineitem.selectExpr(
        "CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN double('NaN') ELSE l_discount * 4 END AS corr",
        "(l_linenumber - 3) * 0.1D AS lag", "l_tax * 3 AS jaw", "0.5D + l_discount * 4 AS cover", "-18 + l_linenumber * 0.5D AS i",
        "-2.5D + l_linenumber * 0.25D AS tp", "l_linenumber - 5 AS frames", "l_quantity * 4 AS level", "l_discount * 2 AS dev",
        "CASE WHEN l_quantity > 40 THEN NULL ELSE l_quantity / 10 END AS first")
    c = F.col
    out = r.select(D.sync_verdict(c("corr"), c("lag")).alias("sync"), D.covered_verdict(c("jaw"), c("cover")).alias("jaw"),
                   D.loudness_verdict(c("i"), c("tp")).alias("loudness"), D.lag_band(c("frames")).alias("lag_band"),
                   D.level_class(c("level")).alias("level"), D.deviation_class(c("dev")).alias("drift"), D.late_start(c("first")).alias("late"))
    return out.groupBy(*out.columns).agg(n("n"))


STATE = "CASE {c} % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'fail' WHEN 2 THEN 'split' WHEN 3 THEN '-' END"


@query("combine_verdicts", "P7", f"""
  WITH r AS (SELECT {STATE.format(c='l_partkey')} AS p, {STATE.format(c='l_suppkey')} AS b FROM lineitem)
  SELECT p AS props, b AS background, CASE WHEN p = 'fail' OR b = 'fail' THEN 'FAIL' WHEN p = 'split' OR b = 'split' THEN 'REVIEW'
    WHEN p IS NULL OR b IS NULL OR b = '-' THEN 'UNREAD' ELSE 'PASS' END AS verdict, count(*) AS n FROM r GROUP BY ALL""")
def combine_verdicts(t):
    r = t.lineitem.selectExpr(STATE.format(c="l_partkey") + " AS props", STATE.format(c="l_suppkey") + " AS background")
    return r.withColumn("verdict", D.combine_verdicts(F.col("props"), F.col("background"))).groupBy("props", "background", "verdict").agg(n("n"))


@query("quadrant", "P8", """
  WITH r AS (SELECT l_discount * 7 AS g, CASE WHEN l_quantity <= 45 THEN l_tax / 5 END AS p FROM lineitem)
  SELECT CASE WHEN p IS NULL THEN NULL WHEN g >= 0.35 AND p <= 0.011 THEN 'present, in step' WHEN g >= 0.35 THEN 'present, late'
    WHEN p <= 0.011 THEN 'absent, in step' ELSE 'absent, late' END AS reading, count(*) AS n FROM r GROUP BY ALL""")
def quadrant(t):
    r = t.lineitem.selectExpr("l_discount * 7 AS g", "CASE WHEN l_quantity <= 45 THEN l_tax / 5 END AS p")
    return r.groupBy(D.quadrant(F.col("g"), F.col("p")).alias("reading")).agg(n("n"))


@query("waivable", "P13", """
  WITH r AS (SELECT CASE WHEN l_returnflag = 'A' THEN 'PASS' ELSE 'FAIL' END AS v, l_discount * 8 AS sim, l_linenumber % 3 AS st,
    CASE WHEN l_linestatus = 'F' THEN l_tax * 8 END AS other, l_suppkey % 2 = 0 AS second FROM lineitem)
  SELECT coalesce(v = 'FAIL' AND st > 0 AND sim >= 0.3 AND CASE WHEN second THEN other IS NOT NULL AND other < sim ELSE other IS NULL END, false) AS waivable,
   v AS verdict, count(*) AS n FROM r GROUP BY ALL""")
def waivable(t):
    r = t.lineitem.selectExpr("CASE WHEN l_returnflag = 'A' THEN 'PASS' ELSE 'FAIL' END AS verdict", "l_discount * 8 AS sim", "l_linenumber % 3 AS st",
                              "CASE WHEN l_linestatus = 'F' THEN l_tax * 8 END AS other", "l_suppkey % 2 = 0 AS second")
    c = F.col
    return r.groupBy(D.waivable(c("verdict"), c("sim"), F.lit(0.3), c("st"), c("other"), c("second")).alias("waivable"), "verdict").agg(n("n"))


@query("score_card", "P15", """
  WITH r AS (SELECT doc_id, CASE WHEN quality = 1 THEN 3 ELSE 1 END AS h, doc_id % 5 AS re, CASE WHEN toxic = 1 THEN 0 ELSE 2 END AS ab,
    CASE WHEN doc_id % 7 <> 0 THEN 2 END AS lo, CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE 'eye' END AS who FROM labels)
  SELECT doc_id, concat_ws('; ', CASE WHEN h < 2 THEN 'hook under 2' END, CASE WHEN re > 3 THEN 'realism not a whole number from 0 to 3'
    WHEN re < 2 THEN 'realism under 2' END, CASE WHEN ab < 2 THEN 'absurdity under 2' END, CASE WHEN lo IS NULL THEN 'logic missing' END,
    CASE WHEN trim(who) = '' THEN 'scored_by missing' END) AS unmet FROM r""")
def score_card(t):
    r = t.labels.selectExpr(
        "doc_id", "map_filter(map('hook', IF(quality = 1, 3, 1), 'realism', int(doc_id % 5), 'absurdity', IF(toxic = 1, 0, 2), 'logic', IF(doc_id % 7 <> 0, 2, NULL)),"
        " (k, v) -> v IS NOT NULL) AS scores", "CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE 'eye' END AS who")
    u = D.unmet_rows(F.col("scores"), F.col("who"))
    parts = F.transform(F.map_entries(u), lambda e: F.concat_ws(" ", e["key"], e["value"]))
    return r.select("doc_id", F.array_join(parts, "; ").alias("unmet"))


@query("hard_then_soft", "P19", """
  SELECT doc_id, NOT (quality = 1 AND toxic = 0) AS blocked, CASE WHEN quality = 1 AND toxic = 0 THEN n_chars END AS score
  FROM labels JOIN documents USING (doc_id)""")
def hard_then_soft(t):
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").selectExpr("doc_id", "quality = 1 AS good", "toxic = 0 AS clean", "n_chars AS score")
    return L.hard_then_soft(d, ["good", "clean"], ["score"]).select("doc_id", "blocked", "score")


GATES = [("max_detail", "en", "ceiling", 4000.0, 1.0, True), ("max_detail", "fr", "ceiling", 2.0, 1000.0, True), ("rest_min", "de", "floor", 100.0, 1.0, True),
         ("rest_min", "es", "floor", 30.0, 1.0, False), ("face_max", "it", "ceiling", 9.0, 1.0, True)]
GATE_ROWS = ", ".join(f"('{a}','{b}','{c}',{d}::DOUBLE,{e}::DOUBLE,{g})" for a, b, c, d, e, g in GATES)


def gates(t: Tables):
    return inline_table(t.spark, GATES, "constant STRING, axis STRING, polarity STRING, value DOUBLE, scale DOUBLE, gating BOOLEAN")


BRACKET = f"""
  WITH g(constant, axis, polarity, value, scale, gating) AS (VALUES {GATE_ROWS}),
  e AS (SELECT axis, count(*) FILTER (verdict = 'pass') AS np, count(*) FILTER (verdict = 'reject') AS nr,
    count(*) FILTER (verdict NOT IN ('pass', 'reject')) AS nx, min(measured) FILTER (verdict = 'pass') AS plo, max(measured) FILTER (verdict = 'pass') AS phi,
    min(measured) FILTER (verdict = 'reject') AS rlo, max(measured) FILTER (verdict = 'reject') AS rhi FROM fx_exemplars GROUP BY axis),
  b AS (SELECT g.*, coalesce(np, 0) AS n_pass, coalesce(nr, 0) AS n_reject, coalesce(nx, 0) AS n_excluded,
    CASE WHEN np > 0 AND nr > 0 THEN CASE WHEN polarity = 'ceiling' THEN phi ELSE plo END END::DOUBLE AS pass_edge,
    CASE WHEN np > 0 AND nr > 0 THEN CASE WHEN polarity = 'ceiling' THEN rlo ELSE rhi END END::DOUBLE AS reject_edge FROM g LEFT JOIN e USING (axis))
  SELECT constant, axis, polarity, gating, n_pass, n_reject, n_excluded, pass_edge, reject_edge,
    CASE WHEN pass_edge IS NULL THEN 'AUTHORED' WHEN (polarity = 'ceiling' AND pass_edge < value * scale AND value * scale < reject_edge)
      OR (polarity = 'floor' AND reject_edge < value * scale AND value * scale < pass_edge) THEN 'DERIVED' ELSE 'REFUTED' END AS status FROM b"""


@query("bracket", "A22,K5", BRACKET)
def bracket(t):
    return L.gate_listing(L.bracket(t.exemplars, gates(t), ["axis"]).drop("value", "scale"), "constant")


@query("orphans", "J4", "SELECT item, axis, verdict FROM fx_exemplars WHERE axis NOT IN ('en', 'de')")
def orphans(t):
    return L.orphans(t.exemplars, gates(t).where("axis IN ('en', 'de')"), ["axis"]).select("item", "axis", "verdict")


@query("reproduce", "A23,M5,F1", """
  SELECT e.item, e.axis, coalesce(abs(r.recomputed - e.measured) <= CASE WHEN e.axis = 'fr' THEN greatest(0.05, 0.1 * abs(e.measured))
     WHEN e.axis = 'en' THEN 40 ELSE 0.05 END, false) AS ok
  FROM fx_exemplars e LEFT JOIN (SELECT doc_id, CASE WHEN lang = 'en' THEN length(text) - doc_id % 80 WHEN lang = 'fr' THEN length(text) * 0.92
     WHEN lang = 'de' THEN length(text) END AS recomputed FROM documents) r ON r.doc_id = e.item""")
def reproduce(t):
    registry = {"en": F.length("text") - F.col("doc_id") % 80, "fr": F.length("text") * 0.92, "de": F.length("text")}
    redo = L.recompute_with(t.documents, registry, probe="lang").select(F.col("doc_id").alias("item"), "recomputed")
    return L.reproduce(t.exemplars, redo, ["item"], relative={"fr": 0.1}, absolute={"en": 40.0}, probe="axis").select("item", "axis", "ok")


@query("confusion", "A24,M11", """
  WITH r AS (SELECT d.source AS version, CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END AS label,
    CASE WHEN n_chars % 5 = 0 THEN NULL WHEN n_chars % 2 = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM labels JOIN documents d USING (doc_id))
  SELECT version, count(*) AS n, count(*) FILTER (label = 'FAIL') AS n_fail, count(*) FILTER (label = 'PASS') AS n_pass,
    count(*) FILTER (label = 'FAIL' AND verdict = 'FAIL') AS caught, count(*) FILTER (label = 'PASS' AND verdict = 'PASS') AS cleared,
    count(*) FILTER (verdict IS DISTINCT FROM label) AS disagree, round(10.0 * count(*) FILTER (verdict IS DISTINCT FROM label) / count(*), 6)::DOUBLE AS per_ten
  FROM r GROUP BY version""")
def confusion(t):
    r = t.labels.join(t.documents.select("doc_id", "source", "n_chars"), "doc_id").selectExpr(
        "source AS version", "CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END AS label",
        "CASE WHEN n_chars % 5 = 0 THEN NULL WHEN n_chars % 2 = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict")
    return L.confusion(r, ["version"]).withColumn("per_ten", F.round(S.rate_per(F.col("disagree"), F.col("n")), 6))


VOTES = """v AS (SELECT l_orderkey AS item, CASE WHEN l_returnflag = 'A' THEN 'fail' WHEN l_returnflag = 'N' OR l_linenumber > 4 THEN 'ok' END AS state,
   l_quantity AS t FROM lineitem), c AS (SELECT item, count(*) FILTER (state = 'fail') AS fails, count(*) FILTER (state = 'ok') AS oks, count(*) AS votes,
   arg_min(t, t) FILTER (state = 'fail') AS first, quantile_disc(t, 0.5) FILTER (state = 'fail') AS middle FROM v GROUP BY item)"""


def state_votes(t: Tables):
    return t.lineitem.selectExpr("l_orderkey AS item", "CASE WHEN l_returnflag = 'A' THEN 'fail' WHEN l_returnflag = 'N' OR l_linenumber > 4 THEN 'ok' END AS state",
                                 "l_quantity AS t")


@query("unanimous_tally", "A25", f"""
  WITH {VOTES} SELECT item, fails, oks, votes, CASE WHEN fails = votes THEN 'fail' WHEN fails > 0 THEN 'split' WHEN oks > votes // 2 THEN 'ok' END AS state FROM c""")
def unanimous_tally(t):
    return L.unanimous_tally(state_votes(t), ["item"])


@query("lenient_tally", "A26", f"""
  WITH {VOTES} SELECT item, fails, oks, votes, CASE WHEN fails > votes // 2 AND oks = 0 THEN 'fail' WHEN fails > 0 THEN 'split' WHEN oks > votes // 2 THEN 'ok' END AS state FROM c""")
def lenient_tally(t):
    return L.lenient_tally(state_votes(t), ["item"])


@query("pick_break", "A27", f"""
  WITH {VOTES} SELECT item, CASE WHEN fails = votes THEN 'fail' ELSE 'split' END AS answer, CASE WHEN fails = votes THEN middle ELSE first END AS t FROM c WHERE fails > 0""")
def pick_break(t):
    return L.pick_break(state_votes(t), ["item"])


@query("label_agreement", "A28", """
  WITH r AS (SELECT CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END AS label, CASE n_chars % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'REVIEW' WHEN 2 THEN 'FAIL' END AS v,
    CASE WHEN toxic = 1 THEN 'ok' ELSE 'fail' END AS st, CASE WHEN doc_id % 6 > 0 THEN (n_chars % 50)::DOUBLE END AS tt,
    CASE WHEN doc_id % 2 = 0 THEN 10.0::DOUBLE END AS lo, CASE WHEN doc_id % 2 = 0 THEN 40.0::DOUBLE END AS hi FROM labels JOIN documents USING (doc_id))
  SELECT label, CASE WHEN label = 'PASS' THEN CASE v WHEN 'PASS' THEN 'agree' WHEN 'REVIEW' THEN 'deferred' ELSE 'miss' END
    WHEN v = 'FAIL' AND st = 'fail' AND tt >= coalesce(lo, 0) AND (hi IS NULL OR tt <= hi) THEN 'agree' ELSE 'miss' END AS outcome, count(*) AS n FROM r GROUP BY ALL""")
def label_agreement(t):
    r = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").selectExpr(
        "CASE WHEN quality = 1 THEN 'PASS' ELSE 'FAIL' END AS label", "CASE n_chars % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'REVIEW' WHEN 2 THEN 'FAIL' END AS v",
        "CASE WHEN toxic = 1 THEN 'ok' ELSE 'fail' END AS st", "CASE WHEN doc_id % 6 > 0 THEN double(n_chars % 50) END AS tt",
        "CASE WHEN doc_id % 2 = 0 THEN 10.0D END AS lo", "CASE WHEN doc_id % 2 = 0 THEN 40.0D END AS hi")
    c = F.col
    return r.groupBy("label", D.label_agreement(c("label"), c("v"), c("st"), c("tt"), c("lo"), c("hi")).alias("outcome")).agg(n("n"))


@query("row_contract", "P3", """
  SELECT CASE WHEN o_orderkey % 4 <> 1 OR o_orderstatus NOT IN ('F', 'O') THEN 'unsupported ledger row' WHEN o_custkey % 9 = 0 THEN 'row has no identity' END AS breach,
    count(*) AS n FROM orders GROUP BY ALL""")
def row_contract(t):
    d = t.orders.selectExpr("int(o_orderkey % 4) AS schema_version", "o_orderstatus AS row_type", "IF(o_custkey % 9 = 0, ' ', string(o_custkey)) AS id")
    return C.row_contract(d, "schema_version", "row_type", "id", ("F", "O")).groupBy("breach").agg(n("n"))


@query("reserved_clash", "P4", """
  SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click')""")
def reserved_clash(t):
    d = t.events.select("event_id", "event_type", F.create_map(F.expr("CASE event_type WHEN 'view' THEN 'seq' WHEN 'click' THEN 'ts' ELSE 'note' END"), "props").alias("payload"))
    return C.reserved_clash(d, "payload", ("schema", "run", "seq", "ts", "kind", "step")).select("event_id", "event_type")


@query("fingerprint", "P9,M6", """
  SELECT c_custkey, 'sha256:' || substr(sha256(c_name), 1, 12) AS who, c_mktsegment AS segment FROM customer""")
def fingerprint(t):
    d = t.customer.select("c_custkey", F.create_map(F.lit("voice"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")).alias("payload"))
    s = C.scrub(F.col("payload"))
    return d.select("c_custkey", s["voice"].alias("who"), s["segment"].alias("segment"))


@query("raw_identity", "P10", """
  SELECT page_id % 3 = 0 AS raw_id, (url LIKE '%/fr/%') AS local_path, count(*) AS n FROM pages GROUP BY ALL""")
def raw_identity(t):
    d = t.pages.select("page_id", F.create_map(
        F.lit("voice_id"), F.expr("IF(page_id % 3 = 0, string(page_id), concat('sha256:', substr(sha2(url, 256), 1, 12)))"),
        F.lit("where"), F.expr("IF(url LIKE '%/fr/%', concat('/home/', url), 'out/clip')")).alias("payload"))
    return C.raw_identity(d, "payload").groupBy("raw_id", "local_path").agg(n("n"))


@query("read_waivers", "P12", """
  SELECT c_nationkey, held, count(*) AS n, count(DISTINCT who) AS people FROM (SELECT c_nationkey, c_custkey % 4 <> 0 AND c_custkey % 5 <> 0 AS held,
    CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 5 <> 0 THEN c_name END AS who FROM customer) t GROUP BY ALL""")
def read_waivers(t):
    d = t.customer.selectExpr("c_nationkey", "concat(IF(c_custkey % 5 = 0, 'not a waiver', substr(sha2(c_name, 256), 1, 12)), ':',"
                              " IF(c_custkey % 4 = 0, '  ', c_name), ':', c_mktsegment, ' looked') AS line")
    return C.read_waivers(d).groupBy("c_nationkey", "held").agg(n("n"), F.countDistinct("waived_by").alias("people"))


@query("estimate", "A43", """
  SELECT p_type AS spot, count(*) AS scenes, cast(coalesce(sum(CASE p_size % 4 WHEN 0 THEN 64 WHEN 1 THEN 100 WHEN 2 THEN 100 END), 0) AS BIGINT) AS cents,
    count(*) FILTER (p_size % 4 = 3) AS unpriced FROM part GROUP BY p_type""")
def estimate(t):
    d = t.part.selectExpr("p_type AS spot", "CASE p_size % 4 WHEN 0 THEN 'google/gemini-omni-flash' WHEN 1 THEN 'alibaba/wan-3.0/text-to-video' "
                          "WHEN 2 THEN 'bytedance/seedance-2.0/text-to-video' ELSE 'nobody' END AS engine")
    return C.estimate(d, inline_table(t.spark, list(C.PRICES.items()), "engine STRING, cents BIGINT"), ["spot"])


@query("money_cents", "M3", """
  SELECT l_linenumber, cast(sum(cast(round_even(cast(l_extendedprice AS DECIMAL(20,4)) * 100, 0) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1""")
def money_cents(t):
    return t.lineitem.groupBy("l_linenumber").agg(F.sum(S.cents(F.col("l_extendedprice"))).alias("cents"))


@query("iso_days", "M1,M2", """
  WITH r AS (SELECT CASE o_custkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m') END AS ts FROM orders)
  SELECT CASE WHEN ts IS NULL OR length(ts) < 10 THEN 'none' WHEN length(ts) = 10 THEN 'date' ELSE 'time' END AS precision_class,
   CASE WHEN length(ts) >= 10 THEN substr(ts, 1, 10) END AS day, count(*) AS n FROM r GROUP BY ALL""")
def iso_days(t):
    r = t.orders.selectExpr("CASE o_custkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN concat(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\"), '.000Z')"
                            " WHEN 2 THEN date_format(o_orderdate, 'yyyy-MM') END AS ts")
    return r.groupBy(S.ts_precision(F.col("ts")).alias("precision_class"), S.day_of_iso(F.col("ts")).cast("string").alias("day")).agg(n("n"))


@query("url_parts", "M10", """
  SELECT page_id, left(list_last(string_split(url, '/')), greatest(length(list_last(string_split(url, '/'))) - 4, 0)) AS clip,
    CASE WHEN len(string_split(url, '-')) >= 2 THEN string_split(url, '-')[-2] END AS engine FROM pages""")
def url_parts(t):
    return t.pages.select("page_id", S.clip_of_url(F.col("url")).alias("clip"), S.engine_of_clip(F.col("url")).alias("engine"))


@query("map_overlay", "M8,M9", """
  SELECT p_partkey, CASE WHEN p_size > 25 THEN 'up' ELSE 'down' END AS hand, CASE WHEN p_size > 40 THEN 'up' ELSE 'flat' END AS bg,
   p_size % 2 = 0 AS same, p_size % 3 = 0 AS ordered FROM part""")
def map_overlay(t):
    d = t.part.selectExpr("p_partkey", "map('hand', 'down', 'bg', 'flat') AS base",
                          "map_filter(map('hand', IF(p_size > 25, 'up', NULL), 'bg', IF(p_size > 40, 'up', NULL)), (k, v) -> v IS NOT NULL) AS over",
                          "IF(p_size % 2 = 0, array('b', 'a'), array('a', 'c')) AS given", "IF(p_size % 3 = 0, array('x', 'a', 'b'), array('b', 'x', 'a')) AS played")
    m = S.overlay(F.col("base"), F.col("over"))
    ab = F.array(F.lit("a"), F.lit("b"))
    return d.select("p_partkey", m["hand"].alias("hand"), m["bg"].alias("bg"), S.same_members(F.col("given"), ab).alias("same"),
                    S.in_given_order(F.col("played"), ab).alias("ordered"))


@query("canonical_hash", "M6", """
  SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS row_hash FROM orders""")
def canonical_hash(t):
    return t.orders.select("o_orderkey", S.canonical_hash("o_orderstatus", "o_custkey").alias("row_hash"))
