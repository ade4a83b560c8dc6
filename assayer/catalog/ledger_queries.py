"""Process mining over ``events`` read as a run ledger (one run per user)."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayer.catalog.base import Tables, query
from assayer.functions import verdicts as D
from assayer.operators import ledger as L
from assayer.operators import setops as U
from assayer.operators import validate as C
from assayer.operators.ordered import chunk_of, day_of
from assayer.plans import replay as R
from assayer.session import shared_dir
from assayer.sources import sinks

c = F.col


def n(name):
    return F.count(F.lit(1)).alias(name)


def all_edges(t: Tables):
    return L.edges(t.spark)


@query("ledger_order", "K4", "SELECT run, seq, id FROM fx_ledger")
def ledger_order(t):
    return t.ledger.select("run", "seq", "id").orderBy("run", "seq")


@query("classify_rows", "P5", """
  SELECT CASE WHEN kind = 'request' AND k >= 50 THEN 'scene request' WHEN kind = 'request' THEN 'bed request' WHEN kind = 'landing' THEN 'scene landing'
    WHEN kind = 'gate' THEN 'ship gate' END AS row_kind, count(*) AS n FROM fx_ledger GROUP BY 1""")
def classify_rows(t):
    rules = [("scene request", (c("kind") == "request") & (c("k") >= 50)), ("bed request", c("kind") == "request"),
             ("scene landing", c("kind") == "landing"), ("ship gate", c("kind") == "gate")]
    return C.classify_rows(t.ledger_rows, rules).groupBy("row_kind").agg(n("n"))


@query("mask_fields", "P11", "SELECT '<run>' AS run, '<ts>' AS ts, step, kind, count(*) AS n FROM fx_ledger GROUP BY step, kind")
def mask_fields(t):
    return C.mask_fields(t.ledger_rows.select("run", "ts", "step", "kind"), ["run", "ts"]).groupBy("run", "ts", "step", "kind").agg(n("n"))


@query("trail_moves", "W3", """
  WITH tr AS (SELECT o_orderkey AS id, string_split(CASE o_orderkey % 3 WHEN 0 THEN 'board,render,closer,build' WHEN 1 THEN 'board,render,render,closer'
     ELSE 'board' END, ',') AS s FROM orders)
  SELECT id, s[i] AS src, s[i + 1] AS dst FROM (SELECT id, s, unnest(range(1, len(s))) AS i FROM tr) x""")
def trail_moves(t):
    d = t.orders.selectExpr("o_orderkey AS id", "split(CASE o_orderkey % 3 WHEN 0 THEN 'board,render,closer,build' WHEN 1 THEN 'board,render,render,closer' ELSE 'board' END, ',') AS trail")
    return L.trail_moves(d, "trail", ["id"])


@query("directly_follows", "L3,W3", "SELECT src, dst, count(*) AS moves FROM fx_moves GROUP BY src, dst")
def directly_follows(t):
    return L.directly_follows(L.row_moves(t.ledger))


@query("unmapped_moves", "J7", """
  SELECT run, seq, src, dst FROM fx_moves m WHERE NOT EXISTS (SELECT 1 FROM fx_edges e WHERE e.src = m.src AND e.dst = m.dst)""")
def unmapped_moves(t):
    return L.unmapped_moves(L.row_moves(t.ledger), all_edges(t)).select("run", "seq", "src", "dst")


@query("conformance", "L4", """
  SELECT run, count(*) AS moves, count(e.src) AS mapped FROM fx_moves m LEFT JOIN fx_edges e ON e.src = m.src AND e.dst = m.dst GROUP BY run""")
def conformance(t):
    return L.conformance(L.row_moves(t.ledger), all_edges(t), ["run"])


@query("replay_rows", "L1,A39", """
  WITH g AS (SELECT run, seq, seq - 1 - coalesce(lag(seq) OVER (PARTITION BY run ORDER BY seq), 0) AS d FROM fx_ledger WHERE k % 10 > 0)
  SELECT l.run, l.rows, coalesce(m.moves, 0) AS moves, coalesce(m.moves - m.mapped, 0) AS unmapped, l.gaps, l.last_step FROM
   (SELECT run, count(*) AS rows, (SELECT count(*) FROM g WHERE g.run = f.run AND d <> 0) AS gaps, arg_max(step, seq) AS last_step FROM fx_ledger f WHERE k % 10 > 0 GROUP BY run) l
   LEFT JOIN (SELECT run, count(*) AS moves, count(e.src) AS mapped FROM (SELECT run, step AS src, lead(step) OVER (PARTITION BY run ORDER BY seq) AS dst FROM fx_ledger
      WHERE k % 10 > 0) x LEFT JOIN fx_edges e USING (src, dst) WHERE dst IS NOT NULL GROUP BY run) m USING (run)""")
def replay_rows(t):
    return R.replay_rows(t.ledger.where("k % 10 > 0"), all_edges(t))


@query("replay_runs", "L1", """
  WITH e AS (SELECT run, seq, string_split(CASE k % 3 WHEN 0 THEN 'board,render,closer' WHEN 1 THEN 'board,closer' ELSE 'board,render,render,ledger' END, ',') AS s
     FROM fx_ledger WHERE kind = 'view'),
  m AS (SELECT run, s[i] AS src, s[i + 1] AS dst FROM (SELECT run, s, unnest(range(1, len(s))) AS i FROM e) x),
  mm AS (SELECT run, count(*) AS moves, count(*) - count(fx_edges.src) AS unmapped FROM m LEFT JOIN fx_edges USING (src, dst) GROUP BY run),
  b AS (SELECT run, count(*) AS bad FROM fx_ledger d WHERE kind = 'landing' AND NOT coalesce((SELECT arg_max(k % 2 = 0, seq) FROM fx_ledger g WHERE g.run = d.run AND g.seq < d.seq
      AND g.kind = 'gate'), false) GROUP BY run)
  SELECT l.run, count(*) AS rows, coalesce(max(moves), 0) AS moves, coalesce(max(unmapped), 0) AS unmapped, count(*) FILTER (kind = 'view') AS stops,
    count(*) FILTER (kind = 'request') AS reentries, 0::BIGINT AS notes, coalesce(max(bad), 0) AS unproven_deliveries,
    CASE WHEN count(*) FILTER (kind = 'view') > 0 THEN 'close' END AS "end", arg_max(step, seq) FILTER (kind = 'view') AS last_step
  FROM fx_ledger l LEFT JOIN mm USING (run) LEFT JOIN b USING (run) GROUP BY l.run""")
def replay_runs(t):
    led = t.ledger.selectExpr(
        "run", "seq", "CASE kind WHEN 'view' THEN 'close' WHEN 'landing' THEN 'deliver' WHEN 'request' THEN 'resumed' ELSE kind END AS kind",
        "IF(kind = 'gate', 'ship_gate', step) AS step", "k % 2 = 0 AS pass",
        "IF(kind = 'view', split(CASE k % 3 WHEN 0 THEN 'board,render,closer' WHEN 1 THEN 'board,closer' ELSE 'board,render,render,ledger' END, ','), NULL) AS trail")
    return R.replay_runs(led, all_edges(t))


@query("seq_gaps", "W1", """
  SELECT run, coalesce(p, 0) AS after_seq, seq FROM (SELECT run, seq, lag(seq) OVER (PARTITION BY run ORDER BY seq) AS p FROM fx_ledger WHERE k % 7 > 0) t
  WHERE seq <> coalesce(p, 0) + 1""")
def seq_gaps(t):
    return L.seq_gaps(t.ledger.where("k % 7 > 0"))


@query("attempt_ordinal", "W2", """
  SELECT run, engine, id, roll, nth FROM (SELECT run, k % 3 AS engine, id, k % 6 + 1 AS roll, row_number() OVER (PARTITION BY run, k % 3 ORDER BY id) AS nth
    FROM fx_ledger WHERE kind = 'request') t WHERE roll > nth""")
def attempt_ordinal(t):
    req = t.ledger_rows.where("kind = 'request'").selectExpr("run", "k % 3 AS engine", "id", "k % 6 + 1 AS roll")
    return L.missing_rolls(L.attempt_ordinal(req, ["run", "engine"], ["id"], chunk_of("id")), "roll")


@query("last_before", "J11", """
  SELECT run, seq, (SELECT max(g.seq) FROM fx_ledger g WHERE g.run = d.run AND g.seq < d.seq AND g.kind = 'gate') AS gate_seq,
    (SELECT arg_max(g.cents % 2 = 0, g.seq) FROM fx_ledger g WHERE g.run = d.run AND g.seq < d.seq AND g.kind = 'gate') AS gate_pass
  FROM fx_ledger d WHERE kind = 'landing'""")
def last_before(t):
    d = L.last_before(t.ledger.select("run", "seq", "kind", "cents"), c("kind") == "landing", c("kind") == "gate", c("cents") % 2 == 0)
    return d.select("run", "seq", c("found.at").alias("gate_seq"), c("found.value").alias("gate_pass"))


@query("exists_before", "J12", """
  SELECT id, EXISTS (SELECT 1 FROM fx_ledger d WHERE d.kind = 'landing' AND d.k = r.k AND cast(d.ts AS DATE) < cast(r.ts AS DATE)) AS after
  FROM fx_ledger r WHERE kind = 'request'""")
def exists_before(t):
    rows = t.ledger_rows.withColumn("day", day_of("ts"))
    d = L.exists_before(rows.where("kind = 'request'"), rows.where("kind = 'landing'").select("k", "day"), ["k"])
    return d.select("id", "after")


@query("unlanded_by_id", "J5", """
  SELECT id, run, k FROM fx_ledger r WHERE kind = 'request' AND NOT EXISTS (SELECT 1 FROM fx_ledger l WHERE l.kind = 'landing' AND l.run = r.run AND l.k = r.k)""")
def unlanded_by_id(t):
    rows = t.ledger_rows.withColumn("request_id", F.concat_ws("-", "run", "k"))
    return L.unlanded_by_id(rows.where("kind = 'request'"), rows.where("kind = 'landing'")).select("id", "run", "k")


@query("unlanded_by_key", "J6", """
  WITH q AS (SELECT run AS scene, 'e' || (k % 3) AS engine, count(*) AS asked FROM fx_ledger WHERE kind = 'request' GROUP BY ALL),
  l AS (SELECT run AS scene, CASE WHEN k % 4 > 0 THEN 'e' || (k % 3) END AS engine FROM fx_ledger WHERE kind = 'landing'),
  h AS (SELECT q.*, (SELECT count(*) FROM l WHERE l.scene = q.scene AND (l.engine = q.engine OR l.engine IS NULL)) AS have FROM q)
  SELECT scene, engine, asked, have, greatest(0, asked - have) AS unlanded FROM h""")
def unlanded_by_key(t):
    rows = t.ledger_rows.selectExpr("kind", "run AS scene", "IF(kind = 'landing' AND k % 4 = 0, NULL, concat('e', k % 3)) AS engine")
    return L.unlanded_by_key(rows.where("kind = 'request'"), rows.where("kind = 'landing'"))


@query("kind_counts", "A39", """
  SELECT run, count(*) AS rows, count(*) FILTER (kind = 'request') AS request, count(*) FILTER (kind = 'landing') AS landing,
    count(*) FILTER (kind = 'gate') AS gate, count(*) FILTER (kind = 'view') AS "view", arg_max(step, seq) AS last_step FROM fx_ledger GROUP BY run""")
def kind_counts(t):
    return L.kind_counts(t.ledger, ["request", "landing", "gate", "view"])


@query("never_recorded", "A40", """
  WITH g AS (SELECT run, CASE WHEN count(*) FILTER (kind = 'landing' AND k > 60) = 0 THEN 1 ELSE 0 END AS d, count(*) FILTER (kind = 'request' AND k % 10 = 0) AS f,
     CASE WHEN count(*) FILTER (step = 'ad_gates') > 0 AND count(*) FILTER (kind = 'gate' AND cents > 12000) = 0 THEN 1 ELSE 0 END AS l FROM fx_ledger GROUP BY run)
  SELECT run, concat_ws('; ', CASE WHEN d > 0 THEN 'delivery ' || d END, CASE WHEN f > 0 THEN 'request ids ' || f END, CASE WHEN l > 0 THEN 'readings ' || l END) AS never FROM g""")
def never_recorded(t):
    def count_if(cond):
        return F.sum(cond.cast("bigint"))
    rules = {"delivery": count_if((c("kind") == "landing") & (c("k") > 60)) == 0,
             "request ids": count_if((c("kind") == "request") & (c("k") % 10 == 0)),
             "readings": (count_if(c("step") == "ad_gates") > 0) & (count_if((c("kind") == "gate") & (c("cents") > 12000)) == 0)}
    d = L.never_recorded(t.ledger_rows, rules)
    return d.select("run", F.array_join(F.transform(F.map_entries("never"), lambda e: F.concat_ws(" ", e["key"], e["value"])), "; ").alias("never"))


@query("over_bound", "A41", """
  SELECT 're-rolled' AS what, run || ' on e' || (k % 2) AS subject, count(*) AS n FROM fx_ledger WHERE kind = 'request' AND k % 5 = 0 GROUP BY run, k % 2 HAVING count(*) > 1
  UNION ALL SELECT 'sent back', run::VARCHAR, count(*) FROM fx_ledger WHERE kind = 'gate' AND k % 7 = 0 GROUP BY run HAVING count(*) > 1
  UNION ALL SELECT 'withdrawn', run::VARCHAR, count(*) FROM fx_ledger WHERE kind = 'landing' AND k % 2 = 0 GROUP BY run HAVING count(*) > 3""")
def over_bound(t):
    r = t.ledger_rows
    return L.over_bound(r.where("kind = 'request' AND k % 5 = 0").selectExpr("string(run) AS scene", "concat('e', k % 2) AS engine"),
                        r.where("kind = 'gate' AND k % 7 = 0").selectExpr("run AS spot"), r.where("kind = 'landing' AND k % 2 = 0").selectExpr("run AS spot"))


@query("delivered_versions", "A45", """
  WITH RECURSIVE w AS (SELECT run AS ad, id AS ord, k % 6 + 1 AS a, row_number() OVER (PARTITION BY run ORDER BY id) AS nth FROM fx_ledger WHERE kind = 'landing' AND k % 4 = 0),
  g AS (SELECT run AS ad, arg_max(k % 3 + 1, id) AS g FROM fx_ledger WHERE kind = 'gate' GROUP BY run),
  s AS (SELECT w.ad, nth, a, coalesce(g, 1) AS pulled, greatest(coalesce(g, 1), a) AS high FROM w LEFT JOIN g USING (ad) WHERE nth = 1
    UNION ALL SELECT w.ad, w.nth, w.a, s.high, greatest(s.high, w.a) FROM s JOIN w ON w.ad = s.ad AND w.nth = s.nth + 1)
  SELECT ad, pulled::INT AS version FROM s UNION SELECT ad, a::INT FROM s""")
def delivered_versions(t):
    w = t.ledger_rows.where("kind = 'landing' AND k % 4 = 0").selectExpr("run AS ad", "concat('replaced by v', k % 6 + 1, ', see dev9') AS reason", "id AS ord")
    g = t.ledger_rows.where("kind = 'gate'").selectExpr("run AS ad", "int(k % 3 + 1) AS version", "id AS ord")
    return L.delivered_versions(w, g)


@query("ungated_deliveries", "A46", """
  WITH d AS (SELECT DISTINCT run AS ad, k % 5 AS v FROM fx_ledger WHERE kind = 'landing'), g AS (SELECT DISTINCT run AS ad, k % 5 AS v FROM fx_ledger WHERE kind = 'gate' AND k % 2 = 0)
  SELECT 'no gate reading' AS issue, ad, v AS version FROM d WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.ad = d.ad AND g.v = d.v)
  UNION ALL SELECT DISTINCT 'pass without reading', run, NULL FROM fx_ledger WHERE kind = 'view' AND run NOT IN (SELECT ad FROM g)
  UNION ALL SELECT DISTINCT 'review without verdict', run, NULL FROM fx_ledger WHERE step = 'review' AND k % 9 = 0""")
def ungated_deliveries(t):
    r = t.ledger_rows.selectExpr("run AS ad", "k % 5 AS version", "kind", "step", "k", "IF(k % 9 = 0, NULL, 'ok') AS verdict")
    return L.ungated_deliveries(r.where("kind = 'landing'"), r.where("kind = 'gate' AND k % 2 = 0"), r.where("kind = 'view'"), r.where("step = 'review'"))


@query("version_gaps", "W24", """
  SELECT ad, coalesce(p, 0) + 1 AS first, v - 1 AS last FROM (SELECT ad, v, lag(v) OVER (PARTITION BY ad ORDER BY v) AS p
    FROM (SELECT DISTINCT run AS ad, k AS v FROM fx_ledger WHERE kind = 'gate' AND k >= 1) x) y WHERE v > coalesce(p, 0) + 1""")
def version_gaps(t):
    return L.version_gaps(t.ledger_rows.where("kind = 'gate'").selectExpr("run AS ad", "k AS version"))


@query("last_per_group", "W23", """
  SELECT run, arg_max(id, seq) AS id, arg_max(cents, seq) AS cents FROM fx_ledger WHERE kind = 'gate' GROUP BY run""")
def last_per_group(t):
    return L.last_per_group(t.ledger_rows.where("kind = 'gate'"), ["run"], ["ts", "id"], ["id", "cents"])


@query("out_of_order_gates", "W27", """
  SELECT k, max(id) FILTER (kind = 'landing') AS last_early, min(id) FILTER (kind = 'gate') AS first_late FROM fx_ledger GROUP BY k, run % 50
  HAVING max(id) FILTER (kind = 'landing') < min(id) FILTER (kind = 'gate')""")
def out_of_order_gates(t):
    r = t.ledger_rows.withColumn("g", F.struct("k", (c("run") % 50).alias("r")))
    return L.out_of_order_gates(r, "g", c("kind") == "landing", c("kind") == "gate", "id").select("g.k", "last_early", "first_late")


SPEND = """r AS (SELECT run, seq, CASE WHEN k <> 13 THEN cents END AS cents, sum(CASE WHEN k <> 13 THEN cents END) OVER (PARTITION BY run ORDER BY seq) AS spent
    FROM fx_ledger WHERE kind = 'request'), b AS (SELECT run, min(seq) AS breach FROM r WHERE cents IS NULL OR spent > 30000 GROUP BY run),
  s AS (SELECT r.*, CASE WHEN breach IS NULL OR seq < breach THEN 'sent' WHEN seq = breach THEN 'refused' ELSE 'not sent' END AS state FROM r LEFT JOIN b USING (run))"""


@query("running_spend", "W25", f"WITH {SPEND} SELECT run, seq, cast(coalesce(spent, 0) AS BIGINT) AS spent, state FROM s")
def running_spend(t):
    q = t.ledger.where("kind = 'request'").selectExpr("run", "seq", "IF(k <> 13, cents, NULL) AS cents")
    return L.running_spend(q, 30000).select("run", "seq", "spent", "state")


@query("spend_summary", "W25", f"""
  WITH {SPEND} SELECT run, cast(coalesce(sum(cents) FILTER (state = 'sent'), 0) AS BIGINT) AS sent_cents, min(seq) FILTER (state = 'refused') AS refused_seq,
    count(*) FILTER (state = 'not sent') AS not_sent FROM s GROUP BY run""")
def spend_summary(t):
    q = t.ledger.where("kind = 'request'").selectExpr("run", "seq", "IF(k <> 13, cents, NULL) AS cents")
    return L.spend_summary(q, 30000)


@query("attempt_vs_outcome", "A48", """
  SELECT run, arg_min(cents % 3 > 0, seq) AS first_ok, arg_max(cents % 3 > 0, seq) AS final_ok, count(*) FILTER (cents % 3 = 0) AS blocked FROM fx_ledger GROUP BY run""")
def attempt_vs_outcome(t):
    return L.attempt_vs_outcome(t.ledger, c("cents") % 3 > 0, c("cents") % 3 == 0)


@query("request_outcomes", "L6", """
  WITH l AS (SELECT run, k, CASE cents % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'REFUSED' WHEN 2 THEN 'TIMEOUT' ELSE 'FAILED' END AS status, id FROM fx_ledger WHERE kind = 'landing')
  SELECT id, coalesce((SELECT arg_max(status, l.id) FROM l WHERE l.run = r.run AND l.k = r.k), 'none') AS status FROM fx_ledger r WHERE kind = 'request'""")
def request_outcomes(t):
    r = t.ledger_rows.withColumn("request_id", F.concat_ws("-", "run", "k"))
    landings = r.where("kind = 'landing'").selectExpr("request_id", "id AS seq", "CASE cents % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'REFUSED' WHEN 2 THEN 'TIMEOUT' ELSE 'FAILED' END AS status")
    return L.request_outcomes(r.where("kind = 'request'"), landings).select("id", "status")


@query("redactions", "L7", """
  WITH nt AS (SELECT run, unnest([seq - 1, seq - 3]) AS seq FROM fx_ledger WHERE kind = 'gate' AND k % 8 = 0)
  SELECT l.run, l.seq, count(nt.seq) AS notes FROM fx_ledger l LEFT JOIN nt ON nt.run = l.run AND nt.seq = l.seq GROUP BY l.run, l.seq""")
def redactions(t):
    led = t.ledger
    notes = led.where("kind = 'gate' AND k % 8 = 0").select("run", F.array(c("seq") - 1, c("seq") - 3).alias("seqs"))
    return L.redactions(led, notes).select("run", "seq", "notes")


@query("outside_model", "L5", "SELECT kind, count(*) AS rows FROM fx_ledger WHERE kind NOT IN ('request', 'landing', 'gate') GROUP BY kind")
def outside_model(t):
    return L.outside_model(t.ledger_rows, ["request", "landing", "gate"])


HISTORY = """h AS (SELECT 's' || (user_id % 7) AS shoot, event_id AS line, event_type, json_extract_string(props, '$.k')::BIGINT AS k, strftime(ts, '%Y-%m-%d') AS day,
    CASE event_id % 5 WHEN 0 THEN 'the author asked' WHEN 1 THEN 'it timed out' WHEN 2 THEN 'hands look odd' END AS why FROM events),
  dl AS (SELECT shoot, 'spot' || (k % 9) AS spot, day FROM h WHERE event_type = 'purchase' AND line % 2 = 1
    UNION ALL SELECT shoot, unnest(['spot' || (k % 9), 'spot' || ((k + 1) % 9)]), day FROM h WHERE event_type NOT IN ('click', 'purchase', 'error', 'view')),
  fd AS (SELECT shoot, spot, min(day) AS d0 FROM dl GROUP BY ALL),
  rq AS (SELECT *, row_number() OVER (PARTITION BY shoot, k % 9, k % 3, k % 2 ORDER BY line) AS nth FROM h WHERE event_type = 'click'),
  mv AS (SELECT rq.shoot, CASE WHEN line % 5 = 0 AND d0 < day THEN 'review' WHEN line % 5 IN (0, 2) THEN 'eye' ELSE 'render' END AS src, 'render' AS dst, line
      FROM rq LEFT JOIN fd ON fd.shoot = rq.shoot AND fd.spot = 'spot' || (k % 9) WHERE nth > 1 OR why IS NOT NULL
    UNION ALL SELECT shoot, 'ad_gates', 'eye', line FROM h WHERE event_type = 'error' AND line % 3 = 0
    UNION ALL SELECT shoot, 'ship_gate', 'deliver', line FROM h WHERE event_type = 'purchase' AND line % 2 = 1 AND line % 3 = 0
    UNION ALL SELECT shoot, 'ledger', 'board', line FROM h WHERE event_type = 'purchase' AND line % 2 = 1
    UNION ALL SELECT shoot, 'deliver', 'review', line FROM h, range(2) WHERE event_type NOT IN ('click', 'purchase', 'error', 'view')
    UNION ALL SELECT shoot, 'review', CASE line % 3 WHEN 0 THEN 'closer' WHEN 1 THEN 'render' ELSE 'build' END, line FROM h, range(2) WHERE event_type NOT IN ('click', 'purchase', 'error', 'view'))"""


def history(t: Tables):
    return R.classify_history(t.read("events").selectExpr(
        "concat('s', user_id % 7) AS shoot", "event_id AS line", "event_type", "bigint(get_json_object(props, '$.k')) AS k", "date_format(ts, 'yyyy-MM-dd') AS day"
    ).selectExpr(
        "shoot", "line", "day", "IF(event_type = 'click', 'requests.jsonl', 'landings.jsonl') AS file",
        "CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN 'gated master' WHEN 'purchase' THEN 'master' WHEN 'view' THEN IF(line % 2 = 0, 'glimpse', NULL) ELSE 'withdrawn' END AS kind",
        "CASE event_type WHEN 'click' THEN concat('spot', k % 9, '-', element_at(array('a', 'b', 'c'), int(k % 3 + 1)), IF(line % 4 = 0, '2', '')) WHEN 'purchase' THEN concat('spot', k % 9) END AS scene",
        "IF(k % 2 = 0, 'omni', 'wan3') AS engine", "CAST(NULL AS STRING) AS leg", "CAST(NULL AS STRING) AS status", "CAST(NULL AS STRING) AS url", "CAST(NULL AS INT) AS roll",
        "CAST(NULL AS INT) AS attempt", "IF(event_type = 'click', CASE line % 5 WHEN 0 THEN 'the author asked' WHEN 1 THEN 'it timed out' WHEN 2 THEN 'hands look odd' END, NULL) AS why",
        "CASE WHEN event_type NOT IN ('click', 'error', 'purchase', 'view') THEN CASE line % 3 WHEN 0 THEN 'closer off' WHEN 1 THEN 'scene bad' ELSE 'other' END END AS reason",
        "CASE line % 3 WHEN 0 THEN 'REVIEW, eye approved' WHEN 1 THEN 'PASS' ELSE 'REVIEW' END AS mouth", "IF(line % 2 = 1, 'withdrawn cut', 'none') AS supersedes",
        "IF(line % 3 = 0, 'ship_gate pass', 'ship_gate fail') AS gate", "concat('spot', k % 9) AS ad",
        "array(named_struct('ad', concat('spot', k % 9)), named_struct('ad', concat('spot', (k + 1) % 9))) AS withdrawn"))


@query("replay_history", "L2", f"WITH {HISTORY} SELECT shoot, src, dst, line FROM mv")
def replay_history(t):
    return R.replay_history(history(t)).select("shoot", "src", "dst", "line")


@query("unknown_rows", "L2", f"""
  WITH {HISTORY} SELECT shoot, CASE event_type WHEN 'click' THEN 'requests.jsonl' ELSE 'landings.jsonl' END AS file, line FROM h WHERE event_type = 'view'""")
def unknown_rows(t):
    return R.unknown_rows(history(t))


@query("backed_edges", "U1", f"WITH {HISTORY} SELECT src, dst FROM mv UNION SELECT src, dst FROM fx_moves")
def backed_edges(t):
    return U.backed_edges(R.replay_history(history(t)), L.row_moves(t.ledger))


@query("unbacked_edges", "U2", """
  SELECT src, dst FROM fx_edges WHERE NOT (dst = 'ledger' AND src <> 'review') EXCEPT SELECT src, dst FROM fx_moves""")
def unbacked_edges(t):
    return U.unbacked_edges(all_edges(t), L.stop_edges(t.spark), L.row_moves(t.ledger))


@query("in_every_group", "U3", """
  SELECT k, count(DISTINCT run % 8) AS groups FROM fx_ledger WHERE kind = 'gate' GROUP BY k
  HAVING count(DISTINCT run % 8) = (SELECT count(DISTINCT run % 8) FROM fx_ledger WHERE kind = 'gate')""")
def in_every_group(t):
    return U.in_every_group(t.ledger_rows.where("kind = 'gate'").selectExpr("run % 8 AS g", "k"), "g", "k")


@query("union_ledgers", "U4", """
  SELECT id, cents, NULL AS run FROM fx_ledger WHERE kind = 'request' UNION ALL SELECT id, NULL, run FROM fx_ledger WHERE kind = 'gate'""")
def union_ledgers(t):
    r = t.ledger_rows
    return U.union_ledgers(r.where("kind = 'request'").select("id", "cents"), r.where("kind = 'gate'").select("id", "run"))


@query("distinct_sources", "U5", """SELECT DISTINCT run, '{"k":' || k || ',"kind":"' || kind || '"}' AS ref FROM fx_ledger""")
def distinct_sources(t):
    return U.distinct_sources(t.ledger_rows, ["run"], ["kind", "k"])


@query("cohort_complete", "U6", """
  SELECT k, count(*) AS expected, count(e.custkey) AS existing, count(*) = count(e.custkey) AS complete FROM (SELECT DISTINCT k, run FROM fx_ledger) x
  LEFT JOIN (SELECT DISTINCT o_custkey AS custkey FROM orders) e ON e.custkey = x.run GROUP BY k""")
def cohort_complete(t):
    return U.cohort_complete(t.ledger_rows.select("k", c("run").alias("key")), t.orders.select(c("o_custkey").alias("key")), "k", "key")


@query("golden_diff", "U7", """
  WITH a AS (SELECT step, k % 20 AS k, count(*) AS n FROM fx_ledger WHERE run % 2 = 0 GROUP BY ALL), b AS (SELECT step, k % 20 AS k, count(*) AS n FROM fx_ledger WHERE run % 2 = 1 GROUP BY ALL)
  SELECT step, k, CASE WHEN coalesce(a.n, 0) > coalesce(b.n, 0) THEN 'missing' ELSE 'added' END AS side, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS copies
  FROM a FULL JOIN b USING (step, k) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def golden_diff(t):
    r = t.ledger_rows.selectExpr("step", "k % 20 AS k", "run")
    return U.golden_diff(r.where("run % 2 = 0").drop("run"), r.where("run % 2 = 1").drop("run"))


@query("only_grew", "U8", """
  SELECT run, id, 1::BIGINT AS copies FROM fx_ledger WHERE k < 60 AND k % 11 = 0""")
def only_grew(t):
    r = t.ledger_rows
    return U.only_grew(r.where("k < 60").select("run", "id"), r.where("k % 11 > 0").select("run", "id"))


@query("unseen_flags", "U9", """
  SELECT id, run, k FROM fx_ledger f WHERE kind = 'gate' AND NOT EXISTS (SELECT 1 FROM fx_ledger s WHERE s.step = 'review' AND s.run = f.run AND s.k = f.k)""")
def unseen_flags(t):
    r = t.ledger_rows
    return U.unseen_flags(r.where("kind = 'gate'"), r.where("step = 'review'"), ["run", "k"]).select("id", "run", "k")


@query("append_conflicts", "S8", """
  WITH e AS (SELECT k AS id, run % 3 AS v FROM fx_ledger WHERE kind = 'request'), p AS (SELECT k AS id, run % 3 AS v FROM fx_ledger WHERE kind = 'gate')
  SELECT id, 'proposed twice' AS reason FROM p GROUP BY id HAVING count(*) > 1 UNION ALL SELECT id, 'recorded twice' FROM e WHERE id IN (SELECT id FROM p) GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT DISTINCT p.id, 'recorded with other content' FROM p JOIN e USING (id) WHERE p.v <> e.v""")
def append_conflicts(t):
    r = t.ledger_rows.selectExpr("k AS id", "run % 3 AS v", "kind", "run")
    return sinks.conflicts(r.where("kind = 'request'").select("id", "v"), r.where("kind = 'gate'").select("id", "v"), "id")


@query("append_twice", "S8", """
  SELECT o_orderkey AS id, o_orderstatus AS v FROM orders""")
def append_twice(t):
    rows, target = t.orders.select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("v")), shared_dir(t.spark, "append")
    for offered in ("id % 3 = 0", "id % 3 = 0", "true"):
        sinks.append_idempotent(target, rows.where(offered), "id")
    return t.spark.read.schema(rows.schema).parquet(target)


@query("append_unseen", "S8", """
  SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def append_unseen(t):
    p = t.orders.select("o_orderkey", "o_orderstatus")
    return sinks.unseen(t.lineitem.select(c("l_orderkey").alias("o_orderkey")), p, "o_orderkey")


STEPS = ("board", "render", "closer", "build", "ad_gates", "eye", "ship_gate", "deliver", "review")
CAUSES = ("scene", "closer", "lag", "directional", "replay", "other")


@query("next_step", "P17", f"""
  WITH l AS (SELECT run, seq, k, cents, ({list(STEPS)})[((cents + k) % 9 + 1)::INT] AS step, ({list(CAUSES)})[(k % 6 + 1)::INT] AS cause FROM fx_ledger),
  v AS (SELECT run, seq, step, cause, lead(step) OVER (PARTITION BY run ORDER BY seq) AS actual, cents % 3 > 0 AS pass, k % 2 = 0 AS failed, k % 4 AS attempts, cents % 7 = 0 AS override,
     CASE k % 5 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'review' WHEN 3 THEN 'noface' ELSE 'unreadable' END AS mouth, (k % 30) / 100.0 AS lag,
     CASE k % 3 WHEN 0 THEN 'render' WHEN 1 THEN 'elsewhere' ELSE 'build' END AS back FROM l)
  SELECT step, CASE step WHEN 'board' THEN CASE WHEN pass THEN 'render' ELSE 'ledger' END WHEN 'render' THEN CASE WHEN NOT failed THEN 'closer' WHEN attempts <= {D.MAX_SCENE_REROLLS} THEN 'render' ELSE 'ledger' END
    WHEN 'closer' THEN CASE WHEN pass THEN 'build' ELSE 'ledger' END WHEN 'build' THEN CASE WHEN pass THEN 'ad_gates' ELSE 'ledger' END
    WHEN 'ad_gates' THEN CASE WHEN mouth IN ('fail', 'noface', 'unreadable') THEN 'ledger' WHEN mouth = 'review' OR lag >= {D.LAG_FIX} THEN 'eye' ELSE 'ship_gate' END
    WHEN 'eye' THEN CASE WHEN pass THEN 'ship_gate' WHEN cause = 'scene' AND attempts <= {D.MAX_EYE_REJECTS} THEN 'render' WHEN cause = 'closer' AND attempts <= {D.MAX_EYE_REJECTS} THEN 'closer'
      WHEN cause = 'lag' AND attempts < {D.MAX_BUILDS} THEN 'build' ELSE 'ledger' END
    WHEN 'ship_gate' THEN CASE WHEN pass THEN 'deliver' WHEN cause IN ('directional', 'replay') AND NOT override THEN 'eye' ELSE 'ledger' END
    WHEN 'deliver' THEN 'review' WHEN 'review' THEN CASE WHEN pass OR attempts > {D.MAX_WITHDRAWALS} OR back = 'elsewhere' THEN 'ledger' ELSE back END END AS routed, actual, count(*) AS n
  FROM v GROUP BY ALL""")
def next_step(t):
    from assayer.operators.bars import chunks_by_count
    from assayer.operators.ordered import scan_in_order
    named = t.ledger_rows.select("run", "ts", "id", F.element_at(F.array(*[F.lit(s) for s in STEPS]), ((c("cents") + c("k")) % 9 + 1).cast("int")).alias("step"), "cents", "k")
    led = scan_in_order(chunks_by_count(named, ["run"], "ts", then="id"), ["run"], ["ts", "id"], c("__part"), lead={"actual": c("step")})
    facts = F.expr(f"""from_json(to_json(named_struct('pass', cents % 3 > 0, 'failed', k % 2 = 0, 'attempts', k % 4, 'caption', 'pass', 'drift', 'pass', 'override', cents % 7 = 0,
        'cause', element_at(array{CAUSES}, int(k % 6 + 1)),
        'mouth', CASE k % 5 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'review' WHEN 3 THEN 'noface' ELSE 'unreadable' END, 'lag_s', (k % 30) / 100.0D,
        'back_to', CASE k % 3 WHEN 0 THEN 'render' WHEN 1 THEN 'elsewhere' ELSE 'build' END)), '{D.NEXT_STEP_FACTS}')""")
    d = led.withColumn("v", facts)
    return d.groupBy("step", D.next_step(c("step"), c("v")).alias("routed"), "actual").agg(n("n"))


@query("run_outcome", "P18", """
  SELECT run, CASE WHEN run % 10 = 0 AND run % 20 = 0 THEN 'dry: refused before any spend, no path' WHEN run % 10 = 0 THEN 'dry: stopped before the first spend'
    WHEN last = 'review' AND k % 3 = 0 THEN 'delivered' WHEN last = 'review' AND k % 3 = 1 THEN 'withdrawn, with no withdrawal left to fix it'
    ELSE 'stopped at ' || last END AS outcome FROM (SELECT run, arg_max(step, seq) AS last, arg_max(k, seq) AS k FROM fx_ledger GROUP BY run) x""")
def run_outcome(t):
    e = L.last_per_group(t.ledger_rows, ["run"], ["ts", "id"], ["step", "k"])
    dry = c("run") % 10 == 0
    refused = F.when(c("run") % 20 == 0, "no path")
    review = F.when(c("k") % 3 == 0, "keep").when(c("k") % 3 == 1, "withdraw")
    return e.select("run", D.run_outcome(c("step"), dry, refused, review).alias("outcome"))
