"""Votes and judge calls over ``orders`` (votes) and ``lineitem`` (calls)."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayer.catalog.base import Tables, query
from assayer.operators import votes as V
from assayer.operators.validate import bounded_rank
from assayer.plans.gate import gate_evaluation
from assayer.session import settle


def scores(t: Tables):
    return V.valid_calls(t.calls)[0]


def totals(t: Tables):
    return V.item_total(scores(t).where("judge = 'A'"), ["brief", "item"])


def sides(t: Tables):
    return V.both_directions(t.votes, ["vote_id", "rater", "brief"])


def rates(t: Tables):
    return V.pair_rates(sides(t), ["brief"])


def values(t: Tables):
    return V.human_value(rates(t), ["brief"])


def scored(t: Tables):
    return V.values_with_totals(V.human_value(rates(t), ["brief"], min_items=1), totals(t), ["brief", "item"])


@query("valid_calls", "P1", """
  SELECT coalesce(CASE WHEN craft NOT BETWEEN 1 AND 10 OR message NOT BETWEEN 1 AND 10 OR warmth NOT BETWEEN 1 AND 10
         THEN 'out of range' END, 'ok') AS reason, judge, count(*) AS calls FROM fx_calls GROUP BY 1, 2""")
def valid_calls(t):
    ok, refused = V.valid_calls(t.calls)
    both = ok.select(F.lit("ok").alias("reason"), "judge").unionByName(refused.select("reason", "judge"))
    return both.groupBy("reason", "judge").agg(F.count(F.lit(1)).alias("calls"))


@query("item_total", "A1", "SELECT brief, item, round(total, 6) AS total, calls FROM fx_totals")
def item_total(t):
    return totals(t).withColumn("total", F.round("total", 6))


@query("kill", "A2", """
  SELECT brief, count(*) AS items, arg_min(item, {'t': total, 'i': item}) AS killed, round(min(total), 6) AS total
  FROM fx_totals GROUP BY brief HAVING count(*) >= 3""")
def kill(t):
    return V.kill(totals(t), ["brief"]).withColumn("total", F.round("total", 6))


@query("kill_refusals", "A2", """
  WITH g AS (SELECT brief, CASE WHEN right(item, 1) = '3' THEN 'last' ELSE 'rest' END AS part FROM fx_totals)
  SELECT brief, part, count(*) AS items, 'fewer than 3 items' AS reason FROM g GROUP BY brief, part HAVING count(*) < 3
  UNION ALL SELECT DISTINCT brief, 'none', 0::BIGINT, 'no calls' FROM g""")
def kill_refusals(t):
    g = totals(t).withColumn("part", F.when(F.right("item", F.lit(1)) == "3", "last").otherwise("rest"))
    asked = g.select("brief", F.explode(F.array(F.lit("last"), F.lit("rest"), F.lit("none"))).alias("part"))
    return V.kill_refusals(g, ["brief", "part"], asked)


@query("ship", "A3", """
  SELECT brief, item, round(total, 6) AS total FROM fx_totals t WHERE item <> (SELECT arg_min(item, {'t': total, 'i': item})
  FROM fx_totals u WHERE u.brief = t.brief)""")
def ship(t):
    return V.ship(totals(t), ["brief"]).select("brief", "item", F.round("total", 6).alias("total"))


@query("pick_top", "A4", """
  SELECT brief, arg_min(item, {'t': -total, 'i': item}) AS picked, round(max(total), 6) AS total FROM fx_totals GROUP BY brief""")
def pick_top(t):
    return V.pick_top(totals(t), ["brief"]).withColumn("total", F.round("total", 6))


@query("votes_with_pairs", "J1", """
  SELECT v.vote_id, v.rater, v.winner, p.brief, p.a, p.b FROM fx_votes v
  JOIN (SELECT DISTINCT concat(a, '|', b) AS pair_id, brief, a, b FROM fx_votes) p ON concat(v.a, '|', v.b) = p.pair_id""")
def votes_with_pairs(t):
    pair = F.concat_ws("|", "a", "b")
    pairs = t.votes.select(pair.alias("pair_id"), "brief", "a", "b").distinct()
    votes = t.votes.select("vote_id", "rater", "winner", pair.alias("pair_id"))
    return votes.join(pairs, "pair_id").drop("pair_id")


@query("both_directions", "J2", "SELECT vote_id, rater, brief, x, y, pts FROM fx_sides")
def both_directions(t):
    return sides(t)


@query("pair_rates", "A5", "SELECT brief, x, y, half_points, n FROM fx_rates")
def pair_rates(t):
    return rates(t)


@query("human_value", "A6", "SELECT brief, item, round(value, 6) AS value, opponents FROM fx_values")
def human_value(t):
    return values(t).withColumn("value", F.round("value", 6))


@query("join_values_scores", "J3", """
  SELECT brief, item, round(value, 6) AS value, round(total, 6) AS total FROM fx_values JOIN fx_totals USING (brief, item)""")
def join_values_scores(t):
    return scored(t).select("brief", "item", F.round("value", 6).alias("value"), F.round("total", 6).alias("total"))


@query("policy_lines", "A7", """
  SELECT brief, items, round(uniform, 6) AS uniform, round(gate, 6) AS gate, round(pick, 6) AS pick,
    round(oracle, 6) AS oracle, killed, worst, picked FROM fx_lines""")
def policy_lines(t):
    d = V.policy_lines(scored(t), ["brief"])
    return d.select("brief", "items", *[F.round(c, 6).alias(c) for c in ("uniform", "gate", "pick", "oracle")], "killed", "worst", "picked")


@query("policy_summary", "A8", """
  SELECT count(*) AS groups, round(avg(uniform), 6) AS uniform, round(avg(gate), 6) AS gate, round(avg(pick), 6) AS pick,
    round(avg(oracle), 6) AS oracle, round((avg(gate) - avg(uniform)) / (avg(oracle) - avg(uniform)), 6) AS gap_closed,
    round((avg(pick) - avg(uniform)) / (avg(oracle) - avg(uniform)), 6) AS pick_gap_closed,
    round(avg(gate) - avg(pick), 6) AS gate_minus_pick FROM fx_lines""")
def policy_summary(t):
    d = gate_evaluation(t.votes, t.calls, judge="A")
    return d.select("groups", *[F.round(c, 6).alias(c) for c in
                                ("uniform", "gate", "pick", "oracle", "gap_closed", "pick_gap_closed", "gate_minus_pick")])


@query("round_robin", "J14", """
  WITH met AS (SELECT DISTINCT brief, least(a, b) AS lo, greatest(a, b) AS hi FROM fx_votes WHERE shoot = 's1'),
  it AS (SELECT brief, lo AS i FROM met UNION SELECT brief, hi FROM met)
  SELECT x.brief, count(DISTINCT x.i) AS items, (SELECT count(*) FROM met m WHERE m.brief = x.brief) AS met,
   bool_and(x.i >= y.i OR EXISTS (SELECT 1 FROM met m WHERE m.brief = x.brief AND m.lo = x.i AND m.hi = y.i)) AS round_robin
  FROM it x JOIN it y ON x.brief = y.brief GROUP BY x.brief""")
def round_robin(t):
    v = t.votes.where("shoot = 's1'").select("brief", F.col("a").alias("x"), F.col("b").alias("y"))
    return V.round_robin(v, ["brief"])


@query("kill_hits", "A9", """
  SELECT l.brief, killed, true AS round_robin, killed_value = worst_value AS hit,
   round((SELECT count(*) FROM fx_values v JOIN fx_totals USING (brief, item) WHERE v.brief = l.brief AND v.value = l.worst_value) / l.items, 6) AS coin,
   1 + (SELECT count(*) FROM fx_values v JOIN fx_totals USING (brief, item) WHERE v.brief = l.brief AND v.value < l.killed_value) AS kill_rank
  FROM fx_lines l""")
def kill_hits(t):
    meetings = t.votes.select("brief", F.col("a").alias("x"), F.col("b").alias("y"))
    return V.kill_hits(scored(t), meetings, ["brief"]).withColumn("coin", F.round("coin", 6))


@query("pair_agreement", "A11,M7", """
  WITH s AS (SELECT brief, a, b, winner, count(*) AS k FROM fx_votes WHERE winner IS NOT NULL GROUP BY ALL)
  SELECT brief, a, b, cast(sum(k * (k - 1) // 2) AS BIGINT) AS same, cast(sum(k) AS BIGINT) AS decisive,
    cast(sum(k) * (sum(k) - 1) // 2 AS BIGINT) AS pairs FROM s GROUP BY brief, a, b""")
def pair_agreement(t):
    return V.pair_agreement(t.votes, ["brief", "a", "b"]).where("decisive > 0").select("brief", "a", "b", "same", "decisive", "pairs")


@query("majority_share", "A12", """
  WITH s AS (SELECT brief, a, b, winner, count(*) AS k FROM fx_votes GROUP BY ALL)
  SELECT brief, cast(sum(m) AS BIGINT) AS majority, cast(sum(d) AS BIGINT) AS decisive, cast(sum(n) AS BIGINT) AS ties FROM (
    SELECT brief, coalesce(max(k) FILTER (winner IS NOT NULL), 0) AS m, coalesce(sum(k) FILTER (winner IS NOT NULL), 0) AS d,
      coalesce(sum(k) FILTER (winner IS NULL), 0) AS n FROM s GROUP BY brief, a, b) x GROUP BY brief""")
def majority_share(t):
    per = V.pair_agreement(t.votes, ["brief", "a", "b"])
    return per.groupBy("brief").agg(*[F.sum(c).alias(c) for c in ("majority", "decisive", "ties")])


PICKS = """picks AS (SELECT shoot AS judge, CASE WHEN rater % 3 = 0 THEN 'base' WHEN rater % 3 = 1 THEN 'swap' ELSE 'tail' END AS variant,
    rater // 3 AS pair_id, CASE WHEN winner = a THEN 'A' ELSE 'B' END AS pick FROM fx_votes WHERE winner IS NOT NULL)"""


def verdict_rows(t: Tables):
    return t.votes.where("winner IS NOT NULL").selectExpr(
        "shoot AS judge", "CASE WHEN rater % 3 = 0 THEN 'base' WHEN rater % 3 = 1 THEN 'swap' ELSE 'tail' END AS variant",
        "rater div 3 AS pair_id", "brief", "CASE WHEN winner = a THEN 'A' ELSE 'B' END AS pick")


@query("position_bias", "A13", f"""
  WITH {PICKS}, per AS (SELECT judge, variant, pair_id % 50 AS cell, pair_id, min(pick) AS lo, max(pick) AS hi FROM picks GROUP BY ALL)
  SELECT judge, variant, cell, count(*) AS pairs, count(*) FILTER (lo <> hi) AS conflicts,
    CASE WHEN count(*) FILTER (lo <> hi) = 0 THEN count(*) FILTER (lo = 'B' AND hi = 'B') END AS picked_b FROM per GROUP BY judge, variant, cell""")
def position_bias(t):
    rows = verdict_rows(t).withColumn("cell", F.col("pair_id") % 50)
    return V.position_bias(rows, ["judge", "variant", "cell"]).drop("share_b")


@query("matched_subset", "J20", f"""
  WITH {PICKS}, s AS (SELECT judge, variant, pair_id, min(pick) AS p FROM picks GROUP BY ALL HAVING min(pick) = max(pick))
  SELECT b.judge, b.pair_id, b.p AS base_pick, o.p AS other_pick FROM s b JOIN s o USING (judge, pair_id)
  WHERE b.variant = 'base' AND o.variant = 'tail'""")
def matched_subset(t):
    v = verdict_rows(t)
    return V.matched_subset(v.where("variant = 'base'"), v.where("variant = 'tail'"), ["judge", "pair_id"])


@query("position_shift", "B5", f"""
  WITH {PICKS}, s AS (SELECT judge, variant, pair_id, min(pick) AS p FROM picks GROUP BY ALL HAVING min(pick) = max(pick))
  SELECT judge, count(*) AS common, count(*) FILTER (b.p = 'B') AS base_b, count(*) FILTER (o.p = 'B') AS other_b
  FROM s b JOIN s o USING (judge, pair_id) WHERE b.variant = 'base' AND o.variant = 'tail' GROUP BY judge""")
def position_shift(t):
    v = verdict_rows(t)
    return V.position_shift(v.where("variant = 'base'"), v.where("variant = 'tail'"), ["judge", "pair_id"], ["judge"])


@query("axis_correlation", "A14", """
  WITH m AS (SELECT brief, item, avg(craft) AS craft, avg(message) AS message, avg(warmth) AS warmth FROM fx_scores
    WHERE judge = 'A' GROUP BY ALL), l AS (SELECT value, craft, message, warmth, craft + message + warmth AS "sum"
    FROM m JOIN fx_values USING (brief, item))
  SELECT axis, round(corr(score, value), 6) AS r, count(*) AS n FROM l UNPIVOT (score FOR axis IN (craft, message, warmth, "sum")) GROUP BY axis""")
def axis_correlation(t):
    means = V.axis_means(scores(t).where("judge = 'A'"), ["brief", "item"])
    return V.axis_correlation(means, values(t), ["brief", "item"]).withColumn("r", F.round("r", 6))


@query("score_resolution", "A15", """
  WITH r AS (SELECT * FROM fx_reps WHERE judge = 'N')
  SELECT count(DISTINCT f) AS first_call, count(DISTINCT m) AS averaged, count(*) AS items FROM (
    SELECT item, arg_min(craft + message + warmth, rep) AS f, round(avg(craft + message + warmth), 6) AS m FROM r GROUP BY item) x""")
def score_resolution(t):
    return V.score_resolution(t.numbered_calls.where("judge = 'N'"))


@query("tie_groups", "A16", """
  WITH t AS (SELECT brief, item, round(avg(craft), 1) AS score FROM fx_scores GROUP BY ALL),
  e AS (SELECT brief, min(score) AS lo, max(score) AS hi FROM t GROUP BY brief)
  SELECT brief, score, count(*) AS tied, CASE WHEN score = min(lo) THEN 'bottom' WHEN score = min(hi) THEN 'top' ELSE 'middle' END AS place
  FROM t JOIN e USING (brief) GROUP BY brief, score HAVING count(*) > 1""")
def tie_groups(t):
    per = scores(t).groupBy("brief", "item").agg(F.round(F.avg("craft"), 1).alias("total"))
    return V.tie_groups(per, ["brief"])


@query("winner_margin", "A17", """
  WITH r AS (SELECT *, row_number() OVER (PARTITION BY brief ORDER BY value DESC, item) AS p FROM fx_values)
  SELECT a.brief, a.item AS winner, b.item AS runner_up, round(a.value - b.value, 6) AS margin
  FROM r a JOIN r b ON a.brief = b.brief AND a.p = 1 AND b.p = 2""")
def winner_margin(t):
    return V.winner_margin(values(t), ["brief"]).select("brief", "winner", "runner_up", F.round("margin", 6).alias("margin"))


@query("top_n_per_group", "K3", """
  SELECT c_nationkey, c_custkey, place FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey
    ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) t WHERE place <= 3""")
def top_n_per_group(t):
    return V.top_n(t.customer, ["c_nationkey"], "c_acctbal", "c_custkey", 3).select("c_nationkey", "c_custkey", "place")


@query("panel_mean", "A18", """
  WITH m AS (SELECT brief, item, judge, avg(craft) AS craft, avg(message) AS message, avg(warmth) AS warmth FROM fx_scores
    WHERE judge IN ('A', 'R') GROUP BY ALL)
  SELECT brief, item, round((x.craft + y.craft) / 2, 6) AS craft, round((x.message + y.message) / 2, 6) AS message,
    round((x.warmth + y.warmth) / 2, 6) AS warmth FROM m x JOIN m y USING (brief, item) WHERE x.judge = 'A' AND y.judge = 'R'""")
def panel_mean(t):
    d = V.panel_mean(scores(t), ["brief", "item"], "A", "R")
    return d.select("brief", "item", *[F.round(a, 6).alias(a) for a in V.AXES])


@query("worst_lost_all", "A19", """
  SELECT l.brief, l.killed, l.worst, bool_and(r.half_points < r.n) FILTER (r.x = l.worst) AS lost_all,
    round(max(r.half_points / (2.0 * r.n)) FILTER (r.x = l.killed AND r.y = l.worst), 6) AS killed_vs_worst
  FROM fx_lines l JOIN fx_rates r USING (brief) GROUP BY l.brief, l.killed, l.worst""")
def worst_lost_all(t):
    d = V.worst_lost_all(scored(t), rates(t), ["brief"])
    return d.withColumn("killed_vs_worst", F.round("killed_vs_worst", 6))


def engine_of(item):
    return F.element_at(F.split(item, "-"), -1)


@query("constant_baseline", "A20,J17", """
  WITH e AS (SELECT brief, string_split(item, '-')[2] AS engine, value FROM fx_values),
  f AS (SELECT h.brief, e.engine, round(avg(e.value), 12) AS m FROM (SELECT DISTINCT brief FROM e) h JOIN e ON e.brief <> h.brief GROUP BY ALL),
  b AS (SELECT brief, arg_min(engine, {'m': -m, 'e': engine}) AS engine, max(m) AS m FROM f GROUP BY brief)
  SELECT b.brief, b.engine, round(b.m, 6) AS mean_elsewhere, round(e.value, 6) AS held_out FROM b JOIN e USING (brief, engine)""")
def constant_baseline(t):
    ev = values(t).select("brief", engine_of("item").alias("engine"), "value")
    d = V.constant_baseline(ev)
    return d.select("brief", "engine", F.round("mean_elsewhere", 6).alias("mean_elsewhere"), F.round("held_out", 6).alias("held_out"))


@query("picks_vs_best", "A21,F5", """
  WITH v AS (SELECT v.*, total FROM fx_values v JOIN fx_totals USING (brief, item)),
  p AS (SELECT 'judge' AS picker, brief, arg_min(item, {'t': -total, 'i': item}) AS item FROM v GROUP BY brief
    UNION ALL SELECT 'first name', brief, min(item) FROM v GROUP BY brief
    UNION ALL SELECT 'best', brief, arg_min(item, {'t': -value, 'i': item}) FROM v GROUP BY brief),
  b AS (SELECT brief, arg_min(item, {'t': -value, 'i': item}) AS best FROM v GROUP BY brief)
  SELECT picker, count(*) AS groups, round(avg(value), 6) AS mean_value, count(*) FILTER (item = best) AS matched
  FROM p JOIN v USING (brief, item) JOIN b USING (brief) GROUP BY picker""")
def picks_vs_best(t):
    s = settle(scored(t), "picks")
    pickers = {"judge": lambda d: V.pick_top(d, ["brief"]).select("brief", F.col("picked").alias("item")),
               "first name": lambda d: d.groupBy("brief").agg(F.min("item").alias("item")),
               "best": lambda d: V.pick_top(d.withColumn("total", F.col("value")), ["brief"]).select("brief", F.col("picked").alias("item"))}
    picks = None
    for name, fn in pickers.items():
        one = fn(s).select(F.lit(name).alias("picker"), "brief", "item")
        picks = one if picks is None else picks.unionByName(one)
    return V.picks_vs_best(s, picks, ["brief"]).withColumn("mean_value", F.round("mean_value", 6))


@query("rep_completeness", "A29", """
  WITH p AS (SELECT item || '/' || judge AS item, count(*) AS calls, count(DISTINCT rep) AS reps, min(rep) AS lo, max(rep) AS hi FROM fx_reps
    WHERE craft BETWEEN 1 AND 10 AND message BETWEEN 1 AND 10 GROUP BY ALL),
  m AS (SELECT calls AS n FROM (SELECT calls, count(*) AS f FROM p GROUP BY calls ORDER BY f DESC, calls LIMIT 1) x)
  SELECT item, calls, reps, n FROM p, m WHERE NOT (calls = n AND reps = n AND lo = 1 AND hi = n)""")
def rep_completeness(t):
    rows = t.numbered_calls.where("craft BETWEEN 1 AND 10 AND message BETWEEN 1 AND 10")
    return V.rep_completeness(rows.withColumn("item", F.concat_ws("/", "item", "judge")))


@query("coverage", "A30", """
  SELECT DISTINCT o_custkey AS item FROM orders WHERE o_custkey NOT IN
    (SELECT c_custkey FROM customer WHERE c_acctbal > 2000)""")
def coverage(t):
    return V.coverage(t.orders.select(F.col("o_custkey").alias("item")),
                      t.customer.where("c_acctbal > 2000").select(F.col("c_custkey").alias("item")))


@query("duplicate_keys", "A44", """
  SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t):
    return V.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("rank_from_bottom", "W26", """
  SELECT c_nationkey, c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY round(c_acctbal)) AS place FROM customer""")
def rank_from_bottom(t):
    return bounded_rank(t.customer.withColumn("v", F.round("c_acctbal")), ["c_nationkey"], "v", F.floor(F.col("v") / 100).cast("bigint")
                        ).select("c_nationkey", "c_custkey", "place")
