"""Series diagnostics over hourly event counts, and measures over ``lineitem`` and ``embeddings``."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayer.catalog.base import Tables, query
from assayer.functions.scalars import scaled_round
from assayer.functions.verdicts import deviation_class
from assayer.operators import measures as M
from assayer.operators import series as S
from assayer.operators.ordered import chunk_of
from assayer.session import settle

c = F.col


def n(name):
    return F.count(F.lit(1)).alias(name)


def r6(df, *cols):
    return df.select(*[F.round(x, 6).alias(x) if x in cols else c(x) for x in df.columns])


@query("lag_pairs", "J13", """
  SELECT a.series, count(*) AS pairs, cast(sum((a.v - b.v) * (a.v - b.v)) AS BIGINT) AS distance FROM fx_series a JOIN fx_series b ON b.series = a.series AND b.pos = a.pos + 24 GROUP BY a.series""")
def lag_pairs(t):
    d = S.lag_pairs(t.series, "series", "pos", "v", 24)
    return d.groupBy("series").agg(n("pairs"), F.sum((c("v") - c("later")) * (c("v") - c("later"))).alias("distance"))


@query("runs_above", "W4", """
  WITH m AS (SELECT series, pos, pos - row_number() OVER (PARTITION BY series ORDER BY pos) AS g FROM fx_series WHERE v > 2)
  SELECT series, min(pos) AS start, count(*) AS length FROM m GROUP BY series, g HAVING count(*) >= 3""")
def runs_above(t):
    return S.runs(t.series, "series", "pos", c("v") > 2, 3)


@query("rest_fraction", "W5", """
  WITH q AS (SELECT series, quantile_cont(v, 0.75) AS p, count(*) AS n FROM fx_series GROUP BY series),
  m AS (SELECT series, pos, pos - row_number() OVER (PARTITION BY series ORDER BY pos) AS g FROM fx_series JOIN q USING (series) WHERE v < p * 0.38),
  r AS (SELECT series, count(*) AS length FROM m GROUP BY series, g HAVING count(*) >= 2), s AS (SELECT series, sum(length) AS rest, count(*) AS k FROM r GROUP BY series)
  SELECT q.series, n, cast(coalesce(rest, 0) AS BIGINT) AS rest, coalesce(k, 0) AS rest_runs, round(coalesce(rest, 0)::DOUBLE / n, 6) AS rest_fraction,
    CASE WHEN coalesce(rest, 0)::DOUBLE / n < 0.1 THEN 'FLAG' ELSE 'PASS' END AS verdict FROM q LEFT JOIN s USING (series)""")
def rest_fraction(t):
    return r6(S.rest_fraction(t.series, "series", "pos", "v", 2), "rest_fraction")


@query("merge_events", "W6", """
  WITH h AS (SELECT run, kind, epoch_us(ts) AS t FROM fx_ledger), p AS (SELECT *, lag(t) OVER (PARTITION BY run, kind ORDER BY t) AS q FROM h),
  e AS (SELECT *, sum(CASE WHEN q IS NULL OR t - q >= 36000000000 THEN 1 ELSE 0 END) OVER (PARTITION BY run, kind ORDER BY t) AS e FROM p)
  SELECT run, kind, min(t) AS first, max(t) AS last, count(*) AS hits FROM e GROUP BY run, kind, e HAVING count(*) >= 3""")
def merge_events(t):
    h = t.ledger_rows.select("run", "kind", F.unix_micros("ts").alias("t"))
    return S.merge_events(h, ["run", "kind"], "t", 36_000_000_000)


@query("first_diff_energy", "W7", """
  SELECT series, round(avg(d), 6) AS energy, max(d) AS largest FROM (SELECT series, abs(v - lag(v) OVER (PARTITION BY series ORDER BY pos)) AS d FROM fx_series) x GROUP BY series""")
def first_diff_energy(t):
    return r6(S.first_diff_energy(t.series, "series", "pos", "v"), "energy")


ENERGY = """ch AS (SELECT series, pos, abs(v - lag(v) OVER (PARTITION BY series ORDER BY pos)) * 10 AS x FROM fx_series),
  md AS (SELECT series, quantile_cont(x, 0.5) AS m FROM ch GROUP BY series), ex AS (SELECT series, pos, x, greatest(x - m, 0) AS e FROM ch JOIN md USING (series) WHERE x IS NOT NULL),
  en AS (SELECT series, pos, x, sum(e) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS energy FROM ex)"""


def changes(t: Tables):
    d = S.differences(t.series, "series", "pos", "v").where("diff IS NOT NULL").select("series", "pos", (c("diff") * 10).cast("double").alias("change"))
    return S.centred_energy(d, "series", "pos", "change", 6)


@query("centred_energy", "W8", f"WITH {ENERGY} SELECT series, pos, round(energy, 6)::DOUBLE AS energy FROM en")
def centred_energy(t):
    return r6(changes(t), "energy").select("series", "pos", "energy")


@query("worst_window", "W9", """
  WITH w AS (SELECT series, avg(v) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS m,
    count(v) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS k FROM fx_series)
  SELECT series, round(max(m), 6) AS worst FROM w WHERE k = 24 GROUP BY series""")
def worst_window(t):
    return r6(S.worst_window(t.series, "series", "pos", "v", 24), "worst")


ONSET = """sc AS (SELECT series, pos, round(v / avg(v) OVER (PARTITION BY series), 6) AS v FROM fx_series), cd AS (SELECT series, pos FROM (SELECT series, pos, v, avg(v) OVER w AS q, count(v) OVER w AS k FROM sc
    WINDOW w AS (PARTITION BY series ORDER BY pos ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)) x WHERE v > 1.21 AND k = 4 AND q < 1.0300005),
  on_ AS (SELECT series, min(pos) AS pos FROM cd GROUP BY series UNION ALL
    SELECT o.series, (SELECT min(cd.pos) FROM cd WHERE cd.series = o.series AND cd.pos > o.pos + 5) FROM on_ o WHERE o.pos IS NOT NULL)"""


def levelled(t: Tables):
    """Each series in units of its own mean, so one threshold fits every scale."""
    mean = t.series.groupBy("series").agg(F.avg("v").alias("m"))
    return t.series.join(mean, "series").select("series", "pos", F.round(c("v") / c("m"), 6).alias("v"))


@query("onsets", "W10", f"WITH RECURSIVE {ONSET} SELECT series, pos FROM on_ WHERE pos IS NOT NULL")
def onsets(t):
    return S.onsets(levelled(t), "series", "pos", "v", 1.21, 1.0300005, 5)


def onset_events(t: Tables):
    return S.onset_candidates(levelled(t), "series", "pos", "v", 1.21, 1.0300005)


RESPONSE = f"""{ONSET.split('on_ AS')[0].rstrip().rstrip(',')},
  an AS (SELECT series, pos, v FROM fx_series), ba AS (SELECT cd.series, cd.pos AS event, avg(an.v) FILTER (an.pos - cd.pos BETWEEN -10 AND -3) AS b1, avg(an.v) FILTER (an.pos - cd.pos BETWEEN -2 AND -1) AS b2
    FROM cd JOIN an ON an.series = cd.series AND an.pos BETWEEN cd.pos - 10 AND cd.pos + 15 GROUP BY ALL),
  rs AS (SELECT ba.series, event, coalesce(b1, b2) AS base, min(an.pos - event) FILTER (an.v > coalesce(b1, b2) * 2.6 + 1e-4) / 20.0 AS lag_s
    FROM ba JOIN an ON an.series = ba.series AND an.pos BETWEEN event - 2 AND event + 15 GROUP BY ALL)"""


@query("onset_response", "W11", f"WITH {RESPONSE} SELECT series, event, round(base, 6) AS base, lag_s::DOUBLE AS lag_s FROM rs")
def onset_response(t):
    return r6(S.onset_response(onset_events(t), t.series, "series", "pos", "v", rise=2.6), "base")


@query("onset_verdict", "W11", f"""
  WITH {RESPONSE}, g AS (SELECT series, count(*) AS onsets, count(*) FILTER (lag_s IS NULL) AS misses, quantile_cont(lag_s, 0.5) AS m FROM rs GROUP BY series)
  SELECT series, onsets, misses, round(m, 6)::DOUBLE AS median_lag, CASE WHEN misses::DOUBLE / onsets >= 0.3 OR coalesce(m, 9.9) > 0.35 THEN 'FAIL'
    WHEN misses::DOUBLE / onsets >= 0.1 OR coalesce(m, 9.9) > 0.2 THEN 'REVIEW' ELSE 'PASS' END AS verdict FROM g""")
def onset_verdict(t):
    return r6(S.onset_verdict(S.onset_response(onset_events(t), t.series, "series", "pos", "v", rise=2.6), "series"), "median_lag")


PEAKS = """pt AS (SELECT series, quantile_cont(v, 0.65) AS thr FROM fx_series GROUP BY series),
  pc AS (SELECT series, pos FROM (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS b FROM fx_series WINDOW w AS (PARTITION BY series ORDER BY pos)) x JOIN pt USING (series) WHERE v >= thr AND v >= a AND v >= b),
  pk AS (SELECT series, min(pos) AS pos FROM pc GROUP BY series UNION ALL
    SELECT o.series, (SELECT min(pc.pos) FROM pc WHERE pc.series = o.series AND pc.pos >= o.pos + 7) FROM pk o WHERE o.pos IS NOT NULL)"""


@query("peaks", "W12", f"WITH RECURSIVE {PEAKS} SELECT series, pos FROM pk WHERE pos IS NOT NULL")
def peaks(t):
    return S.peaks(t.series, "series", "pos", "v", 7)


@query("dedupe_nodes", "W13", """
  WITH RECURSIVE e AS (SELECT DISTINCT run % 5 AS g, epoch_us(ts) // 1000000 AS t FROM fx_ledger WHERE kind = 'gate'),
  k AS (SELECT g, min(t) AS t FROM e GROUP BY g UNION ALL SELECT k.g, (SELECT min(e.t) FROM e WHERE e.g = k.g AND e.t >= k.t + 14400) FROM k WHERE k.t IS NOT NULL)
  SELECT g, t FROM k WHERE t IS NOT NULL""")
def dedupe_nodes(t):
    e = t.ledger_rows.where("kind = 'gate'").select((c("run") % 5).alias("g"), F.unix_seconds("ts").alias("t"))
    return S.dedupe_nodes(e, "g", "t", 14400, chunk_of("t", 3 * 86400))


WALK = """lv AS (SELECT series, quantile_cont(v, 0.6) AS level FROM fx_series GROUP BY series),
  mo AS (SELECT series, pos, v, level, v > level AND avg(v) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) < level AS art FROM fx_series JOIN lv USING (series)),
  ev AS (SELECT series, pos AS event FROM fx_series WHERE pos % 17 = 5),
  wk AS (SELECT ev.series, event, min(pos - event) FILTER (art) / 10.0 AS phase, avg(v) AS m, max(level) AS l FROM ev JOIN mo ON mo.series = ev.series AND mo.pos BETWEEN event - 8 AND event + 3 GROUP BY ALL),
  kd AS (SELECT series, event, phase::DOUBLE AS phase_s, CASE WHEN phase > 0.08 THEN 'late' WHEN phase > -0.03 THEN 'sync' WHEN phase IS NOT NULL THEN 'lead' WHEN m > l THEN 'continuous' ELSE 'still' END AS kind FROM wk)"""


def walk(t: Tables):
    return S.phase_walk(t.series.where("pos % 17 = 5"), t.series, "series", "pos", "v", 10)


@query("phase_walk", "W14", f"WITH {WALK} SELECT * FROM kd")
def phase_walk(t):
    return walk(t)


@query("phase_summary", "W14", f"""
  WITH {WALK} SELECT series, count(*) AS events, count(*) FILTER (kind = 'lead') AS "lead", count(*) FILTER (kind = 'sync') AS sync, count(*) FILTER (kind = 'late') AS late,
    count(*) FILTER (kind = 'continuous') AS continuous, count(*) FILTER (kind = 'still') AS still, round(coalesce(sum(phase_s) FILTER (kind = 'late'), 0), 6) AS phase_debt,
    round(avg(phase_s), 6) AS mean_phase FROM kd GROUP BY series""")
def phase_summary(t):
    return r6(S.phase_summary(walk(t), "series"), "phase_debt", "mean_phase")


@query("lock_share", "W15", """
  WITH m AS (SELECT series, pos, pos - row_number() OVER (PARTITION BY series ORDER BY pos) AS g FROM fx_series WHERE v > 3),
  b AS (SELECT series, min(pos) AS pos FROM m GROUP BY series, g HAVING count(*) >= 2), e AS (SELECT series, pos FROM fx_series WHERE pos % 17 = 5)
  SELECT series, count(*) AS bursts, count(*) FILTER (EXISTS (SELECT 1 FROM e WHERE e.series = b.series AND abs(e.pos - b.pos) <= 3)) AS locked FROM b GROUP BY series""")
def lock_share(t):
    b = S.runs(t.series, "series", "pos", c("v") > 3, 2).select("series", c("start").alias("pos"))
    return S.lock_share(b, t.series.where("pos % 17 = 5"), "series", "pos", 3).drop("lock")


LAGS = """xy AS (SELECT a.series, a.pos, a.v AS x, b.v AS y FROM fx_series a JOIN fx_series b ON b.pos = a.pos AND b.series = 'view'),
  cv AS (SELECT a.series, (b.pos - a.pos)::INT AS lag, corr(a.x, b.y) AS r, count(*) AS n FROM xy a JOIN xy b ON b.series = a.series AND b.pos BETWEEN a.pos - 24 AND a.pos + 24 GROUP BY ALL HAVING count(*) >= 20)"""


def pairs(t: Tables):
    y = t.series.where("series = 'view'").select("pos", c("v").alias("y"))
    return t.series.select("series", "pos", c("v").alias("x")).join(y, "pos")


@query("lag_correlation", "W16", f"WITH {LAGS} SELECT series, lag, round(r, 6) AS r, n FROM cv")
def lag_correlation(t):
    return r6(S.lag_correlation(pairs(t), ["series"], "pos", "x", "y", 24), "r")


@query("best_lag", "W16", f"""
  WITH {LAGS}, b AS (SELECT series, arg_min(lag, {{'r': -round(r, 9), 'l': lag}}) AS lag FROM cv GROUP BY series),
  j AS (SELECT b.series, b.lag, m.r, x.r AS a, z.r AS c FROM b JOIN cv m USING (series, lag) LEFT JOIN cv x ON x.series = b.series AND x.lag = b.lag - 1 LEFT JOIN cv z ON z.series = b.series AND z.lag = b.lag + 1)
  SELECT series, lag, round(r, 6) AS r, round(coalesce(CASE WHEN a - 2 * r + c < -1e-12 THEN greatest(-0.5, least(0.5, 0.5 * (a - c) / (a - 2 * r + c))) ELSE 0 END, 0), 6) AS "offset" FROM j""")
def best_lag(t):
    return r6(S.best_lag(S.lag_correlation(pairs(t), ["series"], "pos", "x", "y", 24), ["series"]), "r", "offset")


@query("stability_thirds", "B6", """
  WITH xy AS (SELECT a.series, a.pos, a.v AS x, b.v AS y, least(floor(a.pos * 3 / count(*) OVER (PARTITION BY a.series)), 2)::INT AS third FROM fx_series a JOIN fx_series b ON b.pos = a.pos AND b.series = 'view'),
  cv AS (SELECT a.series, a.third, (b.pos - a.pos)::INT AS lag, corr(a.x, b.y) AS r FROM xy a JOIN xy b ON b.series = a.series AND b.third = a.third AND b.pos BETWEEN a.pos - 6 AND a.pos + 6 GROUP BY ALL HAVING count(*) >= 20)
  SELECT series, third, arg_min(lag, {'r': -round(r, 9), 'l': lag}) AS lag, round(max(r), 6) AS r FROM cv GROUP BY series, third""")
def stability_thirds(t):
    return r6(S.lag_by_thirds(pairs(t), "series", "pos", "x", "y", 6), "r").drop("offset")


@query("repeat_scan", "W17", """
  WITH z AS (SELECT series, max(pos) + 1 AS n FROM fx_series GROUP BY series), b AS (SELECT s.*, n FROM fx_series s JOIN z USING (series)),
  f AS (SELECT b.series, avg((b.v - o.v) * (b.v - o.v)) AS far FROM b JOIN fx_series o ON o.series = b.series AND o.pos = (b.pos + b.n // 3) % b.n WHERE b.pos % 11 = 0 GROUP BY b.series),
  p AS (SELECT b.series, g.period, avg((b.v - o.v) * (b.v - o.v)) AS m FROM b JOIN (SELECT unnest(range(5, (SELECT max(n) FROM z))) AS period) g ON g.period < b.n / 1.5 AND b.n - g.period >= 1 JOIN fx_series o ON o.series = b.series AND o.pos = b.pos + g.period
    WHERE b.pos % 5 = 0 GROUP BY ALL),
  k AS (SELECT series, arg_min(period, {'m': round(m, 9), 'p': period}) AS period, min(round(m, 9)) AS m FROM p GROUP BY series)
  SELECT series, round(far, 6) AS far, CASE WHEN far >= 2.5 THEN round(m / greatest(far, 1e-9), 6) END AS share, CASE WHEN far >= 2.5 THEN period END AS period,
    CASE WHEN far < 2.5 THEN 'UNJUDGEABLE' WHEN m / greatest(far, 1e-9) < 0.4 THEN 'REPLAYS' ELSE 'FORWARD' END AS verdict FROM f JOIN k USING (series)""")
def repeat_scan(t):
    return r6(S.repeat_scan(t.series, "series", "pos", "v", floor=2.5), "far", "share")


@query("mirror_scan", "W18", """
  WITH z AS (SELECT series, max(pos) + 1 AS n FROM fx_series GROUP BY series),
  d AS (SELECT a.series, a.pos + l.l AS c, l.l, (a.v - b.v) * (a.v - b.v) AS d FROM fx_series a JOIN (SELECT unnest([10, 20, 30, 40]) AS l) l ON true JOIN fx_series b ON b.series = a.series AND b.pos = a.pos + 2 * l.l),
  m AS (SELECT d.series, c, avg(d) AS m FROM d JOIN z USING (series) WHERE c >= 50 AND c < n - 50 GROUP BY d.series, c HAVING count(*) = 4),
  k AS (SELECT series, arg_min(c, {'m': round(m, 9), 'c': c}) AS centre, min(round(m, 9)) AS m FROM m GROUP BY series),
  ct AS (SELECT d.series, quantile_cont(d, 0.5) AS control FROM d JOIN z USING (series) WHERE c IN (floor(n * 0.15::DOUBLE), floor(n * 0.3::DOUBLE), floor(n * 0.5::DOUBLE), floor(n * 0.7::DOUBLE), floor(n * 0.85::DOUBLE)) GROUP BY d.series)
  SELECT series, round(control, 6) AS control, round(m / greatest(control, 1e-9), 6) AS share, centre, CASE WHEN m / greatest(control, 1e-9) < 0.22 THEN 'REPLAYS' ELSE 'FORWARD' END AS verdict FROM ct JOIN k USING (series)""")
def mirror_scan(t):
    return r6(S.mirror_scan(t.series, "series", "pos", "v", (10, 20, 30, 40), 50), "control", "share")


@query("segment_ratio", "W19", """
  WITH z AS (SELECT series, pos, v, abs(v - lag(v) OVER (PARTITION BY series ORDER BY pos)) AS d, max(pos) OVER (PARTITION BY series) AS k FROM fx_series)
  SELECT series, round(avg(d) FILTER (pos - 1 >= k - 15) / greatest(avg(d) FILTER (pos >= 1 AND pos - 1 >= floor(k * 0.2::DOUBLE) AND pos - 1 < floor(k * 0.8::DOUBLE)), 1e-6), 6) AS end_ratio,
    abs(max(v) FILTER (pos = k) - max(v) FILTER (pos = 0))::DOUBLE AS loop_jump FROM z GROUP BY series""")
def segment_ratio(t):
    return r6(S.segment_ratio(t.series, "series", "pos", "v"), "end_ratio")


@query("drawdown", "W20", """
  WITH s AS (SELECT l_suppkey AS k, (l_orderkey % 100000) * 10 + l_linenumber AS p, l_tax FROM lineitem),
  u AS (SELECT k, p, 1 + (avg(l_tax) - 0.04) AS v FROM s GROUP BY k, p), w AS (SELECT *, greatest(max(v) OVER (PARTITION BY k ORDER BY p), 1.0) AS peak, row_number() OVER (PARTITION BY k ORDER BY p) AS i FROM u)
  SELECT k, count(*) AS points, round(max(v) - min(v), 6) AS swing, CASE WHEN count(*) < 5 THEN 'INCONCLUSIVE'
    WHEN min(i) FILTER (i <= 6 AND v < 0.96) < coalesce(min(i) FILTER (i <= 6 AND v > 1.03), 99) THEN 'FAIL' WHEN count(*) FILTER (peak > 1.06 AND v < peak - 0.08) > 0 THEN 'REVIEW' ELSE 'PASS' END AS verdict FROM w GROUP BY k""")
def drawdown(t):
    from assayer.operators.ordered import scan_in_order
    s = t.lineitem.selectExpr("l_suppkey AS k", "(l_orderkey % 100000) * 10 + l_linenumber AS p", "l_tax")
    u = s.groupBy("k", "p").agg((1 + (F.avg("l_tax") - 0.04)).alias("v"))
    u = scan_in_order(u, ["k"], ["p"], chunk_of("p"), row_number="i")
    return r6(S.drawdown(u, "k", "i", "v"), "swing")


@query("resample_mean", "W21", """
  SELECT run, epoch_us(ts) // 21600000000 AS bin, round(avg(cents), 6) AS v, count(*) AS samples FROM fx_ledger GROUP BY ALL""")
def resample_mean(t):
    s = t.ledger_rows.select("run", F.floor(F.unix_micros("ts") / 1000000).alias("t"), "cents")
    return r6(S.resample_mean(s, "run", "t", "cents", 1 / 21600), "v")


@query("resample_linear", "W21", """
  WITH s AS (SELECT run, epoch_us(ts) // 1000000 AS t, max(cents) AS v FROM fx_ledger GROUP BY ALL), g AS (SELECT *, lead(t) OVER w AS t1, lead(v) OVER w AS v1 FROM s WINDOW w AS (PARTITION BY run ORDER BY t)),
  e AS (SELECT *, unnest(range(cast(ceil(t / 4096.0) AS BIGINT), cast(ceil(t1 / 4096.0) AS BIGINT))) AS bin FROM g WHERE t1 IS NOT NULL)
  SELECT run, bin, round(v + (v1 - v) * ((bin * 4096 - t)::DOUBLE / (t1 - t)), 6) AS v FROM e""")
def resample_linear(t):
    s = t.ledger_rows.groupBy("run", F.unix_seconds("ts").alias("t")).agg(F.max("cents").alias("v"))
    return r6(S.resample_linear(s, "run", "t", "v", 1 / 4096), "v")


@query("span_energy", "W22", """
  WITH sp AS (SELECT series, pos AS lo, pos + 6 AS hi FROM fx_series WHERE pos % 24 = 8), en AS (SELECT series, max(hi) AS e FROM sp GROUP BY series),
  p AS (SELECT s.series, pos, v, e, EXISTS (SELECT 1 FROM sp WHERE sp.series = s.series AND s.pos BETWEEN lo AND hi) AS ins FROM fx_series s JOIN en USING (series)),
  g AS (SELECT series, avg(v) FILTER (ins) AS speech, avg(v) FILTER (NOT ins AND NOT pos > e + 2 AND pos > 1) AS gap, avg(v) FILTER (pos > e + 2) AS post FROM p GROUP BY series)
  SELECT series, round(coalesce(speech, 0), 6) AS speech, round(coalesce(gap, 0), 6) AS gap, round(coalesce(post, 0), 6) AS post, round(greatest(coalesce(speech, 0), coalesce(gap, 0), coalesce(post, 0)), 6) AS energy,
    round(coalesce(post, 0) / greatest(coalesce(speech, 0), 0.01), 6) AS ratio FROM g""")
def span_energy(t):
    sp = t.series.where("pos % 24 = 8").select("series", c("pos").alias("lo"), (c("pos") + 6).alias("hi"))
    return r6(S.span_energy(t.series, sp, "series", "pos", "v", "lo", "hi", 2, 64.0, 1), "speech", "gap", "post", "energy", "ratio")


@query("adjacent_gradient", "W28", """
  WITH d AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), i AS (SELECT vec_id, e, unnest(range(1, 65)) AS i FROM d)
  SELECT vec_id, round(avg(abs(e[i + 1] - e[i])) FILTER (i < 64), 6) AS across, round((avg(abs(e[i + 1] - e[i])) FILTER (i % 8 <> 0) + avg(abs(e[i + 8] - e[i])) FILTER (i <= 56)) / 2, 6) AS grid FROM i GROUP BY vec_id""")
def adjacent_gradient(t):
    return t.embeddings.select("vec_id", F.round(S.adjacent_gradient(c("embedding")), 6).alias("across"), F.round(S.adjacent_gradient(c("embedding"), 8), 6).alias("grid"))


@query("band_ratio", "W29", """
  SELECT l_suppkey, round(avg(l_quantity) FILTER (l_linenumber >= 5) / greatest(avg(l_quantity) FILTER (l_linenumber <= 2), 1e-6), 6) AS ratio FROM lineitem GROUP BY l_suppkey""")
def band_ratio(t):
    return r6(S.band_ratio(t.lineitem, ["l_suppkey"], c("l_linenumber") >= 5, c("l_linenumber") <= 2, "l_quantity"), "ratio")


@query("over_limit", "W30", """
  WITH r AS (SELECT l_suppkey AS k, CASE WHEN l_linenumber % 2 = 0 THEN 'pair' ELSE 'median' END AS measure, l_orderkey AS t, l_quantity AS v, l_suppkey % 7 > 0 AS bg, 1 + (l_suppkey % 3) * 0.1::DOUBLE AS scale FROM lineitem),
  o AS (SELECT *, bg AND v >= CASE measure WHEN 'pair' THEN 45 ELSE 48 END * scale AS ov FROM r)
  SELECT k, measure, count(*) FILTER (ov) AS rows_over, min(t) FILTER (ov) AS first_t, max(v) FILTER (ov) AS worst, arg_max(t, {'v': v, 't': -t}) FILTER (ov) AS worst_t,
    CASE WHEN bool_or(bg) THEN CASE WHEN count(*) FILTER (ov) > 0 THEN 'fail' ELSE 'ok' END END AS state FROM o GROUP BY k, measure""")
def over_limit(t):
    d = t.lineitem.selectExpr("l_suppkey AS k", "IF(l_linenumber % 2 = 0, 'pair', 'median') AS measure", "l_orderkey AS t", "l_quantity AS v")
    return S.over_limit(d, "k", "measure", "t", "v", {"pair": 45, "median": 48}, 1 + (c("k") % 3) * 0.1, c("k") % 7 > 0)


@query("spaced_top_k", "K1", f"""
  WITH RECURSIVE {ENERGY}, cn AS (SELECT e.series, e.pos AS spot, -round(e.energy, 9)::DOUBLE AS neg, arg_max(o.pos, {{'x': o.x, 'p': -o.pos}}) AS peak FROM en e JOIN en o ON o.series = e.series AND o.pos BETWEEN e.pos - 6 AND e.pos + 6
      WHERE e.energy >= 55 GROUP BY ALL),
  od AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY neg, spot) AS i FROM cn WHERE peak <= 700),
  st AS (SELECT series, 0::BIGINT AS i, []::BIGINT[] AS got FROM (SELECT DISTINCT series FROM od) x UNION ALL
    SELECT st.series, od.i, CASE WHEN len(got) < 4 AND len(list_filter(got, lambda p: abs(p - od.peak) < 50)) = 0 THEN list_append(got, od.peak) ELSE got END FROM st JOIN od ON od.series = st.series AND od.i = st.i + 1)
  SELECT series, unnest(got) AS pos FROM st WHERE i = (SELECT max(i) FROM od WHERE od.series = st.series)""")
def spaced_top_k(t):
    return S.spaced_top_k(changes(t), "series", "pos", "change", "energy", 4, 6, 50, 55.0, last_pos=700)


@query("similarity_to_reference", "J15", """
  WITH ref AS (SELECT label, arg_min(embedding, vec_id) AS ref FROM embeddings GROUP BY label)
  SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], ref::DOUBLE[]), 6) AS sim FROM embeddings JOIN ref USING (label)""")
def similarity_to_reference(t):
    ref = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("ref"))
    return M.similarity_to_reference(t.embeddings, ref, ["label"], "embedding").select("vec_id", F.round("sim", 6).alias("sim"))


@query("cast_verdict", "A35", """
  WITH ref AS (SELECT label, arg_min(embedding, vec_id) AS ref, arg_max(embedding, vec_id) AS oth FROM embeddings GROUP BY label),
  s AS (SELECT e.label, vec_id, vec_id // 3 AS frame, vec_id % 3 = 0 AS main, list_dot_product(embedding::DOUBLE[], ref::DOUBLE[]) * 4 AS sim, list_dot_product(embedding::DOUBLE[], oth::DOUBLE[]) * 4 AS other FROM embeddings e JOIN ref USING (label)),
  f AS (SELECT label, frame, max(sim) FILTER (main) AS sim, max(other) FILTER (main) AS other, max(CASE WHEN NOT main AND sim < 0.3 THEN 1 ELSE 0 END) AS st FROM s GROUP BY ALL),
  g AS (SELECT label, count(sim) AS faces, avg(sim) AS sim, min(sim) AS mn, avg(other) AS other, coalesce(sum(st) FILTER (sim IS NOT NULL), 0)::BIGINT AS strangers FROM f GROUP BY label)
  SELECT label, faces, round(sim, 6) AS sim, round(mn, 6) AS min_sim, round(other, 6) AS other, strangers, CASE WHEN faces = 0 THEN 'NOFACE' WHEN strangers >= 2 THEN 'FAIL' WHEN other >= sim THEN 'FAIL' WHEN sim >= 0.3 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM g""")
def cast_verdict(t):
    e = t.embeddings
    g = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("ref"), F.max_by("embedding", "vec_id").alias("oth"))
    s = M.similarity_to_reference(e, g.select("label", "ref"), ["label"], "embedding")
    s = M.similarity_to_reference(s, g.select("label", c("oth").alias("ref")), ["label"], "embedding", "other")
    s = s.select("label", F.floor(c("vec_id") / 3).alias("frame"), (c("vec_id") % 3 == 0).alias("main"), (c("sim") * 4).alias("sim"), (c("other") * 4).alias("other"))
    return r6(M.cast_verdict(s, ["label"], "frame", "main", "sim", "other"), "sim", "min_sim", "other")


CONSENSUS = """o AS (SELECT l_suppkey AS g, l_orderkey * 10 + l_linenumber AS take, avg(l_quantity) AS x, avg(l_extendedprice) AS y FROM lineitem GROUP BY ALL),
  md AS (SELECT g, quantile_cont(x, 0.5) AS mx, quantile_cont(y, 0.5) AS my FROM o GROUP BY g HAVING count(*) >= 2),
  dv AS (SELECT o.g, take, round(sqrt(((x - mx) / mx) * ((x - mx) / mx) + ((y - my) / my) * ((y - my) / my)), 9) AS dev FROM o JOIN md USING (g))"""


def takes(t: Tables):
    o = t.lineitem.groupBy(c("l_suppkey").alias("g"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("take")).agg(F.avg("l_quantity").alias("x"), F.avg("l_extendedprice").alias("y"))
    # Settled: medians and deviations both read it.
    return M.consensus(settle(o, "takes"), ["g"], "take", "x", "y").withColumn("deviation", scaled_round(c("deviation"), 9)).withColumn("class", deviation_class(c("deviation")))


@query("consensus", "A36,M4", f"WITH {CONSENSUS} SELECT g, CASE WHEN dev > 0.15 THEN 'DRIFTED' WHEN dev < 0.075 THEN 'consensus' ELSE 'near' END AS \"class\", count(*) AS takes, round(min(dev), 6) AS closest FROM dv GROUP BY ALL")
def consensus(t):
    return takes(t).groupBy("g", "class").agg(n("takes"), scaled_round(F.min("deviation"), 6).alias("closest"))


@query("survivor", "A36", f"""
  WITH {CONSENSUS}, r AS (SELECT g, take, row_number() OVER (PARTITION BY g ORDER BY dev, take) AS i, count(*) OVER (PARTITION BY g) AS n, count(*) FILTER (dev <= 0.15) OVER (PARTITION BY g) AS s FROM dv)
  SELECT g, n AS rows, s AS survivors, take AS survivor FROM r WHERE i = CASE WHEN s > 0 THEN s // 2 + 1 ELSE 1 END""")
def survivor(t):
    return M.survivor(takes(t), ["g"], "take")


@query("spread", "A37", """
  SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95) - quantile_cont(value, 0.05), 6) AS spread FROM events GROUP BY event_type""")
def spread(t):
    return r6(M.spread(t.events, ["event_type"], "value"), "median", "spread")


@query("assembly_drift", "A47", """
  WITH s AS (SELECT l_orderkey AS o, count(l_quantity) FILTER (l_quantity > 3) AS k, sum(l_quantity / 25 * 1000) FILTER (l_quantity > 3) AS ms FROM lineitem GROUP BY 1)
  SELECT o_orderkey AS o, CASE WHEN k >= 3 THEN floor(ms + 1e-6)::BIGINT END AS video_ms, (o_custkey % 40 * 200)::BIGINT AS placed_ms,
    CASE WHEN coalesce(k, 0) < 3 THEN 'unreadable' WHEN abs(floor(ms + 1e-6) - o_custkey % 40 * 200) <= 40 THEN 'ok' ELSE 'fail' END AS drift FROM orders LEFT JOIN s ON s.o = o_orderkey""")
def assembly_drift(t):
    s = t.lineitem.selectExpr("l_orderkey AS o", "IF(l_quantity > 3, l_quantity, NULL) AS frames", "25 AS fps")
    return M.assembly_drift(s, t.orders.selectExpr("o_orderkey AS o", "o_custkey % 40 * 200 AS placed_ms"), ["o"], 3)


@query("coverage_p95", "A49", """
  WITH r AS (SELECT l_suppkey AS g, l_discount AS a, l_tax AS b, l_quantity AS h, l_quantity > l_suppkey % 30 AS seen FROM lineitem),
  m AS (SELECT g, avg(seen::INT) AS coverage, count(*) FILTER (seen) AS seen, quantile_cont(a, 0.5) FILTER (seen) AS ma, quantile_cont(b, 0.5) FILTER (seen) AS mb, quantile_cont(h, 0.5) FILTER (seen) AS mh FROM r GROUP BY g),
  o AS (SELECT r.g, quantile_cont(abs((a - ma) - (b - mb)) / mh, 0.95) AS p FROM r JOIN m USING (g) WHERE r.seen GROUP BY r.g)
  SELECT m.g, round(coverage, 6) AS coverage, m.seen, CASE WHEN coverage >= 0.7 AND m.seen >= 20 THEN round(p, 9) END AS p95 FROM m LEFT JOIN o USING (g)""")
def coverage_p95(t):
    r = t.lineitem.selectExpr("l_suppkey AS g", "l_discount AS a", "l_tax AS b", "l_quantity AS h", "l_quantity > l_suppkey % 30 AS seen")
    return r6(M.coverage_p95(r, ["g"], "a", "b", "h", c("seen")), "coverage").withColumn("p95", F.round("p95", 9))
