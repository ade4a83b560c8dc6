"""Append-only event ledgers: moves, bounds, gaps, missing records and spend.

A run can be as long as the whole ledger, so nothing here windows over a whole run: order-dependent steps go through
``ordered.scan_in_order`` and everything else is an aggregation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.functions.verdicts import MAX_EYE_REJECTS, MAX_SCENE_REROLLS, MAX_WITHDRAWALS
from assayer.operators.ordered import chunk_of, outside, scan_in_order
from assayer.sources.inline import inline_table

# The routes of the process, its stop edges and the one that crosses a run boundary.
ROUTES = {
    "board": ["render", "ledger"], "render": ["render", "closer", "ledger"], "closer": ["build", "ledger"],
    "build": ["ad_gates", "ledger"], "ad_gates": ["ship_gate", "eye", "ledger"],
    "eye": ["ship_gate", "render", "closer", "build", "ledger"], "ship_gate": ["deliver", "eye", "ledger"],
    "deliver": ["review"], "review": ["render", "closer", "build", "ledger"],
}
CROSS_RUN_EDGES = [("ledger", "board")]
END_KINDS = ("close", "waiting", "crashed")


def edges(spark, cross_run: bool = False) -> DataFrame:
    rows = [(a, b) for a, targets in ROUTES.items() for b in targets] + (CROSS_RUN_EDGES if cross_run else [])
    return inline_table(spark, rows, "src STRING, dst STRING")


def stop_edges(spark) -> DataFrame:
    return inline_table(spark, [(a, "ledger") for a, t in ROUTES.items() if "ledger" in t and a != "review"], "src STRING, dst STRING")


def row_moves(ledger: DataFrame, chunk: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Consecutive steps of each run as (run, seq, src, dst)."""
    cols = ["run", "seq", "step", *(keep or [])]
    led = ledger.select(*cols) if chunk is None else ledger
    nxt = scan_in_order(led, ["run"], ["seq"], chunk_of("seq") if chunk is None else chunk, lead={"dst": F.col("step")})
    return nxt.where("dst IS NOT NULL").select("run", "seq", F.col("step").alias("src"), "dst", *(keep or []))


def trail_moves(df: DataFrame, trail: str, keep: list[str]) -> DataFrame:
    """Consecutive pairs of each row's own trail."""
    t = F.col(trail)
    n = F.size(t)
    pairs = F.when(n > 1, F.arrays_zip(F.slice(t, F.lit(1), n - 1).alias("src"), F.slice(t, F.lit(2), n - 1).alias("dst")))
    return df.select(*keep, F.inline(pairs)).toDF(*keep, "src", "dst")


def unmapped_moves(moves: DataFrame, allowed: DataFrame) -> DataFrame:
    """Moves without an edge. The edge list is a few dozen rows, so the optimizer broadcasts it by size."""
    return moves.join(allowed, ["src", "dst"], "left_anti")


def directly_follows(moves: DataFrame, by: list[str] | None = None) -> DataFrame:
    return moves.groupBy(*(by or []), "src", "dst").agg(F.count(F.lit(1)).alias("moves"))


def conformance(moves: DataFrame, allowed: DataFrame, by: list[str]) -> DataFrame:
    """Moves and how many of them have an edge, per ``by``. Moves are counted per edge before they meet the edge list."""
    per = directly_follows(moves, by).join(allowed.withColumn("mapped", F.lit(True)), ["src", "dst"], "left")
    return per.groupBy(*by).agg(F.sum("moves").alias("moves"), F.coalesce(F.sum(F.when(F.col("mapped"), F.col("moves"))), F.lit(0)).alias("mapped"))


def seq_gaps(ledger: DataFrame) -> DataFrame:
    """Places where a run's ``seq`` does not follow its predecessor by one, the first row against 0."""
    prev = scan_in_order(ledger.select("run", "seq"), ["run"], ["seq"], chunk_of("seq"), lag={"prev": F.col("seq")})
    before = F.coalesce("prev", F.lit(0))
    return prev.where(F.col("seq") != before + 1).select("run", before.alias("after_seq"), "seq")


def attempt_ordinal(requests: DataFrame, keys: list[str], order: list[str], chunk: Column) -> DataFrame:
    """``nth``: which request for its keys a row is."""
    return scan_in_order(requests, keys, order, chunk, row_number="nth")


def missing_rolls(numbered: DataFrame, claimed: str) -> DataFrame:
    """Rows claiming a later roll than the record holds."""
    return numbered.where(F.col(claimed) > F.col("nth"))


def last_before(ledger: DataFrame, subject: Column, source: Column, value: Column, chunk: Column | None = None) -> DataFrame:
    """Each ``subject`` row with ``value`` of the newest ``source`` row strictly before it in its run."""
    found = scan_in_order(ledger, ["run"], ["seq"], chunk_of("seq") if chunk is None else chunk,
                          fill_before={"found": F.when(source, F.struct(F.col("seq").alias("at"), value.alias("value")))})
    return found.where(subject)


def exists_before(rows: DataFrame, events: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """``after``: some event of the same key has an earlier day. Only the earliest day of a key matters."""
    first = events.where(F.col(day).isNotNull()).groupBy(*keys).agg(F.min(day).alias("__first"))
    return rows.join(first, keys, "left").withColumn("after", F.coalesce(F.col("__first") < F.col(day), F.lit(False))).drop("__first")


def unlanded_by_id(requests: DataFrame, landings: DataFrame, key: str = "request_id") -> DataFrame:
    return requests.join(landings.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def unlanded_by_key(requests: DataFrame, landings: DataFrame, scene: str = "scene", engine: str = "engine") -> DataFrame:
    """Requests per (scene, engine) beyond their landings; a landing without an engine answers its scene on any engine."""
    asked = requests.groupBy(scene, engine).agg(F.count(F.lit(1)).alias("asked"))
    exact = landings.where(F.col(engine).isNotNull()).groupBy(scene, engine).agg(F.count(F.lit(1)).alias("exact"))
    wild = landings.where(F.col(engine).isNull()).groupBy(scene).agg(F.count(F.lit(1)).alias("wild"))
    j = asked.join(exact, [scene, engine], "left").join(wild, scene, "left")
    have = F.coalesce("exact", F.lit(0)) + F.coalesce("wild", F.lit(0))
    return j.select(scene, engine, "asked", have.alias("have"), F.greatest(F.lit(0), F.col("asked") - have).alias("unlanded"))


def kind_counts(ledger: DataFrame, kinds: list[str]) -> DataFrame:
    """One column per kind, plus the last step of each run."""
    cols = [F.sum((F.col("kind") == k).cast("bigint")).alias(k) for k in kinds]
    return ledger.groupBy("run").agg(F.count(F.lit(1)).alias("rows"), *cols, F.max(F.struct("seq", "step"))["step"].alias("last_step"))


def never_recorded(ledger: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Per run MAP<what, rows short>: ``rules`` maps a name to an aggregate that is > 0 when something is missing."""
    g = ledger.groupBy("run").agg(*[c.cast("bigint").alias(f"__{i}") for i, c in enumerate(rules.values())])
    entries = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"__{i}").alias("v")) for i, k in enumerate(rules)])
    missing = F.map_from_entries(F.filter(entries, lambda e: e["v"] > 0))
    return g.select("run", missing.alias("never"))


def over_bound(rerolls: DataFrame, send_backs: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """(what, subject, n) loops past their ceiling. Inputs: rerolls(scene, engine), send_backs(spot), withdrawals(spot)."""
    def past(df: DataFrame, what: str, keys: list[str], limit: int) -> DataFrame:
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        return g.select(F.lit(what).alias("what"), F.concat_ws(" on ", *[F.col(k).cast("string") for k in keys]).alias("subject"), "n")
    return (past(rerolls, "re-rolled", ["scene", "engine"], MAX_SCENE_REROLLS)
            .unionByName(past(send_backs, "sent back", ["spot"], MAX_EYE_REJECTS))
            .unionByName(past(withdrawals, "withdrawn", ["spot"], MAX_WITHDRAWALS)))


VERSION_IN_TEXT = r"(?<![a-z_])v(\d+)\b"  # fixed value


def delivered_versions(withdrawals: DataFrame, gated: DataFrame) -> DataFrame:
    """(ad, version) proven delivered: the cut withdrawn and every version its reason names.

    withdrawals(ad, reason, ord), gated(ad, version, ord): the cut pulled by an ad's first withdrawal is its newest
    gated version, or 1; a later withdrawal pulls the highest version proven so far.
    """
    named = withdrawals.select("ad", "ord", F.transform(F.regexp_extract_all("reason", F.lit(VERSION_IN_TEXT), 1), lambda v: v.cast("int")).alias("named"))
    peak = named.select("ad", "ord", "named", F.array_max("named").alias("peak"))
    run = scan_in_order(peak, ["ad"], ["ord"], chunk_of("ord"), row_number="nth", maxes={"high": F.col("peak")})
    run = scan_in_order(run, ["ad"], ["ord"], chunk_of("ord"), lag={"before": F.col("high")})
    g = gated.groupBy("ad").agg(F.max(F.struct("ord", "version"))["version"].alias("g"))
    start = F.coalesce("g", F.lit(1))
    pulled = F.when(F.col("nth") == 1, start).otherwise(F.greatest(start, F.col("before")))
    every = F.concat(F.array(pulled.cast("int")), "named")
    return run.join(g, "ad", "left").select("ad", F.explode(every).alias("version")).distinct()


def ungated_deliveries(delivered: DataFrame, gated: DataFrame, passes: DataFrame, reviews: DataFrame) -> DataFrame:
    """(issue, ad, version): deliveries no gate read, ship passes of ads no gate read, reviews with no verdict."""
    a = delivered.select("ad", "version").distinct().join(gated.select("ad", "version").distinct(), ["ad", "version"], "left_anti")
    b = passes.select("ad").distinct().join(gated.select("ad").distinct(), "ad", "left_anti")
    c = reviews.where(F.col("verdict").isNull()).select("ad").distinct()
    none = F.lit(None).cast("bigint").alias("version")
    return (a.select(F.lit("no gate reading").alias("issue"), "ad", F.col("version").cast("bigint").alias("version"))
            .unionByName(b.select(F.lit("pass without reading").alias("issue"), "ad", none))
            .unionByName(c.select(F.lit("review without verdict").alias("issue"), "ad", none)))


def version_gaps(versions: DataFrame, ad: str = "ad", version: str = "version") -> DataFrame:
    """(ad, first, last) ranges of versions missing between 1 and the highest."""
    have = versions.select(ad, version).where(F.col(version) >= 1).distinct()
    prev = scan_in_order(have, [ad], [version], chunk_of(version), lag={"prev": F.col(version)})
    before = F.coalesce("prev", F.lit(0))
    return prev.where(F.col(version) > before + 1).select(ad, (before + 1).cast("bigint").alias("first"), (F.col(version) - 1).cast("bigint").alias("last"))


def last_per_group(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The newest row's columns per key, from one aggregation."""
    m = F.max(F.struct(*order, *[c for c in cols if c not in order])).alias("__m")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"__m.{c}").alias(c) for c in cols])


def out_of_order_gates(ledger: DataFrame, by: str, early: Column, late: Column, line: str) -> DataFrame:
    """Groups whose ``early`` rows all stand before the first ``late`` row."""
    g = ledger.groupBy(by).agg(F.max(F.when(early, F.col(line))).alias("last_early"), F.min(F.when(late, F.col(line))).alias("first_late"))
    return g.where("last_early < first_late")


def running_spend(requests: DataFrame, budget_cents: int, chunk: Column | None = None) -> DataFrame:
    """Cumulative cents per run and what happens to each request: sent, refused (the first past the budget or
    without a price) or not sent (everything after it). Spending the budget exactly is allowed."""
    rows = requests.withColumn("__chunk", chunk_of("seq") if chunk is None else chunk)
    inside = Window.partitionBy("run", "__chunk").orderBy("seq")
    rows = rows.withColumn("__own", F.coalesce(F.sum("cents").over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    # A chunk acts on what was spent before it through its sum, its largest running sum and whether a price is missing. Both
    # passes over these summaries are small; the rows are shuffled and ordered once.
    brief = rows.groupBy("run", "__chunk").agg(F.sum("cents").alias("__sum"), F.max("__own").alias("__most"), F.max(F.col("cents").isNull()).alias("__gap"))
    before = outside(brief, ["run"], {"__sum": F.sum}).select("run", "__chunk", F.coalesce("__sum", F.lit(0)).alias("__paid"))
    marks = before.select(F.col("run").alias("__run"), F.col("__chunk").alias("__at"), "__paid")
    met = brief.join(marks, brief["run"].eqNullSafe(marks["__run"]) & (brief["__chunk"] == marks["__at"]))
    broken = met.select("run", "__chunk", "__paid", (F.col("__gap") | (F.col("__paid") + F.col("__most") > budget_cents)).cast("int").alias("__broke"))
    late = outside(broken.select("run", "__chunk", "__broke"), ["run"], {"__broke": F.max}).select(
        F.col("run").alias("__run"), F.col("__chunk").alias("__at"), (F.coalesce("__broke", F.lit(0)) > 0).alias("__late"))
    carry = broken.drop("__broke").join(late, F.col("run").eqNullSafe(F.col("__run")) & (F.col("__chunk") == F.col("__at"))).select("__run", "__at", "__paid", "__late")
    run = rows.join(carry, rows["run"].eqNullSafe(carry["__run"]) & (rows["__chunk"] == carry["__at"]))
    run = run.withColumn("spent", F.col("__paid") + F.col("__own")).withColumn("__bad", (F.col("cents").isNull() | (F.col("spent") > budget_cents)).cast("int"))
    earlier = F.coalesce(F.max("__bad").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) > 0
    state = F.when(F.col("__late") | earlier, "not sent").when(F.col("__bad") > 0, "refused").otherwise("sent")
    return run.withColumn("state", state).select(*requests.columns, "spent", "state")


def spend_states(requests: DataFrame, chunk: Column) -> DataFrame:
    """Adds ``state`` from ``bad``: what precedes the first bad request of a run is sent, that one is refused, the rest not
    sent. Bad requests are counted in a second ordered scan, so no row of a hot run meets a join."""
    run = scan_in_order(requests, ["run"], ["seq"], chunk, sums={"__bads": F.col("bad").cast("bigint")})
    state = F.when(F.col("__bads") == 0, "sent").when(F.col("bad") & (F.col("__bads") == 1), "refused").otherwise("not sent")
    return run.withColumn("state", state).drop("__bads", "bad")


def spend_summary(requests: DataFrame, budget_cents: int, chunk: Column | None = None) -> DataFrame:
    """Per run: cents sent, the first refused request and how many were not sent."""
    s = running_spend(requests, budget_cents, chunk)
    return s.groupBy("run").agg(F.coalesce(F.sum(F.when(F.col("state") == "sent", F.col("cents"))), F.lit(0)).alias("sent_cents"),
                                F.min(F.when(F.col("state") == "refused", F.col("seq"))).alias("refused_seq"),
                                F.sum((F.col("state") == "not sent").cast("bigint")).alias("not_sent"))


def attempt_vs_outcome(ledger: DataFrame, flag: Column, blocked: Column) -> DataFrame:
    """Per run: whether the first attempt complied, whether the last did, and how many attempts were blocked."""
    f = flag.alias("f")
    return ledger.groupBy("run").agg(F.min(F.struct("seq", f))["f"].alias("first_ok"), F.max(F.struct("seq", f))["f"].alias("final_ok"),
                                     F.sum(blocked.cast("bigint")).alias("blocked"))


def request_outcomes(requests: DataFrame, landings: DataFrame, key: str = "request_id") -> DataFrame:
    """Each request with the status of its newest landing, ``none`` without one."""
    newest = landings.groupBy(key).agg(F.max(F.struct("seq", "status"))["status"].alias("status"))
    return requests.join(newest, key, "left").withColumn("status", F.coalesce("status", F.lit("none")))


def redactions(ledger: DataFrame, notes: DataFrame) -> DataFrame:
    """Rows with how many redacted or corrected notes name their seq. No row is dropped."""
    named = notes.select("run", F.explode("seqs").alias("seq")).groupBy("run", "seq").agg(F.count(F.lit(1)).alias("notes"))
    return ledger.join(named, ["run", "seq"], "left").withColumn("notes", F.coalesce("notes", F.lit(0)))


def outside_model(ledger: DataFrame, modelled: list[str]) -> DataFrame:
    """Rows per kind that no edge models."""
    return ledger.where(~F.col("kind").isin(modelled)).groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))
