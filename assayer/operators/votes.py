"""Blind votes and judge calls: what dropping or picking by a score is worth against what people prefer.

Rows here are votes and calls, of which one brief may hold a third. Every step is an aggregation with map-side
combine (no window over a brief), so the shuffle carries one row per item or pair and task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from assayer.session import settle

AXES = ("craft", "message", "warmth")
MIN_ITEMS = 3


def reject_reason(axes=AXES, lo: float = 1, hi: float = 10) -> Column:
    """Why a judge call is no score: missing, not finite or out of range; NULL when it is one."""
    missing = [F.col(a).isNull() for a in axes]
    nan = [F.isnan(F.col(a).cast("double")) for a in axes]
    outside = [~F.col(a).between(lo, hi) for a in axes]

    def any_of(cols: list[Column]) -> Column:
        out = cols[0]
        for c in cols[1:]:
            out = out | c
        return out

    return (F.when(any_of(missing), "missing").when(any_of(nan), "not a finite number")
            .when(any_of(outside), "out of range"))


def valid_calls(calls: DataFrame, axes=AXES, lo: float = 1, hi: float = 10) -> tuple[DataFrame, DataFrame]:
    """Split calls into scores and refused calls with their ``reason``."""
    checked = calls.withColumn("reason", reject_reason(axes, lo, hi))
    return checked.where("reason IS NULL").drop("reason"), checked.where("reason IS NOT NULL")


def item_total(calls: DataFrame, by: list[str], axes=AXES) -> DataFrame:
    """Mean over calls of the sum of the axes."""
    total = sum((F.col(a) for a in axes[1:]), F.col(axes[0]))
    return calls.groupBy(*by).agg(F.avg(total).alias("total"), F.count(F.lit(1)).alias("calls"))


def kill(totals: DataFrame, group: list[str], item: str = "item", min_items: int = MIN_ITEMS) -> DataFrame:
    """The lowest total of each group, ties to the smallest name. Smaller groups get no kill (``killed`` NULL)."""
    g = totals.groupBy(*group).agg(F.count(F.lit(1)).alias("items"), F.min(F.struct("total", F.col(item).alias("item"))).alias("m"))
    enough = F.col("items") >= min_items
    return g.select(*group, "items", F.when(enough, F.col("m.item")).alias("killed"), F.when(enough, F.col("m.total")).alias("total"))


def kill_refusals(totals: DataFrame, group: list[str], expected: DataFrame | None = None, min_items: int = MIN_ITEMS) -> DataFrame:
    """(group, items, reason) of each group that gets no kill: too few items, or none at all where ``expected`` names the group."""
    few = (totals.groupBy(*group).agg(F.count(F.lit(1)).alias("items")).where(F.col("items") < min_items)
           .withColumn("reason", F.lit(f"fewer than {min_items} items")))
    if expected is None:
        return few
    none = expected.select(*group).distinct().join(totals.select(*group).distinct(), group, "left_anti")
    return few.unionByName(none.select(*group, F.lit(0).cast("bigint").alias("items"), F.lit("no calls").alias("reason")))


def ship(totals: DataFrame, group: list[str], item: str = "item") -> DataFrame:
    """Everything but the killed item of each group."""
    dead = kill(totals, group, item).select(*group, F.col("killed").alias(item)).where(F.col(item).isNotNull())
    return totals.join(dead, [*group, item], "left_anti")


def pick_top(totals: DataFrame, group: list[str], item: str = "item") -> DataFrame:
    """The highest total of each group, ties to the smallest name."""
    g = totals.groupBy(*group).agg(F.min(F.struct((-F.col("total")).alias("neg"), F.col(item).alias("item"))).alias("m"))
    return g.select(*group, F.col("m.item").alias("picked"), (-F.col("m.neg")).alias("total"))


def both_directions(votes: DataFrame, keep: list[str]) -> DataFrame:
    """Each vote as (x against y) and (y against x) with ``pts`` 2 for a win, 1 for no preference, 0 for a loss."""
    def pts(side: str) -> Column:
        return F.when(F.col("winner").isNull(), 1).when(F.col("winner") == F.col(side), 2).otherwise(0)

    pair = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y"), pts("a").alias("pts")),
                   F.struct(F.col("b").alias("x"), F.col("a").alias("y"), pts("b").alias("pts")))
    return votes.select(*keep, F.inline(pair))


def pair_rates(sides: DataFrame, by: list[str], weight: Column | None = None) -> DataFrame:
    """Half points and votes of each ordered pair. ``weight`` counts a row several times (resampling)."""
    w = F.lit(1) if weight is None else weight
    return sides.groupBy(*by, "x", "y").agg(F.sum(F.col("pts") * w).cast("bigint").alias("half_points"),
                                            F.sum(w).cast("bigint").alias("n"))


def human_value(rates: DataFrame, by: list[str], min_items: int = MIN_ITEMS) -> DataFrame:
    """Mean win share of an item over the opponents it met; groups with fewer than ``min_items`` have none.

    Rounded to 12 places, so a tie does not depend on the order of a floating-point sum. ``policy_lines`` asks for as many
    scored items itself, so plans that end there pass ``min_items=1`` and save the join.
    """
    per = rates.where("n > 0").groupBy(*by, F.col("x").alias("item")).agg(
        F.round(F.avg(F.col("half_points") / (2 * F.col("n"))), 12).alias("value"), F.count(F.lit(1)).alias("opponents"))
    if min_items <= 1:
        return per
    sizes = per.groupBy(*by).agg(F.count(F.lit(1)).alias("__items")).where(F.col("__items") >= min_items)
    return per.join(sizes.drop("__items"), by)


def values_with_totals(values: DataFrame, totals: DataFrame, on: list[str]) -> DataFrame:
    """Only items with votes and scores take part, on both sides of every line."""
    return values.join(totals.select(*on, "total"), on)


def policy_lines(scored: DataFrame, by: list[str], min_items: int = MIN_ITEMS) -> DataFrame:
    """Per group: what a coin, the gate, the pick and the oracle ship.

    One aggregation: the mean without an item is (sum - value) / (n - 1). Ties go to the smallest name.
    """
    g = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("items"), F.sum("value").alias("__sum"),
        F.min(F.struct("total", "item", "value")).alias("__dead"),
        F.min(F.struct((-F.col("total")).alias("neg"), "item", "value")).alias("__top"),
        F.min(F.struct("value", "item")).alias("__worst"))
    n1 = F.col("items") - 1
    return g.where(F.col("items") >= min_items).select(
        *by, "items", (F.col("__sum") / F.col("items")).alias("uniform"),
        ((F.col("__sum") - F.col("__dead.value")) / n1).alias("gate"), F.col("__top.value").alias("pick"),
        ((F.col("__sum") - F.col("__worst.value")) / n1).alias("oracle"),
        F.col("__dead.item").alias("killed"), F.col("__dead.value").alias("killed_value"),
        F.col("__worst.item").alias("worst"), F.col("__worst.value").alias("worst_value"),
        F.col("__top.item").alias("picked"))


def policy_summary(lines: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Macro average of each line, the share of the gap each policy closes and gate minus pick."""
    m = lines.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("groups"), F.avg("uniform").alias("uniform"), F.avg("gate").alias("gate"),
        F.avg("pick").alias("pick"), F.avg("oracle").alias("oracle"))
    gap = F.when(F.col("oracle") != F.col("uniform"), F.col("oracle") - F.col("uniform"))
    return m.select("*", ((F.col("gate") - F.col("uniform")) / gap).alias("gap_closed"),
                    ((F.col("pick") - F.col("uniform")) / gap).alias("pick_gap_closed"),
                    (F.col("gate") - F.col("pick")).alias("gate_minus_pick"))


def round_robin(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Whether every unordered pair of a group's items met.

    Counted, not enumerated: k items met all of each other when k(k-1)/2 distinct pairs were seen.
    """
    met = pairs.select(*by, F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).where("lo <> hi").distinct()
    items = met.select(*by, F.explode(F.array("lo", "hi")).alias("item")).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("items"))
    seen = met.groupBy(*by).agg(F.count(F.lit(1)).alias("met"))
    return seen.join(items, by).select(*by, "items", "met",
                                       (F.col("met") == F.col("items") * (F.col("items") - 1) / 2).alias("round_robin"))


def kill_hits(scored: DataFrame, meetings: DataFrame, by: list[str]) -> DataFrame:
    """Whether the kill fell on the least-liked item, a coin's chance of that and the kill's rank from the bottom.

    NULL where the scored items did not all meet. ``meetings`` holds (by, x, y). The item table is used five times and
    is settled first, so the calls and votes behind it are read once.
    """
    scored = settle(scored.select(*by, "item", "value", "total"), "scored")
    lines = policy_lines(scored, by)
    member = scored.select(*by, "item")
    pairs = (meetings.select(*by, "x", "y").distinct()
             .join(member.withColumnRenamed("item", "x"), [*by, "x"], "left_semi")
             .join(member.withColumnRenamed("item", "y"), [*by, "y"], "left_semi"))
    rr = round_robin(pairs, by).select(*by, F.col("items").alias("met_items"), "round_robin")
    low = (scored.join(lines.select(*by, "killed_value", "worst_value"), by).groupBy(*by).agg(
        F.sum((F.col("value") == F.col("worst_value")).cast("bigint")).alias("bottom"),
        (1 + F.sum((F.col("value") < F.col("killed_value")).cast("bigint"))).alias("rank_bottom")))
    j = lines.join(low, by).join(rr, by, "left")
    ok = F.coalesce(F.col("round_robin") & (F.col("met_items") == F.col("items")), F.lit(False))
    return j.select(*by, "killed", ok.alias("round_robin"),
                    F.when(ok, F.col("killed_value") == F.col("worst_value")).alias("hit"),
                    F.when(ok, F.col("bottom") / F.col("items")).alias("coin"),
                    F.when(ok, F.col("rank_bottom")).alias("kill_rank"))


def pair_agreement(votes: DataFrame, by: list[str]) -> DataFrame:
    """Decisive votes per pair: agreeing rater pairs, all rater pairs, majority side, and no-preference votes."""
    sides = votes.groupBy(*by, "winner").agg(F.count(F.lit(1)).alias("k"))
    k = F.when(F.col("winner").isNotNull(), F.col("k"))
    return sides.groupBy(*by).agg(
        F.coalesce(F.sum(F.floor(k * (k - 1) / 2)), F.lit(0)).cast("bigint").alias("same"),
        F.coalesce(F.sum(k), F.lit(0)).alias("decisive"),
        F.coalesce(F.max(k), F.lit(0)).alias("majority"),
        F.coalesce(F.sum(F.when(F.col("winner").isNull(), F.col("k"))), F.lit(0)).alias("ties"),
    ).withColumn("pairs", F.floor(F.col("decisive") * (F.col("decisive") - 1) / 2).cast("bigint"))


def position_bias(verdicts: DataFrame, by: list[str], pair: str = "pair_id") -> DataFrame:
    """Share of distinct pairs on which B was picked; a pair with two different picks leaves the cell unreported."""
    per = verdicts.groupBy(*by, pair).agg(F.min("pick").alias("lo"), F.max("pick").alias("hi"))
    g = per.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"),
                             F.sum((F.col("lo") != F.col("hi")).cast("bigint")).alias("conflicts"),
                             F.sum(((F.col("lo") == "B") & (F.col("hi") == "B")).cast("bigint")).alias("b"))
    clean = F.col("conflicts") == 0
    return g.select(*by, "pairs", "conflicts", F.when(clean, F.col("b")).alias("picked_b"),
                    F.when(clean, F.col("b") / F.col("pairs")).alias("share_b"))


def matched_subset(base: DataFrame, other: DataFrame, on: list[str], pick: str = "pick") -> DataFrame:
    """Items judged without conflict in both variants, one row each with both picks."""
    def settled(df: DataFrame, name: str) -> DataFrame:
        return (df.groupBy(*on).agg(F.min(pick).alias("lo"), F.max(pick).alias("hi")).where("lo = hi")
                .select(*on, F.col("lo").alias(name)))
    return settled(base, "base_pick").join(settled(other, "other_pick"), on)


def position_shift(base: DataFrame, other: DataFrame, on: list[str], by: list[str], pick: str = "pick") -> DataFrame:
    """Share of B on the same items before and after a change of the prompt."""
    m = matched_subset(base, other, on, pick)
    return m.groupBy(*by).agg(F.count(F.lit(1)).alias("common"),
                              F.sum((F.col("base_pick") == "B").cast("bigint")).alias("base_b"),
                              F.sum((F.col("other_pick") == "B").cast("bigint")).alias("other_b"))


def axis_means(calls: DataFrame, by: list[str], axes=AXES) -> DataFrame:
    return calls.groupBy(*by).agg(*[F.avg(a).alias(a) for a in axes], F.count(F.lit(1)).alias("calls"))


def axis_correlation(means: DataFrame, values: DataFrame, on: list[str], axes=AXES) -> DataFrame:
    """Pearson r of each axis mean, and of their sum, with the human value."""
    total = sum((F.col(a) for a in axes[1:]), F.col(axes[0]))
    j = means.withColumn("sum", total).join(values.select(*on, "value"), on)
    long = j.unpivot(["value"], [*axes, "sum"], "axis", "score")
    return long.groupBy("axis").agg(F.corr("score", "value").alias("r"), F.count(F.lit(1)).alias("n"))


def score_resolution(numbered: DataFrame, item: str = "item", axes=AXES) -> DataFrame:
    """Distinct totals across items from the first call only and from all calls averaged."""
    total = sum((F.col(a) for a in axes[1:]), F.col(axes[0]))
    per = numbered.groupBy(item).agg(F.min_by(total, "rep").cast("double").alias("first"), F.round(F.avg(total), 6).alias("mean"))
    return per.agg(F.count_distinct("first").alias("first_call"), F.count_distinct("mean").alias("averaged"),
                   F.count(F.lit(1)).alias("items"))


def tie_groups(totals: DataFrame, group: list[str]) -> DataFrame:
    """Totals shared by several items of a group and where they sit."""
    t = totals.withColumn("score", F.round("total", 6))
    same = t.groupBy(*group, "score").agg(F.count(F.lit(1)).alias("tied"))
    ends = t.groupBy(*group).agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    return same.where("tied > 1").join(ends, group).select(
        *group, "score", "tied", F.when(F.col("score") == F.col("lo"), "bottom").when(F.col("score") == F.col("hi"), "top")
        .otherwise("middle").alias("place"))


def top_n(df: DataFrame, group: list[str], value: str, name: str, n: int) -> DataFrame:
    """The ``n`` largest values per group, ties to the smallest name.

    Spark applies the rank limit before the shuffle (window group limit), so a hot group sends n rows per task.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*group).orderBy(F.desc(value), F.asc(name))
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n).withColumn("place", F.col("place").cast("bigint"))


def winner_margin(values: DataFrame, group: list[str]) -> DataFrame:
    """Best item, runner-up and the margin between them."""
    t = top_n(values.select(*group, "item", "value"), group, "value", "item", 2)

    def at(place: int, col: str) -> Column:
        return F.max(F.when(F.col("place") == place, F.col(col)))

    return t.groupBy(*group).agg(at(1, "item").alias("winner"), at(1, "value").alias("winner_value"),
                                 at(2, "item").alias("runner_up"), at(2, "value").alias("runner_up_value")
                                 ).withColumn("margin", F.col("winner_value") - F.col("runner_up_value"))


def panel_mean(calls: DataFrame, by: list[str], first: str, second: str, axes=AXES) -> DataFrame:
    """Equal-weight mean of two judges' axis means, for items both scored; ``total`` is the sum of the axes."""
    means = axis_means(calls.where(F.col("judge").isin(first, second)), [*by, "judge"], axes)
    g = means.groupBy(*by).agg(*[F.avg(a).alias(a) for a in axes], F.count(F.lit(1)).alias("judges")).where("judges = 2").drop("judges")
    return g.withColumn("total", sum((F.col(a) for a in axes[1:]), F.col(axes[0])))


def worst_lost_all(scored: DataFrame, rates: DataFrame, by: list[str]) -> DataFrame:
    """Whether the lowest-value item lost every head-to-head, and the killed item's share against it."""
    lines = policy_lines(scored, by).select(*by, "killed", "worst")
    r = rates.join(lines, by)
    return r.groupBy(*by, "killed", "worst").agg(
        F.min(F.when(F.col("x") == F.col("worst"), (F.col("half_points") < F.col("n")).cast("int"))).alias("lost"),
        F.max(F.when((F.col("x") == F.col("killed")) & (F.col("y") == F.col("worst")), F.col("half_points") / (2 * F.col("n")))).alias("killed_vs_worst"),
    ).select(*by, "killed", "worst", (F.col("lost") == 1).alias("lost_all"), "killed_vs_worst")


def constant_baseline(engine_values: DataFrame, group: str = "brief", engine: str = "engine") -> DataFrame:
    """Leave one group out: the engine with the best mean on all other groups, and its value on the held-out one.

    The statistics of "all others" are the totals minus the group's own, so no group is compared with every other. Engines are
    ranked by their totals in one task, a row each; a group meets only the engines it holds and one more.
    ``engine_values`` has one row per (group, engine).
    """
    own = engine_values.groupBy(group, engine).agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("c"))
    total = own.groupBy(engine).agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    neg = lambda x, n: (-F.round(F.col(x) / F.col(n), 12)).alias("neg")
    ranked = total.select(engine, "ts", "tc", neg("ts", "tc")).withColumn("rank", F.row_number().over(W.orderBy("neg", engine)))
    held = own.join(ranked.drop("neg"), engine)
    inside = (held.select(group, engine, (F.col("ts") - F.col("s")).alias("s2"), (F.col("tc") - F.col("c")).alias("c2"), F.col("s").alias("held"))
              .where("c2 > 0").select(group, neg("s2", "c2"), F.col(engine).alias("engine"), "held"))
    # Engines the group lacks compete with their totals, so only the best of them counts: the first rank the group does not hold.
    gaps = (held.groupBy(group).agg(F.array_sort(F.collect_set("rank")).alias("r"))
            .select(group, (F.size(F.filter("r", lambda x, i: x == i + 1)) + 1).alias("rank")))
    outside = gaps.join(ranked, "rank").select(group, "neg", F.col(engine).alias("engine"), F.lit(None).cast("double").alias("held"))
    best = inside.unionByName(outside).groupBy(group).agg(F.min(F.struct("neg", "engine", "held")).alias("m"))
    return best.select(group, F.col("m.engine").alias("engine"), (-F.col("m.neg")).alias("mean_elsewhere"), F.col("m.held").alias("held_out"))


def picks_vs_best(values: DataFrame, picks: DataFrame, by: list[str]) -> DataFrame:
    """Per picker: mean value of what it picked and on how many groups that was people's best.

    ``picks``: (picker, by, item). A picker is any function that yields such rows.
    """
    best = values.groupBy(*by).agg(F.min(F.struct((-F.col("value")).alias("neg"), "item")).alias("m")).select(*by, F.col("m.item").alias("best"))
    j = picks.join(values.select(*by, "item", "value"), [*by, "item"]).join(best, by)
    return j.groupBy("picker").agg(F.count(F.lit(1)).alias("groups"), F.avg("value").alias("mean_value"),
                                   F.sum((F.col("item") == F.col("best")).cast("bigint")).alias("matched"))


def rep_completeness(numbered: DataFrame, item: str = "item") -> DataFrame:
    """Items whose calls are not 1..N exactly once, with N the most common count (the smallest when tied)."""
    per = numbered.groupBy(item).agg(F.count(F.lit(1)).alias("calls"), F.countDistinct("rep").alias("reps"),
                                     F.min("rep").alias("lo"), F.max("rep").alias("hi"))
    freq = per.groupBy("calls").agg(F.count(F.lit(1)).alias("f"))
    modal = freq.agg(F.min(F.struct((-F.col("f")).alias("neg"), "calls"))["calls"]).scalar()
    whole = (F.col("calls") == F.col("n")) & (F.col("reps") == F.col("n")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n"))
    return per.withColumn("n", modal).where(~whole).select(item, "calls", "reps", "n")


def coverage(voted: DataFrame, scored: DataFrame, item: str = "item") -> DataFrame:
    """Voted items without any score."""
    return voted.select(item).distinct().join(scored.select(item).distinct(), item, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Identities named more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
