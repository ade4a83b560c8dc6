"""Labelled exemplars against thresholds, and judge answers against labels."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions import verdicts
from assayer.operators.quantiles import lower_median

CEILING, FLOOR = "ceiling", "floor"


def bracket(exemplars: DataFrame, gates: DataFrame, on: list[str]) -> DataFrame:
    """Where each gate's constant sits between its labelled passes and rejects.

    DERIVED strictly inside, REFUTED otherwise, AUTHORED when a side has no label. Labels with another verdict are
    counted as excluded. ``gates``: on, polarity, value, scale, gating. Labels are reduced to one row per key
    before they meet the gates.
    """
    m = F.col("measured").cast("double")
    ok = m.isNotNull() & ~F.isnan(m)
    passes, rejects = F.when((F.col("verdict") == "pass") & ok, m), F.when((F.col("verdict") == "reject") & ok, m)
    per = exemplars.groupBy(*on).agg(
        F.count(passes).alias("n_pass"), F.count(rejects).alias("n_reject"),
        F.sum((~F.col("verdict").isin("pass", "reject")).cast("bigint")).alias("n_excluded"),
        F.min(passes).alias("p_lo"), F.max(passes).alias("p_hi"), F.min(rejects).alias("r_lo"), F.max(rejects).alias("r_hi"))
    up = F.col("polarity") == CEILING
    j = gates.join(per, on, "left").na.fill(0, ["n_pass", "n_reject", "n_excluded"])
    both = (F.col("n_pass") > 0) & (F.col("n_reject") > 0)
    at = F.col("value") * F.col("scale")
    pe, re_ = F.when(up, F.col("p_hi")).otherwise(F.col("p_lo")), F.when(up, F.col("r_lo")).otherwise(F.col("r_hi"))
    inside = F.when(up, (pe < at) & (at < re_)).otherwise((re_ < at) & (at < pe))
    return j.select(*gates.columns, "n_pass", "n_reject", "n_excluded", F.when(both, pe).alias("pass_edge"),
                    F.when(both, re_).alias("reject_edge"),
                    F.when(~both, "AUTHORED").when(inside, "DERIVED").otherwise("REFUTED").alias("status"))


def gate_listing(brackets: DataFrame, name: str) -> DataFrame:
    """Gating constants first, then by status and name."""
    return brackets.orderBy((~F.col("gating")).asc(), "status", name)


def orphans(exemplars: DataFrame, gates: DataFrame, on: list[str]) -> DataFrame:
    """Labels no gate reads."""
    return exemplars.join(gates.select(*on).distinct(), on, "left_anti")


def reproduce(labels: DataFrame, recomputed: DataFrame, on: list[str], relative: dict[str, float] | None = None,
              absolute: dict[str, float] | None = None, probe: str = "probe") -> DataFrame:
    """Label against recomputed measure within the probe's tolerance; a label with no recompute is a failure."""
    tol = F.lit(0.05)
    for p, k in (absolute or {}).items():
        tol = F.when(F.col(probe) == p, F.lit(k)).otherwise(tol)
    for p, k in (relative or {}).items():
        tol = F.when(F.col(probe) == p, F.greatest(F.lit(0.05), F.lit(k) * F.abs("measured"))).otherwise(tol)
    j = labels.join(recomputed.select(*on, "recomputed"), on, "left")
    ok = F.coalesce(F.abs(F.col("recomputed") - F.col("measured")) <= tol, F.lit(False)) & ~F.isnan(F.coalesce("recomputed", F.lit(float("nan"))))
    return j.withColumn("ok", ok)


def recompute_with(df: DataFrame, registry: dict[str, Column], probe: str = "probe") -> DataFrame:
    """Recompute each row with the column expression its probe registered; NULL for an unregistered probe."""
    out = F.lit(None).cast("double")
    for name, expr in registry.items():
        out = F.when(F.col(probe) == name, expr.cast("double")).otherwise(out)
    return df.withColumn("recomputed", out)


def confusion(df: DataFrame, by: list[str]) -> DataFrame:
    """Recall on FAIL labels, specificity on PASS labels and disagreements. Columns ``label``, ``verdict``."""
    fail, ok = F.col("label") == "FAIL", F.col("label") == "PASS"

    def n(cond: Column, name: str) -> Column:
        return F.sum(F.coalesce(cond, F.lit(False)).cast("bigint")).alias(name)

    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), n(fail, "n_fail"), n(ok, "n_pass"),
                               n(fail & (F.col("verdict") == "FAIL"), "caught"), n(ok & (F.col("verdict") == "PASS"), "cleared"),
                               n(~F.col("verdict").eqNullSafe(F.col("label")), "disagree"))


def vote_counts(votes: DataFrame, by: list[str]) -> DataFrame:
    """Per item: fails, oks, votes, and the earliest break named."""
    state = F.col("state")
    return votes.groupBy(*by).agg(
        F.sum(F.coalesce(state == "fail", F.lit(False)).cast("bigint")).alias("fails"),
        F.sum(F.coalesce(state == "ok", F.lit(False)).cast("bigint")).alias("oks"),
        F.count(F.lit(1)).alias("votes"))


def unanimous_tally(votes: DataFrame, by: list[str]) -> DataFrame:
    return vote_counts(votes, by).withColumn("state", verdicts.tally(F.col("fails"), F.col("oks"), F.col("votes")))


def lenient_tally(votes: DataFrame, by: list[str]) -> DataFrame:
    return vote_counts(votes, by).withColumn("state", verdicts.lenient_tally(F.col("fails"), F.col("oks"), F.col("votes")))


def pick_break(votes: DataFrame, by: list[str], t: str = "t") -> DataFrame:
    """On a fail the lower median of the breaks the votes named, on a split the earliest; no row otherwise."""
    states = unanimous_tally(votes, by).select(*by, F.col("state").alias("answer")).where("answer IN ('fail', 'split')")
    named = votes.where((F.col("state") == "fail") & F.col(t).isNotNull())
    earliest = named.groupBy(*by).agg(F.min(F.col(t).cast("double")).alias("first"))
    middle = lower_median(named, by, t, "middle").select(*by, "middle")
    return (states.join(earliest, by).join(middle, by)
            .select(*by, "answer", F.when(F.col("answer") == "fail", F.col("middle")).otherwise(F.col("first")).alias("t")))


def hard_then_soft(df: DataFrame, gates: list[str], soft: list[str]) -> DataFrame:
    """``blocked`` when a hard gate is not passed; soft scores only for items that pass every gate."""
    passed = F.lit(True)
    for g in gates:
        passed = passed & F.coalesce(F.col(g), F.lit(False))
    keep = [c for c in df.columns if c not in soft]
    return df.select(*keep, (~passed).alias("blocked"), *[F.when(passed, F.col(c)).alias(c) for c in soft])
