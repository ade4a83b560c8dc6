"""Races between engines over a panel of probe readings.

Long form throughout: readings(brief, engine, probe, value), panel(brief, probe, direction, is_gate).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_panels(briefs: DataFrame, panel_rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """Panel rows of each brief; a field an override sets wins over the panel's default.

    briefs(brief, panel_type), panel_rows(panel_type, probe, direction, bar, is_gate),
    overrides(brief, probe, direction, bar, clear_bar)
    """
    o = overrides.select("brief", "probe", F.col("direction").alias("o_direction"), F.col("bar").alias("o_bar"), "clear_bar")
    j = briefs.join(panel_rows, "panel_type").join(o, ["brief", "probe"], "left")
    bar = F.when(F.coalesce("clear_bar", F.lit(False)), F.lit(None)).otherwise(F.coalesce("o_bar", "bar"))
    return j.select("brief", "panel_type", "probe", F.coalesce("o_direction", "direction").alias("direction"), bar.alias("bar"), "is_gate")


def usable(readings: DataFrame) -> DataFrame:
    v = F.col("value").cast("double")
    return readings.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def missing_readings(readings: DataFrame, panel: DataFrame) -> DataFrame:
    """(brief, engine, probe) a panel asks for and nobody measured."""
    engines = readings.select("brief", "engine").distinct()
    wanted = engines.join(panel.select("brief", "probe"), "brief")
    return wanted.join(usable(readings).select("brief", "engine", "probe"), ["brief", "engine", "probe"], "left_anti")


def race_status(readings: DataFrame, panel: DataFrame) -> DataFrame:
    """Briefs with how many readings are missing; a race with any missing reading has no winner."""
    miss = missing_readings(readings, panel).groupBy("brief").agg(
        F.count(F.lit(1)).alias("missing"), F.countDistinct("engine").alias("engines_missing"))
    return (readings.select("brief").distinct().join(miss, "brief", "left").na.fill(0, ["missing", "engines_missing"])
            .withColumn("status", F.when(F.col("missing") > 0, "missing_scores").otherwise("complete")))


def row_winners(readings: DataFrame, panel: DataFrame) -> DataFrame:
    """(brief, engine, probe, signed, is_gate, won): every engine tied for a row's best reading wins that row.

    ``signed`` turns every direction into "more is better"; it is NULL for a reading that is no number.
    """
    r = readings.join(panel.select("brief", "probe", "direction", "is_gate"), ["brief", "probe"])
    v = F.col("value").cast("double")
    number = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    r = r.withColumn("signed", F.when(number, F.when(F.col("direction") == "up", v).otherwise(-v)))
    best = r.groupBy("brief", "probe").agg(F.max("signed").alias("best"))
    return r.join(best, ["brief", "probe"]).select("brief", "engine", "probe", "signed", "is_gate",
                                                   F.coalesce(F.col("signed") == F.col("best"), F.lit(False)).alias("won"))


def row_wins(winners: DataFrame) -> DataFrame:
    """(brief, engine, wins, gate, readings): rows won, the gate reading and how many rows were read."""
    return winners.groupBy("brief", "engine").agg(F.sum(F.col("won").cast("bigint")).alias("wins"),
                                                  F.max(F.when(F.col("is_gate"), F.col("signed"))).alias("gate"),
                                                  F.count("signed").alias("readings"))


def race_score(readings: DataFrame, panel: DataFrame) -> DataFrame:
    """Most rows wins; a tie goes to the gate row among the tied; a tie there stays unresolved.

    Only complete races with at least two engines are scored. Engines are counted level by level, (wins, gate) then
    wins then brief, so the leaders come out of partial aggregates and no race is compared with itself.
    """
    size = panel.groupBy("brief").agg(F.count(F.lit(1)).alias("rows"))
    engines = row_wins(row_winners(readings, panel))
    same = engines.groupBy("brief", "wins", "gate").agg(F.count(F.lit(1)).alias("c"), F.min("engine").alias("one"), F.min("readings").alias("read"))
    level = same.groupBy("brief", "wins").agg(F.sum("c").alias("leaders"), F.min("one").alias("lead_one"), F.min("read").alias("read"),
                                              F.max(F.struct("gate", "c", "one")).alias("final"))
    top = level.groupBy("brief").agg(F.sum("leaders").alias("engines"), F.min("read").alias("read"),
                                     F.max(F.struct("wins", "leaders", "lead_one", "final")).alias("m"))
    full = top.join(size, "brief").where((F.col("read") == F.col("rows")) & (F.col("engines") >= 2))
    alone, gate = F.col("m.leaders") == 1, F.col("m.final.c") == 1
    return full.select("brief", "engines", F.col("m.wins").alias("top_wins"), F.col("m.leaders").alias("leaders"),
                       F.when(alone, F.col("m.lead_one")).when(gate, F.col("m.final.one")).alias("winner"),
                       F.when(alone, "row_count").when(gate, "gate").otherwise("unresolved_gate_tie").alias("decided_by"))


def race_record(readings: DataFrame, panel: DataFrame) -> DataFrame:
    """One row per race in the ledger's shape, with a wins map and the row winners. Its size is the panel's, per race."""
    w = row_winners(readings, panel)
    maps = row_wins(w).groupBy("brief").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("engine", "wins")))).alias("row_wins"))
    rows = (w.where("won").groupBy("brief", "probe").agg(F.array_sort(F.collect_list("engine")).alias("engines"))
            .groupBy("brief").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("probe", "engines")))).alias("row_winners")))
    return race_score(readings, panel).join(maps, "brief").join(rows, "brief")


def race_agreement(races: DataFrame, recorded: DataFrame) -> DataFrame:
    """Computed against recorded winner; NULL unless both exist, with a reason where they differ."""
    j = races.join(recorded, "brief", "left")
    agrees = F.when(F.col("winner").isNotNull() & F.col("recorded").isNotNull(), F.col("winner") == F.col("recorded"))
    why = F.when(agrees == F.lit(False), F.concat(F.lit("Numeric "), "decided_by", F.lit(" result selects "), "winner",
                                                  F.lit("; hand record selects "), "recorded"))
    return j.select("brief", "winner", "recorded", agrees.alias("agrees"), why.alias("disagreement"))


def reading_agreement(parsed: DataFrame, transcribed: DataFrame, on: list[str]) -> DataFrame:
    """Parsed output against transcription; the parsed value is the one that counts."""
    j = parsed.join(transcribed.withColumnRenamed("value", "transcribed"), on, "left")
    return j.select(*on, "value", "transcribed", F.col("value").eqNullSafe(F.col("transcribed")).alias("agrees"))


def ledger_source_refs(ledger: DataFrame, briefs: DataFrame, scene: str = "scene", engine: str | None = None) -> DataFrame:
    """Ledger rows whose scene begins with the brief's name, optionally on one engine."""
    rows = ledger if engine is None else ledger.where(F.col("engine") == engine)
    return rows.withColumn("brief", F.element_at(F.split(scene, "-"), 1)).join(briefs.select("brief").distinct(), "brief")


def batch_costs(records: DataFrame, scope: list[str], batch: str, amount: str) -> DataFrame:
    """Cost of each batch once, at its own scope; it is never divided among the items that name it."""
    once = records.where(F.col(amount).isNotNull()).groupBy(*scope, batch).agg(F.max(amount).alias(amount), F.count(F.lit(1)).alias("records"))
    return once.groupBy(*scope).agg(F.count(F.lit(1)).alias("batches"), F.sum(amount).alias("amount"), F.sum("records").alias("records"))
