"""Does dropping the judge's lowest render beat shipping at random?"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.operators import votes as V


def scored_items(votes: DataFrame, calls: DataFrame, judge: str, group: str = "brief") -> DataFrame:
    """Items with a human value and a judge total. Filters and columns reach both scans."""
    ok, _ = V.valid_calls(calls.where(F.col("judge") == judge))
    totals = V.item_total(ok, [group, "item"])
    rates = V.pair_rates(V.both_directions(votes, [group]), [group])
    return V.values_with_totals(V.human_value(rates, [group], min_items=1), totals, [group, "item"])


def gate_evaluation(votes: DataFrame, calls: DataFrame, judge: str, group: str = "brief") -> DataFrame:
    """Macro-averaged policy lines: coin, gate, pick and oracle, and the share of the gap each closes."""
    return V.policy_summary(V.policy_lines(scored_items(votes, calls, judge, group), [group]))
