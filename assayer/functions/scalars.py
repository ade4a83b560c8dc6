"""Small date, money, JSON and array helpers as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_iso(ts: Column) -> Column:
    """Day of an ISO string; NULL when it holds less than a date."""
    return F.when(F.length(ts) >= 10, F.try_to_date(F.substring(ts, 1, 10)))


def ts_precision(ts: Column) -> Column:
    """none, date or time: what two rows can be compared by."""
    n = F.length(ts)
    return F.when(ts.isNull() | (n < 10), "none").when(n == 10, "date").otherwise("time")


def cents(usd: Column) -> Column:
    """Whole cents, half to even, from a decimal reading of the dollars."""
    return F.bround(usd.cast("decimal(20,4)") * 100, 0).cast("bigint")


def scaled_round(x: Column, places: int) -> Column:
    """Half away from zero of x * 10^places as a double, over 10^places; ``F.round`` looks at the shortest decimal of x instead."""
    scale = float(10 ** places)
    size = F.abs(x) * scale
    whole = F.floor(size)
    return F.when(F.isnan(x) | (size >= 2.0 ** 53), x).otherwise(F.signum(x) * (whole + F.when(size - whole >= 0.5, 1).otherwise(0)) / scale)


def relative_tolerance(label: Column, k: float, floor: float = 0.05) -> Column:
    return F.greatest(F.lit(floor), F.lit(k) * F.abs(label))


def choose2(k: Column) -> Column:
    return F.floor(k * (k - 1) / 2).cast("bigint")


def rate_per(count: Column, units: Column, per: int = 10) -> Column:
    """Violations per ``per`` units."""
    return F.lit(per) * count / units


def canonical_hash(*cols: str) -> Column:
    """SHA-256 of the columns as JSON with sorted keys."""
    return F.sha2(F.to_json(F.struct(*sorted(cols))), 256)


def fingerprint(c: Column) -> Column:
    """``sha256:`` and the first 12 hex digits; empty and NULL stay as they are."""
    return F.when(c.isNull() | (c == ""), c).otherwise(F.concat(F.lit("sha256:"), F.substring(F.sha2(c, 256), 1, 12)))


def clip_of_url(url: Column) -> Column:
    """Last path element without its four-character suffix."""
    name = F.element_at(F.split(url, "/"), -1)
    return F.substring(name, F.lit(1), F.length(name) - 4)


def engine_of_clip(clip: Column) -> Column:
    """Second-last ``-`` token."""
    parts = F.split(clip, "-")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2))


def is_unique(items: Column) -> Column:
    return F.size(F.array_distinct(items)) == F.size(items)


def same_members(a: Column, b: Column) -> Column:
    return F.sort_array(a) == F.sort_array(b)


def in_given_order(items: Column, order: Column) -> Column:
    """Whether the members of ``items`` that ``order`` names come in that order."""
    return F.filter(items, lambda x: F.array_contains(order, x)) == order


def overlay(base: Column, over: Column) -> Column:
    """Map merge: entries of ``over`` win."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k)), over)
