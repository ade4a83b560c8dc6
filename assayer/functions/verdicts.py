"""Threshold rules as column expressions.

A missing or NaN reading is a third outcome. It never becomes a pass or a fail.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SYNC_PASS_CORR, SYNC_PASS_LAG, SYNC_FAIL_CORR = 0.25, 0.20, 0.10
JAW_MAX, FACE_COVERAGE_MIN = 0.17, 0.70
LOUDNESS_TARGET, LOUDNESS_TOLERANCE, TRUE_PEAK_MAX = -16.0, 1.0, -1.5
LAG_FRAMES_MIN, LAG_FRAMES_MAX = -4, 2
LEVEL_DIM, LEVEL_BRIGHT = 70, 120
DRIFT_MAX = 0.15
FIRST_CHANGE_MAX = 1.75
PRESENCE_MIN, TIMING_MAX = 0.35, 0.011
CAST_MIN, STRANGER_FRAMES = 0.30, 2
LAG_FIX = 0.12
MAX_SCENE_REROLLS, MAX_BUILDS, MAX_EYE_REJECTS, MAX_WITHDRAWALS = 1, 3, 1, 3
JUDGMENT_ROWS = ("hook", "realism", "absurdity", "logic")
SCORE_TOP, SCORE_PASS = 3, 2
STOP = "ledger"


def read(c: Column) -> Column:
    """A number that was measured: not NULL and not NaN."""
    return c.isNotNull() & ~F.isnan(c.cast("double"))


def sync_verdict(corr: Column, lag: Column) -> Column:
    return (F.when(~read(corr) | ~read(lag), "UNMEASURED")
            .when((corr >= SYNC_PASS_CORR) & (F.abs(lag) <= SYNC_PASS_LAG), "PASS")
            .when(corr < SYNC_FAIL_CORR, "FAIL").otherwise("REVIEW"))


def covered_verdict(value: Column, coverage: Column, ceiling: float = JAW_MAX) -> Column:
    """A ceiling that counts only when enough of the span was seen."""
    return (F.when(~read(value) | ~read(coverage) | (coverage < FACE_COVERAGE_MIN), "UNMEASURED")
            .when(value <= ceiling, "PASS").otherwise("FAIL"))


def loudness_verdict(integrated: Column, true_peak: Column) -> Column:
    return (F.when(~read(integrated) | ~read(true_peak), "UNREADABLE")
            .when((F.abs(integrated - LOUDNESS_TARGET) <= LOUDNESS_TOLERANCE) & (true_peak < TRUE_PEAK_MAX), "PASS")
            .otherwise("FAIL"))


def lag_band(frames: Column) -> Column:
    return F.when(~read(frames), "UNMEASURED").when(frames.between(LAG_FRAMES_MIN, LAG_FRAMES_MAX), "PASS").otherwise("FAIL")


def level_class(level: Column) -> Column:
    return F.when(read(level), F.when(level < LEVEL_DIM, "dim").when(level <= LEVEL_BRIGHT, "mid").otherwise("bright"))


def deviation_class(deviation: Column) -> Column:
    return F.when(read(deviation), F.when(deviation > DRIFT_MAX, "DRIFTED").when(deviation < DRIFT_MAX / 2, "consensus").otherwise("near"))


def late_start(seconds: Column) -> Column:
    """True only for a measured first change past the limit; an unmeasured one never flags."""
    return F.coalesce(read(seconds) & (seconds > FIRST_CHANGE_MAX), F.lit(False))


def combine_verdicts(first: Column, second: Column) -> Column:
    """FAIL when an axis fails, REVIEW when one is split, UNREAD when one was not read or not asked, else PASS."""
    def one(state: str) -> Column:
        return F.coalesce(first == state, F.lit(False)) | F.coalesce(second == state, F.lit(False))
    return (F.when(one("fail"), "FAIL").when(one("split"), "REVIEW")
            .when(first.isNull() | second.isNull() | (second == "-"), "UNREAD").otherwise("PASS"))


def quadrant(presence: Column, per_event: Column) -> Column:
    present, in_step = presence >= PRESENCE_MIN, per_event <= TIMING_MAX
    return F.when(read(presence) & read(per_event),
                  F.when(present & in_step, "present, in step").when(present, "present, late")
                  .when(in_step, "absent, in step").otherwise("absent, late"))


def waivable(verdict: Column, sim: Column, floor: Column, strangers: Column, other: Column, second_read: Column) -> Column:
    """A failed reading a person may waive: strangers alone, with the main item over its floor."""
    over = read(sim) & (sim >= floor) & (F.abs(sim) != float("inf"))
    beside = F.when(second_read, read(other) & (F.abs(other) != float("inf")) & (other < sim)).otherwise(other.isNull())
    return F.coalesce((verdict == "FAIL") & (strangers > 0) & over & beside, F.lit(False))


def tally(fails: Column, oks: Column, votes: Column) -> Column:
    """Strict: a fail needs every vote, ok a majority without any fail; NULL is no reading."""
    return (F.when((fails == votes) & (votes > 0), "fail").when(fails > 0, "split").when(oks > F.floor(votes / 2), "ok"))


def lenient_tally(fails: Column, oks: Column, votes: Column) -> Column:
    """A majority of fails with nobody against it is enough."""
    half = F.floor(votes / 2)
    return F.when((fails > half) & (oks == 0), "fail").when(fails > 0, "split").when(oks > half, "ok")


def label_agreement(label: Column, verdict: Column, axis_state: Column, t: Column, lo: Column, hi: Column) -> Column:
    """agree, deferred (a look on a good item) or miss."""
    inside = read(t) & (t >= F.coalesce(lo, F.lit(0.0))) & (hi.isNull() | (t <= hi))
    hit = F.coalesce((verdict == "FAIL") & (axis_state == "fail") & inside, F.lit(False))
    on_pass = F.when(verdict == "PASS", "agree").when(verdict == "REVIEW", "deferred").otherwise("miss")
    return F.when(label == "PASS", on_pass).when(hit, "agree").otherwise("miss")


def unmet_rows(scores: Column, scored_by: Column) -> Column:
    """Judgment rows still unmet as MAP<row, reason>; ``scores`` is MAP<STRING, INT>."""
    def reason(row: str) -> Column:
        v = scores[row]
        return (F.when(~F.map_contains_key(scores, row), "missing")
                .when(v.isNull() | ~v.between(0, SCORE_TOP), f"not a whole number from 0 to {SCORE_TOP}")
                .when(v < SCORE_PASS, f"under {SCORE_PASS}"))
    nobody = F.when(F.coalesce(F.trim(scored_by), F.lit("")) == "", "missing")
    pairs = [F.struct(F.lit(r).alias("k"), reason(r).alias("v")) for r in JUDGMENT_ROWS]
    pairs.append(F.struct(F.lit("scored_by").alias("k"), nobody.alias("v")))
    return F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull()))


def next_step(step: Column, v: Column) -> Column:
    """Where a step's verdict sends a run. ``v`` is a struct of nullable facts (see ``NEXT_STEP_FACTS``)."""
    def yes(name: str) -> Column:
        return F.coalesce(v[name], F.lit(False))

    def is_(name: str, *values: str) -> Column:
        return F.coalesce(v[name].isin(*values), F.lit(False))

    used = F.coalesce(v["attempts"], F.lit(0))
    render = (F.when(yes("dry") | yes("unconfirmed") | yes("over_budget"), STOP)
              .when(~yes("failed"), "closer").when(used <= MAX_SCENE_REROLLS, "render").otherwise(STOP))
    unread = yes("unreadable") | is_("caption", "unreadable") | is_("drift", "unreadable") | is_("mouth", "unreadable")
    gates = (F.when(unread | is_("caption", "fail") | is_("drift", "fail") | is_("mouth", "fail", "noface"), STOP)
             .when(is_("mouth", "review") | (F.abs(F.coalesce(v["lag_s"], F.lit(0.0))) >= LAG_FIX) | yes("unseen_flags"), "eye")
             .otherwise("ship_gate"))
    eye = (F.when(yes("pass"), "ship_gate")
           .when(is_("cause", "scene", "closer") & (used < MAX_EYE_REJECTS + 1), F.when(v["cause"] == "scene", "render").otherwise("closer"))
           .when(is_("cause", "lag") & (used < MAX_BUILDS), "build").otherwise(STOP))
    ship = (F.when(yes("pass"), "deliver").when(is_("cause", "directional", "replay") & ~yes("override"), "eye").otherwise(STOP))
    review = F.when(~yes("pass") & (used < MAX_WITHDRAWALS + 1) & is_("back_to", "render", "closer", "build"), v["back_to"]).otherwise(STOP)
    return (F.when(step == "board", F.when(yes("pass"), "render").otherwise(STOP))
            .when(step == "render", render)
            .when(step == "closer", F.when(yes("pass"), "build").otherwise(STOP))
            .when(step == "build", F.when(yes("pass"), "ad_gates").otherwise(STOP))
            .when(step == "ad_gates", gates).when(step == "eye", eye).when(step == "ship_gate", ship)
            .when(step == "deliver", "review").when(step == "review", review))


NEXT_STEP_FACTS = ("pass BOOLEAN, dry BOOLEAN, unconfirmed BOOLEAN, over_budget BOOLEAN, failed BOOLEAN, attempts BIGINT, unreadable BOOLEAN, "
                   "caption STRING, drift STRING, mouth STRING, lag_s DOUBLE, unseen_flags BOOLEAN, cause STRING, override BOOLEAN, back_to STRING")


def run_outcome(last: Column, dry: Column, refused: Column, review: Column) -> Column:
    """One line on how a run ended, from its last step and verdicts."""
    return (F.when(dry & refused.isNotNull(), F.concat(F.lit("dry: refused before any spend, "), refused))
            .when(dry, "dry: stopped before the first spend")
            .when((last == "review") & (review == "keep"), "delivered")
            .when((last == "review") & (review == "withdraw"), "withdrawn, with no withdrawal left to fix it")
            .otherwise(F.concat(F.lit("stopped at "), last)))
