"""Diagnostics of sampled series: lags, repeats, runs, onsets, peaks, drift and windows.

Series are long: (id, pos, v) with ``pos`` 0, 1, 2, ... dense per id. Fixed frames run over chunks of positions with a
halo, sweeps over lags are equi-joins or frames exploded in place, so one long series spreads over the cluster.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.bars import chunks_by_count
from assayer.operators.ordered import CHUNK_ROWS, SPAN_CHUNKS, chunk_of, drop_halo, halo_window, scan_in_order, with_halo
from assayer.operators.quantiles import percentiles
from assayer.operators.spacing import spaced
from assayer.session import settle


def c(name: str) -> Column:
    return F.col(name)


def measured(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v.cast("double"))


def lag_pairs(df: DataFrame, key: str, pos: str, v: str, lag: int) -> DataFrame:
    """(key, pos, v, later): each sample beside the one ``lag`` positions later."""
    later = df.select(key, (c(pos) - lag).alias(pos), c(v).alias("later"))
    return df.select(key, pos, v).join(later, [key, pos])


def runs(df: DataFrame, key: str, pos: str, mask: Column, min_len: int = 1) -> DataFrame:
    """(key, start, length) of maximal stretches of consecutive positions where ``mask`` holds.

    Inside a stretch position minus rank is constant, so a stretch is a group.
    """
    on = df.where(mask).select(key, pos)
    ranked = scan_in_order(on, [key], [pos], chunk_of(pos), row_number="__rn")
    g = ranked.groupBy(key, (c(pos) - c("__rn")).alias("__g")).agg(F.min(pos).alias("start"), F.count(F.lit(1)).alias("length"))
    return g.where(c("length") >= min_len).select(key, "start", "length")


def rest_fraction(df: DataFrame, key: str, pos: str, v: str, min_len: int, level: float = 0.38, floor: float = 0.10) -> DataFrame:
    """Share of samples in stretches below ``level`` times the 75th percentile; FLAG under ``floor``."""
    p = percentiles(df, [key], v, {"p75": 0.75})
    low = runs(df.join(p.select(key, "p75"), key), key, pos, c(v) < c("p75") * level, min_len)
    rested = low.groupBy(key).agg(F.sum("length").alias("rest"), F.count(F.lit(1)).alias("rest_runs"))
    out = p.join(rested, key, "left").na.fill(0, ["rest", "rest_runs"]).withColumn("rest_fraction", c("rest") / c("n"))
    return out.select(key, "n", "rest", "rest_runs", "rest_fraction", F.when(c("rest_fraction") < floor, "FLAG").otherwise("PASS").alias("verdict"))


def merge_events(hits: DataFrame, keys: list[str], t: str, gap: float, min_hits: int = 3) -> DataFrame:
    """Hits of a key closer than ``gap`` to their predecessor are one event; events need ``min_hits`` hits."""
    parted = chunks_by_count(hits.select(*keys, t), keys, t)
    prev = scan_in_order(parted, keys, [t], c("__part"), lag={"__prev": c(t)})
    starts = c("__prev").isNull() | (c(t) - c("__prev") >= gap)
    numbered = scan_in_order(prev, keys, [t], c("__part"), sums={"__event": starts.cast("bigint")})
    g = numbered.groupBy(*keys, "__event").agg(F.min(t).alias("first"), F.max(t).alias("last"), F.count(F.lit(1)).alias("hits"))
    return g.where(c("hits") >= min_hits).drop("__event")


def differences(df: DataFrame, key: str, pos: str, v: str) -> DataFrame:
    """Adds ``diff``: absolute change against the previous sample, NULL on the first."""
    w = halo_window([key], pos)
    d = with_halo(df, pos, 1, 0).withColumn("diff", F.abs(c(v) - F.lag(v).over(w)))
    return drop_halo(d)


def first_diff_energy(df: DataFrame, key: str, pos: str, v: str) -> DataFrame:
    return differences(df, key, pos, v).groupBy(key).agg(F.avg("diff").alias("energy"), F.max("diff").alias("largest"))


def centred_energy(df: DataFrame, key: str, pos: str, v: str, half: int = 6) -> DataFrame:
    """Adds ``energy``: what exceeds the series median, summed over ``half`` samples each side (cut at the ends)."""
    med = percentiles(df, [key], v, {"med": 0.5}).select(key, "med")
    d = df.join(med, key).withColumn("__x", F.greatest(c(v) - c("med"), F.lit(0.0)))
    w = halo_window([key], pos).rowsBetween(-half, half)
    return drop_halo(with_halo(d, pos, half, half).withColumn("energy", F.sum("__x").over(w))).drop("__x", "med")


def worst_window(df: DataFrame, key: str, pos: str, v: str, width: int) -> DataFrame:
    """Largest mean over ``width`` consecutive samples; only full windows count."""
    w = halo_window([key], pos).rowsBetween(0, width - 1)
    d = drop_halo(with_halo(df, pos, 0, width).withColumn("__m", F.avg(v).over(w)).withColumn("__n", F.count(v).over(w)))
    return d.where(c("__n") == width).groupBy(key).agg(F.max("__m").alias("worst"))


def onset_candidates(df: DataFrame, key: str, pos: str, v: str, loud: float, quiet: float, before: int = 4) -> DataFrame:
    """Samples above ``loud`` whose ``before`` predecessors average below ``quiet``."""
    w = halo_window([key], pos).rowsBetween(-before, -1)
    d = with_halo(df, pos, before, 0).withColumn("__q", F.avg(v).over(w)).withColumn("__n", F.count(v).over(w))
    return drop_halo(d).where((c(v) > loud) & (c("__n") == before) & (c("__q") < quiet)).select(key, pos)


def onsets(df: DataFrame, key: str, pos: str, v: str, loud: float, quiet: float, min_gap: int, before: int = 4) -> DataFrame:
    """Onsets more than ``min_gap`` samples apart, kept left to right."""
    return spaced(onset_candidates(df, key, pos, v, loud, quiet, before), key, pos, min_gap + 1, chunk_of(pos))


def around(events: DataFrame, df: DataFrame, key: str, pos: str, v: str, first: int, last: int) -> DataFrame:
    """Samples at offsets ``first``..``last`` of each event as (key, event, offset, v); an equi-join on position."""
    e = events.select(key, c(pos).alias("event"), F.explode(F.sequence(F.lit(first), F.lit(last))).alias("offset")).withColumn(pos, c("event") + c("offset"))
    return e.join(df.select(key, pos, v), [key, pos]).select(key, "event", "offset", v)


def onset_response(events: DataFrame, answer: DataFrame, key: str, pos: str, v: str, hz: float = 20.0, rise: float = 1.6, within: float = 0.8) -> DataFrame:
    """Per onset the lag until ``answer`` exceeds its own baseline (the mean from 0.5 s to 0.1 s before), NULL for none."""
    b0, b1, start, end = -int(0.5 * hz), -int(0.1 * hz) - 1, -2, int(within * hz) - 1
    d = around(events, answer, key, pos, v, b0, end)
    o = c("offset")
    g = d.groupBy(key, "event").agg(
        F.coalesce(F.avg(F.when(o.between(b0, b1), c(v))), F.avg(F.when(o.between(-2, -1), c(v)))).alias("base"),
        F.collect_list(F.when(o >= start, F.struct(o.alias("o"), c(v).alias("v")))).alias("after"))
    hits = F.transform(F.filter("after", lambda x: x["v"] > c("base") * rise + 1e-4), lambda x: x["o"])
    return g.select(key, "event", "base", (F.array_min(hits) / F.lit(hz)).alias("lag_s"))


def onset_verdict(responses: DataFrame, key: str, miss_fail: float = 0.30, lag_fail: float = 0.35, miss_review: float = 0.10, lag_review: float = 0.20) -> DataFrame:
    """Miss rate and median lag per series, with the verdict."""
    g = responses.groupBy(key).agg(F.count(F.lit(1)).alias("onsets"), F.sum(c("lag_s").isNull().cast("bigint")).alias("misses"))
    med = percentiles(responses, [key], "lag_s", {"median_lag": 0.5}).select(key, "median_lag")
    j = g.join(med, key, "left").withColumn("__lag", F.coalesce("median_lag", F.lit(9.9))).withColumn("__miss", c("misses") / c("onsets"))
    return j.select(key, "onsets", "misses", "median_lag", F.when((c("__miss") >= miss_fail) | (c("__lag") > lag_fail), "FAIL")
                    .when((c("__miss") >= miss_review) | (c("__lag") > lag_review), "REVIEW").otherwise("PASS").alias("verdict"))


def peak_candidates(df: DataFrame, key: str, pos: str, v: str, pct: float = 0.65) -> DataFrame:
    """Interior samples at or above the ``pct`` percentile and both neighbours."""
    p = percentiles(df, [key], v, {"thr": pct}).select(key, "thr")
    w = halo_window([key], pos)
    d = with_halo(df, pos, 1, 1).withColumn("__a", F.lag(v).over(w)).withColumn("__b", F.lead(v).over(w))
    return drop_halo(d).join(p, key).where((c(v) >= c("thr")) & (c(v) >= c("__a")) & (c(v) >= c("__b"))).select(key, pos)


def peaks(df: DataFrame, key: str, pos: str, v: str, min_sep: int, pct: float = 0.65) -> DataFrame:
    return spaced(peak_candidates(df, key, pos, v, pct), key, pos, min_sep, chunk_of(pos))


def dedupe_nodes(events: DataFrame, key: str, t: str, gap: float, chunk: Column) -> DataFrame:
    """Events closer than ``gap`` to the last one kept are dropped."""
    return spaced(events, key, t, gap, chunk)


def phase_walk(events: DataFrame, motion: DataFrame, key: str, pos: str, v: str, fps: float, window: tuple[float, float] = (-0.80, 0.35),
               late: float = 0.08, pct: float = 0.60) -> DataFrame:
    """Per event: the first articulated onset of motion in its window, its phase and class.

    Articulated: above the series' ``pct`` percentile after a quieter 0.2 s. Without one the event is ``continuous``
    when the window's mean is above the level and ``still`` otherwise.
    """
    back = max(1, int(0.2 * fps))
    level = percentiles(motion, [key], v, {"level": pct}).select(key, "level")
    w = halo_window([key], pos).rowsBetween(-back, -1)
    m = drop_halo(with_halo(motion.join(level, key), pos, back, 0).withColumn("__pre", F.avg(v).over(w)))
    m = m.withColumn("__on", (c(v) > c("level")) & (c("__pre") < c("level")))
    lo, hi = -int(-window[0] * fps + 1e-9), int(window[1] * fps + 1e-9)
    e = events.select(key, c(pos).alias("event"), F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("offset")).withColumn(pos, c("event") + c("offset"))
    g = e.join(m, [key, pos]).groupBy(key, "event").agg(F.min(F.when(c("__on"), c("offset"))).alias("__o"), F.avg(v).alias("__m"), F.max("level").alias("__l"))
    phase = c("__o") / F.lit(fps)
    kind = (F.when(phase > late, "late").when(phase > -0.03, "sync").when(phase.isNotNull(), "lead")
            .when(c("__m") > c("__l"), "continuous").otherwise("still"))
    return g.select(key, "event", phase.alias("phase_s"), kind.alias("kind"))


def phase_summary(walk: DataFrame, key: str) -> DataFrame:
    kinds = ("lead", "sync", "late", "continuous", "still")
    return walk.groupBy(key).agg(F.count(F.lit(1)).alias("events"), *[F.sum((c("kind") == k).cast("bigint")).alias(k) for k in kinds],
                                 F.coalesce(F.sum(F.when(c("kind") == "late", c("phase_s"))), F.lit(0.0)).alias("phase_debt"), F.avg("phase_s").alias("mean_phase"))


def lock_share(bursts: DataFrame, events: DataFrame, key: str, pos: str, reach: int) -> DataFrame:
    """Share of bursts with an event at most ``reach`` samples away."""
    from assayer.operators.intervals import in_any_span
    spans = events.select(key, (c(pos) - reach).alias("lo"), (c(pos) + reach).alias("hi"))
    d = in_any_span(bursts.select(key, pos), spans, [key], pos, "lo", "hi", float(max(reach, 1)) * 4, "locked")
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("bursts"), F.sum(c("locked").cast("bigint")).alias("locked")).withColumn("lock", c("locked") / c("bursts"))


def lag_correlation(pairs: DataFrame, keys: list[str], pos: str, x: str, y: str, reach: int, min_overlap: int = 20, width: int = CHUNK_ROWS) -> DataFrame:
    """(keys, lag, r, n): Pearson r of x(i) with y(i + lag) for every lag up to ``reach`` either way.

    Each chunk holds its samples and a halo of ``reach``; a sample meets its 2 * reach + 1 partners inside the chunk and
    the products are added up before anything is shuffled, so the sweep multiplies arithmetic and not traffic. r does
    not depend on scaling, which makes a z-score unnecessary.
    """
    w = halo_window(keys, pos).rowsBetween(-reach, reach)
    d = with_halo(pairs.select(*keys, pos, x, y), pos, reach, reach, width)
    near = d.withColumn("__near", F.collect_list(F.struct(c(pos).alias("p"), c(y).alias("y"))).over(w)).where("__own")
    swept = near.select(*keys, c(pos).alias("__p"), c(x).alias("__x"), F.inline("__near"))
    swept = swept.withColumn("lag", (c("p") - c("__p")).cast("int")).where(F.abs("lag") <= reach)
    r = swept.groupBy(*keys, "lag").agg(F.corr("__x", "y").alias("r"), F.count(F.when(c("__x").isNotNull() & c("y").isNotNull(), 1)).alias("n"))
    return r.where(c("n") >= min_overlap)


def best_lag(curve: DataFrame, keys: list[str]) -> DataFrame:
    """Best correlation and lag per key (the smallest lag on a tie) and its sub-bin offset from a parabola, within half a bin."""
    live = curve.where(measured(c("r")))
    top = live.groupBy(*keys).agg(F.min(F.struct((-F.round("r", 9)).alias("neg"), "lag", "r")).alias("m")).select(*keys, c("m.lag").alias("lag"), c("m.r").alias("r"))
    side = live.select(*keys, c("lag").alias("__l"), c("r").alias("__r"))
    j = top.join(side, keys).groupBy(*keys, "lag", "r").agg(F.max(F.when(c("__l") == c("lag") - 1, c("__r"))).alias("a"), F.max(F.when(c("__l") == c("lag") + 1, c("__r"))).alias("b"))
    bend = c("a") - 2 * c("r") + c("b")
    off = F.when(bend < -1e-12, F.greatest(F.lit(-0.5), F.least(F.lit(0.5), 0.5 * (c("a") - c("b")) / bend))).otherwise(0.0)
    return j.select(*keys, "lag", "r", F.coalesce(off, F.lit(0.0)).alias("offset"))


def lag_by_thirds(pairs: DataFrame, key: str, pos: str, x: str, y: str, reach: int, min_overlap: int = 20) -> DataFrame:
    """The same measure on each third of a series: is it stable enough to be believed?"""
    size = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    third = F.least(F.floor(c(pos) * 3 / c("__n")), F.lit(2)).cast("int")
    return best_lag(lag_correlation(pairs.join(size, key).withColumn("third", third), [key, "third"], pos, x, y, reach, min_overlap), [key, "third"])


def _sizes(df: DataFrame, key: str, pos: str) -> DataFrame:
    return df.groupBy(key).agg((F.max(pos) + 1).alias("__n"))


def lag_differences(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (x[p] - y[p + d])^2 over the places that both hold, and how many these are, for d from 1 - len(x) to len(y) - 1.

    A squared difference is two squares and a product, so all lags come out of a few transforms. ``whole``: the values are
    whole numbers, and so are the sums.
    """
    n = len(x) + len(y) - 1
    size = 1 << (n - 1).bit_length()
    x, y = np.where(held_x, x, 0.0), np.where(held_y, y, 0.0)
    forward = lambda v: np.fft.rfft(v, size)
    fx = [forward(v[::-1]) for v in (held_x.astype(float), x, x * x)]
    fy = [forward(v) for v in (held_y.astype(float), y, y * y)]
    both = np.rint(np.fft.irfft(fx[0] * fy[0], size)[:n])
    total = np.fft.irfft(fx[2] * fy[0] + fx[0] * fy[2] - 2 * fx[1] * fy[1], size)[:n]
    return np.maximum(np.rint(total) if whole else total, 0.0), both


def _best_periods(df: DataFrame, key: str, pos: str, v: str, fps: int, min_period: int, max_period: int | None) -> DataFrame:
    """(key, msd, period): the period of least mean squared difference over every fifth sample, the smallest on a tie.

    Chunks of a series meet in pairs, and a pair's differences at all its lags come from one convolution: n log n for a series of
    a few chunks. Partial sums travel as arrays, one per pair and block of lags, and are added as they stream by.
    """
    d = df.select(c(key).alias("k"), c(pos).cast("bigint").alias("p"), c(v).cast("double").alias("v")).where("k IS NOT NULL AND p IS NOT NULL")
    sizes = settle(d.groupBy("k").agg((F.max("p") + 1).alias("n"), F.coalesce(F.round(F.avg("v")), F.lit(0.0)).alias("level")), "sizes")
    longest = sizes.agg(F.max("n")).first()[0] or 1
    width = min(max(1 << (-(-longest // 16) - 1).bit_length(), 1 << 13), 1 << 18)
    kind = d.schema["k"].dataType.simpleString()

    def top_of(n: int) -> int:
        top = min(-int(-(n / fps) // 1.5) - 1, n // fps - 1)
        return top if max_period is None else min(top, max_period)

    rows = d.join(sizes, "k").withColumn("chunk", F.floor(c("p") / width))
    packed = rows.groupBy("k", "n", "chunk").agg(F.sort_array(F.collect_list(F.struct("p", (c("v") - c("level")).alias("v")))).alias("m"))
    reach = F.greatest(F.ceil(c("n") / F.lit(width)) - 1, F.lit(0)) if max_period is None else F.floor((c("chunk") + 1) + F.lit(max_period * fps) / width)
    last = F.least(F.ceil(c("n") / F.lit(width)) - 1, reach).cast("bigint")
    packed = settle(packed.select("k", "n", "chunk", c("m.p").alias("p"), c("m.v").alias("v"), last.alias("last")), "chunks")
    left = packed.select("k", "n", c("chunk").alias("i"), F.explode(F.sequence("chunk", F.greatest("last", "chunk"))).alias("j"), F.lit(0).alias("side"), "p", "v")
    lowest = F.lit(0) if max_period is None else F.greatest(F.lit(0), c("chunk") - 1 - F.lit(max_period * fps // width))
    right = packed.select("k", "n", F.explode(F.sequence(lowest.cast("bigint"), "chunk")).alias("i"), c("chunk").alias("j"), F.lit(1).alias("side"), "p", "v")
    unit = ["k", "i", "j"]
    pairs = left.unionByName(right).repartition(*unit).sortWithinPartitions(*unit, "side").select("k", "n", "i", "j", "side", "p", "v")

    def dense(p: np.ndarray, x: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
        out, held = np.zeros(width), np.zeros(width, bool)
        good = ~np.isnan(x)
        out[p[good] - chunk * width], held[p[good] - chunk * width] = x[good], True
        return out, held

    def convolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for b in batches:
            for at in range(b.num_rows):
                k, n, i, j, side = (b.column(x)[at].as_py() for x in range(5))
                p, x = b.column(5)[at].values.to_numpy(), b.column(6)[at].values.to_numpy(zero_copy_only=False).astype(float)
                if not side:
                    first = (k, i, j), dense(p, x, i)
                    continue
                if first is None or first[0] != (k, i, j):
                    continue
                (a, held_a), (y, held_y) = first[1], dense(p, x, j)
                fifth = held_a & ((np.arange(width) + i * width) % 5 == 0)
                whole = bool((a == np.rint(a)).all() and (y == np.rint(y)).all() and max(np.abs(a).max(), np.abs(y).max()) ** 2 * width < 1 << 48)
                total, both = lag_differences(a, y, fifth, held_y, whole)
                total, both = np.append(0.0, total), np.append(0.0, both)  # from lag -width on
                for block, cut in ((j - i - 1, slice(0, width)), (j - i, slice(width, 2 * width))):
                    if block >= 0 and both[cut].any():
                        yield pa.RecordBatch.from_arrays([pa.array([k], b.schema.field(0).type), pa.array([n], pa.int64()), pa.array([block], pa.int64()),
                                                          pa.array([total[cut].tobytes()], pa.binary()), pa.array([both[cut].tobytes()], pa.binary())], ["k", "n", "block", "total", "both"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, both, like = None, None, None, None

        def told() -> Iterator[pa.RecordBatch]:
            k, n, block = now
            lag = np.arange(block * width, (block + 1) * width)
            period = lag // fps
            ok = (lag % fps == 0) & (period >= min_period) & (period <= top_of(n)) & (both > 0)
            if ok.any():
                msd = np.round(total[ok] / both[ok], 9)
                at = int(msd.argmin())
                yield pa.RecordBatch.from_arrays([pa.array([k], like), pa.array([float(msd[at])]), pa.array([int(period[ok][at])], pa.int64())], ["k", "msd", "period"])

        for b in batches:
            like = b.schema.field(0).type
            for *key_, t, m in zip(*(b.column(x).to_pylist() for x in range(5)), strict=True):
                t, m = np.frombuffer(t), np.frombuffer(m)
                if key_ == now:
                    total, both = total + t, both + m
                    continue
                if now is not None:
                    yield from told()
                now, total, both = key_, t, m
        if now is not None:
            yield from told()

    by = ["k", "n", "block"]
    sums = pairs.mapInArrow(convolved, f"k {kind}, n bigint, block bigint, total binary, both binary").repartition(*by).sortWithinPartitions(*by)
    found = sums.mapInArrow(best, f"k {kind}, msd double, period bigint")
    return found.groupBy(c("k").alias(key)).agg(F.min(F.struct("msd", "period")).alias("m"))


def repeat_scan(df: DataFrame, key: str, pos: str, v: str, fps: int = 1, min_period: int = 5, max_period: int | None = None,
                floor: float = 5.0, reject: float = 0.40) -> DataFrame:
    """Does a series come round again? Mean squared difference at each period against that of unrelated samples.

    Every fifth sample is compared at every period, by convolutions. UNJUDGEABLE when unrelated samples hardly differ: a still
    series shows nothing either way. A NULL or missing sample is compared with none.
    """
    base = df.join(_sizes(df, key, pos), key)
    other = df.select(key, c(pos).alias("__q"), c(v).alias("__w"))
    far = (base.where(c(pos) % 11 == 0).withColumn("__q", (c(pos) + F.floor(c("__n") / 3)) % c("__n")).join(other, [key, "__q"])
           .groupBy(key).agg(F.avg((c(v) - c("__w")) * (c(v) - c("__w"))).alias("far")))
    best = _best_periods(df, key, pos, v, fps, min_period, max_period)
    j = far.join(best, key, "left").withColumn("share", c("m.msd") / F.greatest(c("far"), F.lit(1e-9)))
    judged = c("far") >= floor
    return j.select(key, "far", F.when(judged, c("share")).alias("share"), F.when(judged, c("m.period")).alias("period"),
                    F.when(~judged, "UNJUDGEABLE").when(c("share") < reject, "REPLAYS").otherwise("FORWARD").alias("verdict"))


def mirror_scan(df: DataFrame, key: str, pos: str, v: str, lags: tuple[int, ...], edge: int, reject: float = 0.22) -> DataFrame:
    """Is a series mirrored about some sample? Mean squared difference of v(c - L) and v(c + L) over several lags,
    against the median of the same measure at five fixed places."""
    w = halo_window([key], pos)
    d = with_halo(df.select(key, pos, v), pos, max(lags), max(lags))
    sq = [F.lag(v, lag).over(w) - F.lead(v, lag).over(w) for lag in lags]
    d = drop_halo(d.select(key, pos, "__chunk", "__own", *[(s * s).alias(f"__l{i}") for i, s in enumerate(sq)])).join(_sizes(df, key, pos), key)
    cols = [c(f"__l{i}") for i in range(len(lags))]
    total = sum(cols[1:], cols[0])
    best = (d.where((c(pos) >= edge) & (c(pos) < c("__n") - edge) & total.isNotNull()).groupBy(key)
            .agg(F.min(F.struct(F.round(total / len(lags), 9).alias("m"), c(pos).alias("centre"))).alias("b")))
    fixed = F.array(*[F.floor(c("__n") * F.lit(f)).cast("bigint") for f in (0.15, 0.3, 0.5, 0.7, 0.85)])
    control = (d.where(F.array_contains(fixed, c(pos))).select(key, F.explode(F.array_compact(F.array(*cols))).alias("x"))
               .groupBy(key).agg(F.percentile("x", 0.5).alias("control")))  # at most 5 x len(lags) values per key
    j = control.join(best, key).withColumn("share", c("b.m") / F.greatest(c("control"), F.lit(1e-9)))
    return j.select(key, "control", "share", c("b.centre").alias("centre"), F.when(c("share") < reject, "REPLAYS").otherwise("FORWARD").alias("verdict"))


def half_period_multiple(vertex: Column, period: Column, within: float = 2.0) -> Column:
    """Which multiple of half the period a mirror point sits on, NULL when it sits on none."""
    half = period / 2.0
    k = F.bround(vertex / half)
    return F.when((half > 0) & (k != 0) & (F.abs(vertex - k * half) < within), k.cast("int"))


def segment_ratio(df: DataFrame, key: str, pos: str, v: str, tail: int = 15) -> DataFrame:
    """Mean change of the last ``tail`` steps over that of the middle 60 %, and the jump from the last to the first sample."""
    d = differences(df, key, pos, v).join(_sizes(df, key, pos), key)
    steps, j = c("__n") - 1, c(pos) - 1
    mid = (j >= F.floor(steps * 0.2)) & (j < F.floor(steps * 0.8))
    g = d.groupBy(key).agg(F.avg(F.when((j >= steps - tail) & (j >= 0), c("diff"))).alias("__t"), F.avg(F.when(mid & (j >= 0), c("diff"))).alias("__m"),
                           F.max(F.when(c(pos) == 0, c(v))).alias("__f"), F.max(F.when(c(pos) == steps, c(v))).alias("__z"))
    return g.select(key, (c("__t") / F.greatest(c("__m"), F.lit(1e-6))).alias("end_ratio"), F.abs(c("__z") - c("__f")).cast("double").alias("loop_jump"))


def drawdown(df: DataFrame, key: str, pos: str, v: str, early: int = 6) -> DataFrame:
    """FAIL on an early drop under 0.96 with no rise over 1.03 before it; REVIEW when a value falls 0.08 under a running
    peak over 1.06; INCONCLUSIVE with fewer than 5 points. ``df`` holds usable points only."""
    run = scan_in_order(df.select(key, pos, v), [key], [pos], chunk_of(pos), maxes={"__peak": c(v)})
    peak = F.greatest(c("__peak"), F.lit(1.0))
    g = run.groupBy(key).agg(
        F.count(F.lit(1)).alias("points"), F.min(F.when((c(pos) <= early) & (c(v) < 0.96), c(pos))).alias("drop"),
        F.min(F.when((c(pos) <= early) & (c(v) > 1.03), c(pos))).alias("rise"),
        F.min(F.when((peak > 1.06) & (c(v) < peak - 0.08), c(pos))).alias("ease"), (F.max(v) - F.min(v)).alias("swing"))
    fail = c("drop").isNotNull() & (c("rise").isNull() | (c("rise") > c("drop")))
    return g.select(key, "points", "swing", F.when(c("points") < 5, "INCONCLUSIVE").when(fail, "FAIL").when(c("ease").isNotNull(), "REVIEW").otherwise("PASS").alias("verdict"))


def resample_mean(df: DataFrame, key: str, t: str, v: str, hz: float) -> DataFrame:
    """Mean per bin of 1 / hz seconds."""
    return df.groupBy(key, F.floor(c(t) * hz).cast("bigint").alias("bin")).agg(F.avg(v).alias("v"), F.count(F.lit(1)).alias("samples"))


def resample_linear(df: DataFrame, key: str, t: str, v: str, hz: float) -> DataFrame:
    """Linear interpolation on the grid k / hz. Each pair of neighbouring samples emits the grid points between them."""
    parted = chunks_by_count(df.select(key, t, v), [key], t)
    seg = scan_in_order(parted, [key], [t], c("__part"), lead={"__t1": c(t), "__v1": c(v)}).where(c("__t1") > c(t))
    first, last = F.ceil(c(t) * hz).cast("bigint"), (F.ceil(c("__t1") * hz) - 1).cast("bigint")
    grid = seg.where(last >= first).withColumn("bin", F.explode(F.sequence(first, last)))
    part = (c("bin") / F.lit(hz) - c(t)) / (c("__t1") - c(t))
    return grid.select(key, "bin", (c(v) + (c("__v1") - c(v)) * part).alias("v"))


def span_energy(df: DataFrame, spans: DataFrame, key: str, t: str, v: str, lo: str, hi: str, grace: float, width: float, skip_before: float) -> DataFrame:
    """Mean of ``v`` in spans, in the gaps between them and after the last one (plus ``grace``), and post over speech."""
    from assayer.operators.intervals import in_any_span
    ends = spans.groupBy(key).agg(F.max(hi).alias("__end"))
    d = in_any_span(df.select(key, t, v), spans, [key], t, lo, hi, width, "__in").join(ends, key)
    post = c(t) > c("__end") + grace
    gap = ~c("__in") & ~post & (c(t) > skip_before)
    g = d.groupBy(key).agg(F.avg(F.when(c("__in"), c(v))).alias("speech"), F.avg(F.when(gap, c(v))).alias("gap"), F.avg(F.when(post, c(v))).alias("post"))
    z = [F.coalesce(x, F.lit(0.0)) for x in ("speech", "gap", "post")]
    return g.select(key, *[x.alias(n) for x, n in zip(z, ("speech", "gap", "post"), strict=True)], F.greatest(*z).alias("energy"), (z[2] / F.greatest(z[0], F.lit(0.01))).alias("ratio"))


def adjacent_gradient(values: Column, width: int | None = None) -> Column:
    """Mean absolute difference of neighbours in an array; with ``width`` the array is a grid and both directions are averaged."""
    x = F.transform(values, lambda e: e.cast("double"))
    n = F.size(values)

    def mean_abs(a: Column, b: Column) -> Column:
        d = F.zip_with(a, b, lambda p, q: F.abs(p - q))
        return F.aggregate(d, F.lit(0.0), lambda s, e: s + e) / F.size(d)

    across = mean_abs(F.slice(x, F.lit(1), n - 1), F.slice(x, F.lit(2), n - 1))
    if width is None:
        return across
    rows = F.transform(F.sequence(F.lit(0), F.floor(n / width) - 1), lambda r: F.slice(x, r * width + 1, F.lit(width)))
    h = F.flatten(F.transform(rows, lambda r: F.zip_with(F.slice(r, 1, width - 1), F.slice(r, 2, width - 1), lambda p, q: F.abs(p - q))))
    down = mean_abs(F.slice(x, F.lit(1), n - width), F.slice(x, F.lit(width + 1), n - width))
    return (F.aggregate(h, F.lit(0.0), lambda s, e: s + e) / F.size(h) + down) / 2


def band_ratio(df: DataFrame, by: list[str], band: Column, reference: Column, v: str) -> DataFrame:
    """Mean inside one band over the mean inside another, the divisor at least 1e-6."""
    g = df.groupBy(*by).agg(F.avg(F.when(band, c(v))).alias("__a"), F.avg(F.when(reference, c(v))).alias("__b"))
    return g.select(*by, (c("__a") / F.greatest(c("__b"), F.lit(1e-6))).alias("ratio"))


def over_limit(df: DataFrame, key: str, measure: str, t: str, v: str, limits: dict[str, float], scale: Column, has_background: Column) -> DataFrame:
    """Per measure the rows at or over its size-scaled limit: first time, worst value and time, count.

    ``state`` is NULL where there was no background to measure: no reading is not a still background.
    """
    limit = F.lit(None).cast("double")
    for m, x in limits.items():
        limit = F.when(c(measure) == m, F.lit(float(x))).otherwise(limit)
    over = has_background & (c(v) >= limit * scale)
    return df.groupBy(key, measure).agg(
        F.sum(F.coalesce(over, F.lit(False)).cast("bigint")).alias("rows_over"), F.min(F.when(over, c(t))).alias("first_t"),
        F.max(F.when(over, F.struct(c(v).alias("v"), (-c(t)).alias("nt")))).alias("__w"), F.max(has_background.cast("int")).alias("__bg"),
    ).select(key, measure, "rows_over", "first_t", c("__w.v").alias("worst"), (-c("__w.nt")).alias("worst_t"),
             F.when(c("__bg") == 1, F.when(c("rows_over") > 0, "fail").otherwise("ok")).alias("state"))


def spaced_top_k(df: DataFrame, key: str, pos: str, change: str, energy: str, k: int, half: int, spacing: int, min_energy: float, last_pos: int | None = None,
                 forced: DataFrame | None = None) -> DataFrame:
    """The ``k`` strongest local peaks at least ``spacing`` apart, taken by energy and returned in time order.

    A candidate stands for the largest change within ``half`` samples of it. A pick can rule out only the candidates
    whose peak lies within ``spacing`` of it, so the first k * (2 * (spacing + half) + 1) candidates decide everything. That exact
    rank limit is applied inside each chunk, where rows already lie, then inside spans of chunks, then to what is left of a
    series; only the first of these sees all rows. ``forced`` (key, pos) peaks come first.
    """
    from pyspark.sql import Window
    # Snap to the largest change nearby, the earliest on a tie.
    w = halo_window([key], pos).rowsBetween(-half, half)
    d = with_halo(df.select(key, pos, change, energy), pos, half, half)
    d = d.withColumn("__pk", F.max(F.struct(c(change).alias("ch"), (-c(pos)).alias("np"))).over(w))
    cand = d.where(c("__own") & (c(energy) >= min_energy)).select(key, "__chunk", (-F.round(energy, 9)).alias("neg"), c(pos).alias("at"), (-c("__pk.np")).alias("peak"))
    if last_pos is not None:
        cand = cand.where(c("peak") <= last_pos)
    limit = k * (2 * (spacing + half) + 1)

    def first(rows: DataFrame, by: list[str | Column]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("neg", "at"))
        return rows.withColumn("__rk", rank).where(c("__rk") <= limit).drop("__rk")

    few = first(first(first(cand, [key, "__chunk"]), [key, F.floor(c("__chunk") / SPAN_CHUNKS)]), [key])
    lists = few.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("neg", "at", "peak"))).alias("__c"))
    start = F.array().cast("array<bigint>")
    if forced is not None:
        f = forced.groupBy(key).agg(F.min(pos).alias("__f"))
        lists = lists.join(f, key, "full").withColumn("__c", F.coalesce("__c", F.array().cast("array<struct<neg:double,at:bigint,peak:bigint>>")))
        start = F.when(c("__f").isNotNull(), F.array(c("__f").cast("bigint"))).otherwise(start)

    def take(chosen: Column, x: Column) -> Column:
        free = (F.size(chosen) < k) & F.forall(chosen, lambda p: F.abs(p - x["peak"]) >= spacing)
        return F.when(free, F.concat(chosen, F.array(x["peak"].cast("bigint")))).otherwise(chosen)

    return lists.select(key, F.explode(F.array_sort(F.aggregate("__c", start, take))).alias(pos))
