"""The skew-safe building blocks against brute force."""
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayer.operators import bars, intervals, ordered, quantiles, series, spacing


def table(spark, seed=1, n=400, keys=3):
    r = random.Random(seed)
    rows, at = [], {k: 0 for k in range(keys)}
    for _ in range(n):
        k = 0 if r.random() < 0.6 else r.randrange(keys)  # one key holds most rows
        at[k] += r.choice([1, 1, 1, 7, 40])
        rows.append((k, at[k], r.randrange(100), r.choice([None, 1, 2, 3])))
    return spark.createDataFrame(rows, "k INT, t BIGINT, v BIGINT, m INT"), pd.DataFrame(rows, columns=["k", "t", "v", "m"])


@pytest.mark.parametrize("width", [1, 5, 64, 100_000])
def test_scan_in_order_equals_a_plain_window(spark, width):
    df, pdf = table(spark)
    got = ordered.scan_in_order(df, ["k"], ["t"], ordered.chunk_of("t", width), row_number="rn", sums={"s": F.col("v")}, maxes={"hi": F.col("v")},
                                fill={"f": F.col("m")}, fill_before={"fb": F.col("m")}, lag={"a": F.col("v")}, lead={"z": F.col("v")}).toPandas().sort_values(["k", "t"])
    p = pdf.sort_values(["k", "t"])
    g = p.groupby("k")
    want = {"rn": g.cumcount() + 1, "s": g["v"].cumsum(), "hi": g["v"].cummax(), "f": g["m"].ffill(), "a": g["v"].shift(1), "z": g["v"].shift(-1)}
    want["fb"] = g["m"].ffill().groupby(p["k"]).shift(1)
    for name, w in want.items():
        a, b = got[name].astype(float).to_numpy(), w.astype(float).to_numpy()
        assert np.array_equal(a, b, equal_nan=True), name


def test_scan_in_order_keeps_rows_with_a_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 9000), ("a", 2)], "k STRING, t BIGINT")
    got = ordered.scan_in_order(df, ["k"], ["t"], ordered.chunk_of("t"), row_number="rn")
    assert sorted((r["k"] or "", r["rn"]) for r in got.collect()) == [("", 1), ("", 2), ("a", 1)]


def test_dense_index_numbers_every_value_once(spark):
    df = spark.range(1000).select((F.col("id") % 137).cast("string").alias("u"))
    assert sorted(r["idx"] for r in ordered.dense_index(df, "u").collect()) == list(range(137))


@pytest.mark.parametrize("gap,width,batch", [(3, 64, 7), (25, 128, 10_000), (90, 512, 11), (1, 32, 1)])
def test_greedy_spacing_equals_the_sequential_rule(spark, gap, width, batch):
    df, pdf = table(spark, seed=gap, n=600)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = sorted((r["k"], r["t"]) for r in spacing.spaced(df, "k", "t", gap, ordered.chunk_of("t", width)).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = []
    for k, g in pdf.groupby("k"):
        last = None
        for t in sorted(set(g["t"])):
            if last is None or t - last >= gap:
                want.append((k, t))
                last = t
    assert got == sorted(want)


def test_percentiles_equal_numpy(spark):
    r = np.random.default_rng(3)
    rows = [(int(k), float(x)) for k in range(4) for x in np.concatenate([r.normal(size=50 * k + 1), r.integers(0, 3, 40), [1e6]])]
    rows += [(0, float("nan")), (1, None)]
    df = spark.createDataFrame(rows, "k INT, v DOUBLE")
    for limit, steps in ((3, 1), (65_536, 8)):
        got = {x["k"]: x for x in quantiles.percentiles(df, ["k"], "v", {"p5": 0.05, "p50": 0.5, "p95": 0.95}, limit, steps).collect()}
        for k in range(4):
            v = [b for a, b in rows if a == k and b is not None and b == b]
            assert got[k]["n"] == len(v)
            assert np.allclose([got[k]["p5"], got[k]["p50"], got[k]["p95"]], np.percentile(v, [5, 50, 95]))


def test_percentiles_follow_ranks_with_outliers_infinities_and_constants(spark):
    r = np.random.default_rng(8)
    cases = {"outlier": [*r.random(3000), 1e12], "infinite": [float("-inf"), *r.random(400), float("inf"), float("inf")], "constant": [2.5] * 70, "one": [7.0]}
    df = spark.createDataFrame([(k, float(x)) for k, v in cases.items() for x in v], "k STRING, v DOUBLE")
    for limit, steps in ((1, 2), (1, 8), (65_536, 8)):
        got = {x["k"]: x for x in quantiles.percentiles(df, ["k"], "v", {"p5": 0.05, "p50": 0.5}, limit, steps).collect()}
        for k, v in cases.items():
            assert got[k]["n"] == len(v)
            assert np.allclose([got[k]["p5"], got[k]["p50"]], np.percentile(v, [5, 50])), k


def test_bars_hold_equal_shares_despite_an_outlier(spark):
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.when(F.col("id") == 0, 1e12).otherwise(F.rand(3)).alias("v"))
    df = spark.createDataFrame(df.toPandas())
    sizes = [r["count"] for r in bars.in_bars(df.join(bars.borders(df, ["k"], "v", 4), "k"), "v", "bar", 4).groupBy("bar").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16


def test_chunks_follow_the_row_counts_of_one_crowded_day(spark):
    rows = [("hot", 1_700_000_000.0 + i / 100) for i in range(20_000)] + [("hot", float(d * 86_400)) for d in range(40)] + [("cold", 5.0), (None, 1.0), (None, None)]
    df = spark.createDataFrame(rows, "run STRING, t DOUBLE")
    parted = bars.chunks_by_count(df, ["run"], "t", rows=100, steps=4)
    sizes = {(r["run"], r["__part"]): r["count"] for r in parted.groupBy("run", "__part").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert sum(sizes.values()) == len(rows) and len(hot) > 150 and max(hot) < 4 * 20_040 / len(hot)
    spread = parted.where("run = 'hot'").groupBy("__part").agg(F.min("t").alias("a"), F.max("t").alias("b")).orderBy("__part").collect()
    assert all(x["b"] < y["a"] for x, y in zip(spread, spread[1:], strict=False))
    got = ordered.scan_in_order(parted, ["run"], ["t"], F.col("__part"), row_number="rn", lag={"p": F.col("t")}, lead={"n": F.col("t")})
    hot = got.where("run = 'hot'").orderBy("rn").collect()
    times = sorted(t for k, t in rows if k == "hot")
    assert [r["t"] for r in hot] == times and [r["rn"] for r in hot] == list(range(1, len(times) + 1))
    assert [r["p"] for r in hot] == [None, *times[:-1]] and [r["n"] for r in hot] == [*times[1:], None]


def test_percentiles_of_everything_and_lower_median(spark):
    df = spark.createDataFrame([(float(x),) for x in (4, 1, 3, 2)], "v DOUBLE")
    assert quantiles.percentiles(df, [], "v", {"m": 0.5}).first()["m"] == 2.5
    assert quantiles.lower_median(df.withColumn("k", F.lit(1)), ["k"], "v").first()["median"] == 2.0


def dense_series(spark, values, name="s"):
    return spark.createDataFrame([(name, i, float(v)) for i, v in enumerate(values)], "series STRING, pos BIGINT, v DOUBLE")


def test_lag_correlation_equals_numpy_across_chunks(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=300)
    y = np.roll(x, 4) + 0.1 * r.normal(size=300)
    df = spark.createDataFrame([("s", i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "series STRING, pos BIGINT, x DOUBLE, y DOUBLE")
    curve = series.lag_correlation(df, ["series"], "pos", "x", "y", 6, width=32)
    got = {r["lag"]: r["r"] for r in curve.collect()}
    for lag in range(-6, 7):
        a, b = (x[:len(x) - lag], y[lag:]) if lag >= 0 else (x[-lag:], y[:lag])
        assert abs(got[lag] - np.corrcoef(a, b)[0, 1]) < 1e-9
    best = series.best_lag(curve, ["series"]).first()
    assert best["lag"] == 4 and -0.5 <= best["offset"] <= 0.5


def test_repeat_and_mirror(spark):
    saw = dense_series(spark, [10 * (i % 12) for i in range(120)])
    got = series.repeat_scan(saw, "series", "pos", "v").first()
    assert (got["period"], got["verdict"]) == (12, "REPLAYS")
    flat = series.repeat_scan(dense_series(spark, [3] * 120), "series", "pos", "v").first()
    assert (flat["verdict"], flat["share"]) == ("UNJUDGEABLE", None)
    r = np.random.default_rng(1)
    half = list(r.normal(size=61) * 10)
    mirrored = series.mirror_scan(dense_series(spark, half + half[-2::-1]), "series", "pos", "v", (10, 20, 30, 40), 50).first()
    assert mirrored["centre"] == 60 and mirrored["verdict"] == "REPLAYS"


def test_runs_and_drawdown(spark, rows):
    s = dense_series(spark, [0, 1, 1, 1, 0, 1, 0, 1, 1])
    assert rows(series.runs(s, "series", "pos", F.col("v") > 0, 2)) == [("s", 1, 3), ("s", 7, 2)]
    cases = {"early shrink": ([1, 0.99, 0.95, 1, 1], "FAIL"), "rise first": ([1, 1.04, 0.95, 1, 1], "PASS"), "ease back": ([1] * 7 + [1.1, 1.0], "REVIEW"), "few": ([1, 1], "INCONCLUSIVE")}
    for values, want in cases.values():
        assert series.drawdown(dense_series(spark, values), "series", "pos", "v").first()["verdict"] == want


def test_spaced_top_k_equals_the_sequential_rule(spark):
    r = np.random.default_rng(9)
    x = np.abs(r.normal(size=400)) * 20
    e = np.convolve(np.maximum(x - np.median(x), 0), np.ones(13), "same")
    df = spark.createDataFrame([("s", i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, e, strict=True))], "series STRING, pos BIGINT, change DOUBLE, energy DOUBLE")
    chosen = []
    for i in sorted(range(400), key=lambda k: (-round(e[k], 9), k)):
        if e[i] < 55 or len(chosen) == 4:
            break
        lo, hi = max(0, i - 6), min(400, i + 7)
        peak = max(range(lo, hi), key=lambda k: (x[k], -k))
        if all(abs(peak - c) >= 30 for c in chosen):
            chosen.append(peak)
    got = [r["pos"] for r in series.spaced_top_k(df, "series", "pos", "change", "energy", 4, 6, 30, 55.0).collect()]
    assert sorted(got) == sorted(chosen)
    forced = spark.createDataFrame([("s", 200)], "series STRING, pos BIGINT")
    with_forced = [r["pos"] for r in series.spaced_top_k(df, "series", "pos", "change", "energy", 4, 6, 30, 55.0, forced=forced).collect()]
    assert 200 in with_forced and len(with_forced) <= 4


def test_nearest_sample_prefers_the_earlier_on_a_tie(spark):
    named = spark.createDataFrame([("a", 1.0), ("a", 5.0)], "k STRING, t DOUBLE")
    samples = spark.createDataFrame([("a", 0.9), ("a", 1.1), ("a", 9.0)], "k STRING, s DOUBLE")
    got = {r["t"]: r["sample"] for r in intervals.nearest_sample(named, samples, ["k"], "t", "s", 0.2).collect()}
    assert got == {1.0: 0.9, 5.0: None}


def test_linear_resample(spark):
    df = spark.createDataFrame([("s", 0.0, 0.0), ("s", 2.0, 20.0), ("s", 2.5, 0.0)], "series STRING, t DOUBLE, v DOUBLE")
    got = {r["bin"]: r["v"] for r in series.resample_linear(df, "series", "t", "v", 2.0).collect()}
    assert got == {0: 0.0, 1: 5.0, 2: 10.0, 3: 15.0, 4: 20.0}


def test_rows_of_one_time_are_cut_by_the_next_column(spark):
    """A bulk import: half of a run's rows at one time, some at another, the rest spread."""
    rows = [("hot", 50, i * 7 % 9_001) for i in range(9_000)] + [("hot", 70, i) for i in range(700)] + [("hot", 1 + i % 90, 20_000 + i) for i in range(3_000)] + [("few", 50, i) for i in range(30)]
    df = spark.createDataFrame(rows, "run STRING, t BIGINT, id BIGINT").repartition(5)
    parted = bars.chunks_by_count(df, ["run"], "t", rows=100, steps=4, then="id")
    got = ordered.scan_in_order(parted, ["run"], ["t", "id"], F.col("__part"), row_number="rn", lag={"p": F.col("id")}).where("run = 'hot'").orderBy("rn").collect()
    want = sorted((t, i) for k, t, i in rows if k == "hot")
    assert [(r["t"], r["id"]) for r in got] == want and [r["p"] for r in got] == [None, *[i for _, i in want[:-1]]]
    sizes = [r["count"] for r in parted.where("run = 'hot'").groupBy("__part").count().collect()]
    assert max(sizes) < 1_500 and sum(sizes) == len(want)
    whole = bars.chunks_by_count(df, ["run"], "t", rows=100, steps=4)
    assert max(r["count"] for r in whole.groupBy("run", "__part").count().collect()) >= 9_000
