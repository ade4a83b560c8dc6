"""Group measures over readings: similarity to a reference, consensus, spread, drift."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.verdicts import CAST_MIN, DRIFT_MAX, FACE_COVERAGE_MIN, STRANGER_FRAMES, deviation_class
from assayer.operators.bars import chunks_by_count
from assayer.operators.ordered import scan_in_order
from assayer.operators.quantiles import medians, percentiles
from assayer.session import settle


def dot(a: Column, b: Column) -> Column:
    """Dot product of two arrays, summed in double precision; the cosine for unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def similarity_to_reference(items: DataFrame, refs: DataFrame, on: list[str], vector: str, name: str = "sim") -> DataFrame:
    """Similarity of each vector to the reference of its key; NULL where the key has none. ``refs``: on, ref."""
    return items.join(refs.select(*on, F.col("ref").alias("__ref")), on, "left").withColumn(name, dot(F.col(vector), F.col("__ref"))).drop("__ref")


def cast_verdict(faces: DataFrame, by: list[str], frame: str, main: str, sim: str, other: str | None = None) -> DataFrame:
    """Per scene: main-face similarities, frames with a stranger, and the verdict.

    ``faces``: one row per readable face; ``main`` is true for a frame's largest. A second face under the floor makes
    its frame a stranger frame, counted once.
    """
    m, s = F.col(main), F.col(sim)
    frames = faces.groupBy(*by, frame).agg(
        F.max(F.when(m, s)).alias("sim"), F.max((~m & (s < CAST_MIN)).cast("int")).alias("stranger"),
        (F.max(F.when(m, F.col(other))) if other else F.lit(None).cast("double")).alias("other"))
    g = frames.groupBy(*by).agg(F.count("sim").alias("faces"), F.avg("sim").alias("sim"), F.min("sim").alias("min_sim"), F.avg("other").alias("other"),
                                F.coalesce(F.sum(F.when(F.col("sim").isNotNull(), F.col("stranger"))), F.lit(0)).alias("strangers"))
    v = (F.when(F.col("faces") == 0, "NOFACE").when(F.col("strangers") >= STRANGER_FRAMES, "FAIL")
         .when(F.col("other") >= F.col("sim"), "FAIL").when(F.col("sim") >= CAST_MIN, "PASS").otherwise("FAIL"))
    return g.withColumn("verdict", v)


def consensus(df: DataFrame, group: list[str], name: str, x: str, y: str) -> DataFrame:
    """Adds ``deviation`` from the group medians, each axis in units of its median, and ``class``.

    Groups with fewer than two measurable rows have no consensus and no rows here.
    """
    ok = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double")))
    # Settled, so that its true size is known when Spark chooses how to join the rows with it.
    middle = settle(medians(ok, group, {"med_x": x, "med_y": y}).where("n >= 2").drop("n"), "medians")
    d = ok.join(middle, group)
    dev = F.hypot((F.col(x) - F.col("med_x")) / F.col("med_x"), (F.col(y) - F.col("med_y")) / F.col("med_y"))
    return d.withColumn("deviation", dev).withColumn("class", deviation_class(F.col("deviation"))).drop("med_x", "med_y")


def survivor(deviations: DataFrame, group: list[str], name: str) -> DataFrame:
    """The middle survivor of each group, or the nearest row when every row drifted, with the survivors counted.

    Only survivors are ranked: no other row is before one of them. A row without a deviation is behind all others.
    """
    d = deviations.select(*group, name, F.round("deviation", 12).alias("dev"))
    n = d.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum((F.col("dev") <= DRIFT_MAX).cast("bigint")), F.lit(0)).alias("survivors"))
    n = settle(n, "survivors")
    near = settle(d.where(F.col("dev") <= DRIFT_MAX), "near")
    ranked = scan_in_order(chunks_by_count(near, group, "dev"), group, ["dev", name], F.col("__part"), row_number="__rn")
    middle = ranked.join(n, group).where(F.col("__rn") == F.floor(F.col("survivors") / 2) + 1).select(*group, "rows", "survivors", F.col(name).alias("survivor"))
    none = d.join(n.where("survivors = 0"), group).groupBy(*group, "rows", "survivors")
    return middle.unionByName(none.agg(F.min(F.struct(F.col("dev").isNull(), "dev", F.col(name).alias("name")))["name"].alias("survivor")))


def spread(df: DataFrame, by: list[str], v: str) -> DataFrame:
    """p95 - p5 and the median."""
    p = percentiles(df, by, v, {"p5": 0.05, "median": 0.5, "p95": 0.95})
    return p.select(*by, "n", "median", (F.col("p95") - F.col("p5")).alias("spread"))


def assembly_drift(segments: DataFrame, placed: DataFrame, on: list[str], parts: int, limit_ms: int = 40) -> DataFrame:
    """Length of the segments before a placement against the placement. A missing segment is unreadable, not a fail.

    segments(on, frames, fps), placed(on, placed_ms)
    """
    ms = F.col("frames") / F.col("fps") * 1000
    g = segments.groupBy(*on).agg(F.count(ms).alias("read"), F.sum(ms).alias("ms"))
    j = placed.join(g, on, "left")
    whole = F.floor(F.col("ms") + 1e-6).cast("bigint")
    state = F.when(F.coalesce("read", F.lit(0)) < parts, "unreadable").when(F.abs(whole - F.col("placed_ms")) <= limit_ms, "ok").otherwise("fail")
    return j.select(*on, F.when(F.coalesce("read", F.lit(0)) >= parts, whole).alias("video_ms"), "placed_ms", state.alias("drift"))


def coverage_p95(df: DataFrame, by: list[str], a: str, b: str, height: str, seen: Column, min_rows: int = 20) -> DataFrame:
    """95th percentile of the difference of two tracks about their medians, in units of the median height.

    Measured only when enough rows were seen: coverage at least 0.70 and at least ``min_rows`` of them.
    """
    cov = df.groupBy(*by).agg(F.avg(seen.cast("double")).alias("coverage"), F.sum(seen.cast("bigint")).alias("seen"))
    rows = df.where(seen)
    d = rows.join(medians(rows, by, {"__a": a, "__b": b, "__h": height}).drop("n"), by)
    over = F.abs((F.col(a) - F.col("__a")) - (F.col(b) - F.col("__b"))) / F.col("__h")
    p = percentiles(d.withColumn("__o", over), by, "__o", {"p95": 0.95}).select(*by, "p95")
    ok = (F.col("coverage") >= FACE_COVERAGE_MIN) & (F.col("seen") >= min_rows)
    return cov.join(p, by, "left").select(*by, "coverage", "seen", F.when(ok, F.col("p95")).alias("p95"))
