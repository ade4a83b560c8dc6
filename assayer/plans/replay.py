"""Does an append-only ledger describe a legal run?"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators import ledger as L
from assayer.operators.ordered import chunk_of, scan_in_order
from assayer.operators.validate import classify_rows

# The words a reason is read by.
PERSON = r"\bthe author\b"
FAILED = r"(?i)\b(refus|reject|422|time[sd]? ?out|timeout|no video|error)\w*"
BACK_TO_SCENE = r"\bscene|re-roll"


def scene_key(scene: Column) -> Column:
    """A trailing roll digit on the scene letter is the same scene: x-a2 is x-a."""
    return F.regexp_replace(scene, r"^(.*-[a-z])\d+$", "$1")


def spot_key(scene: Column) -> Column:
    return F.regexp_replace(scene, r"-[a-z]$", "")


def version_of(master: Column) -> Column:
    return F.nullif(F.regexp_extract(master, r"-v(\d+)\.mp4$", 1), F.lit("")).cast("int")


def first_token(text: Column) -> Column:
    return F.rtrim(F.element_at(F.split(F.trim(text), r"\s+"), 1), F.lit(",;"))


def reason_class(why: Column) -> Column:
    """person, failed, other or none: what a reason says decides whose move a re-roll is."""
    text = F.coalesce(why, F.lit(""))
    return (F.when(text.rlike(PERSON), "person").when(text.rlike(FAILED), "failed").when(text != "", "other").otherwise("none"))


def classify_history(rows: DataFrame) -> DataFrame:
    """Adds ``row_kind``, the first rule that a row of the historic files fits; NULL where none does.

    Such a row adds no moves; ``unknown_rows`` returns it, and a replay is only whole where that is empty.
    """
    c = F.col
    asked = c("file") == "requests.jsonl"
    bed = (c("kind") == "bed") | c("scene").endswith("-bed") | (c("engine") == "fal-ai/lyria2")
    # Kinds as the files state them and the names of their rows.
    named = {"scene": "scene landing", "closer": "closer landing", "bed": "bed landing", "master": "ship gate",
             "gated master": "ad gates", "withdrawn": "withdrawn", "relocation": "moved", "moved": "moved"}
    rules = [("bed request", asked & F.coalesce(bed, F.lit(False))),
             ("scene request", asked & c("kind").isNull() & c("scene").isNotNull()),
             ("scene landing", ~asked & c("kind").isNull() & c("scene").isNotNull() & (c("status").isNotNull() | c("url").isNotNull()))]
    rules += [(kind, ~asked & (c("kind") == label)) for label, kind in named.items()]
    return classify_rows(rows, rules)


def unknown_rows(rows: DataFrame) -> DataFrame:
    """(shoot, file, line) of classified rows whose shape no rule knows."""
    return rows.where("row_kind IS NULL").select("shoot", "file", "line")


def deliveries(rows: DataFrame) -> DataFrame:
    """(shoot, spot, day) of every delivery the rows state."""
    c = F.col
    pulled = rows.where("row_kind = 'withdrawn'").select("shoot", F.explode("withdrawn.ad").alias("spot"), "day")
    replaced = rows.where((c("row_kind") == "ship gate") & c("supersedes").contains("withdrawn")).select("shoot", c("scene").alias("spot"), "day")
    moved = rows.where("row_kind = 'moved'").select("shoot", F.coalesce("scene", "ad").alias("spot"), "day")
    return pulled.unionByName(replaced).unionByName(moved)


def replay_history(rows: DataFrame) -> DataFrame:
    """Moves stated by hand-written rows: (shoot, src, dst, file, line).

    ``rows`` is the output of :func:`classify_history` with ``shoot``, ``file``, ``line`` and ``day`` (a date string or NULL).
    """
    c = F.col
    req = rows.where("row_kind = 'scene request'").select(
        "shoot", "file", "line", "day", scene_key(c("scene")).alias("scene_key"), F.coalesce("engine", "leg", F.lit("bed")).alias("on_engine"),
        F.coalesce("why", "reason", F.lit("")).alias("why"), F.coalesce("roll", "attempt", F.lit(1)).alias("claimed"))
    nth = scan_in_order(req, ["shoot", "scene_key", "on_engine"], ["line"], chunk_of("line"), row_number="nth")
    again = nth.where((c("nth") > 1) | (c("claimed") > 1) | (c("why") != "")).withColumn("spot", spot_key(c("scene_key")))
    again = L.exists_before(again, deliveries(rows), ["shoot", "spot"]).withColumn("says", reason_class(c("why")))
    src = (F.when((c("says") == "person") & c("after"), "review").when(c("says").isin("person", "other"), "eye").otherwise("render"))
    rerolls = again.select("shoot", src.alias("src"), F.lit("render").alias("dst"), "file", "line")

    mouth = F.coalesce("mouth", F.lit(""))
    asked_eye = rows.where((c("row_kind") == "ad gates") & (first_token(mouth) == "REVIEW") & mouth.contains("eye approved"))
    eye = asked_eye.select("shoot", F.lit("ad_gates").alias("src"), F.lit("eye").alias("dst"), "file", "line")

    def pair(a: str, b: str) -> Column:
        return F.struct(F.lit(a).alias("src"), F.lit(b).alias("dst"))

    replaced = rows.where((c("row_kind") == "ship gate") & c("supersedes").contains("withdrawn"))
    passed = F.coalesce(c("gate") == "ship_gate pass", F.lit(False))
    shipped = replaced.select("shoot", F.inline(F.when(passed, F.array(pair("ship_gate", "deliver"), pair("ledger", "board"))).otherwise(
        F.array(pair("ledger", "board")))), "file", "line")
    reason = F.coalesce("reason", F.lit(""))
    back = F.when(reason.contains("closer"), "closer").when(reason.rlike(BACK_TO_SCENE), "render").otherwise("build")
    pulled = rows.where("row_kind = 'withdrawn'").select("shoot", "file", "line", back.alias("back"), F.explode("withdrawn").alias("w"))
    returned = pulled.select("shoot", F.inline(F.array(
        pair("deliver", "review"), F.struct(F.lit("review").alias("src"), c("back").alias("dst")))), "file", "line")
    return rerolls.unionByName(eye).unionByName(shipped).unionByName(returned)


def replay_runs(ledger: DataFrame, allowed: DataFrame) -> DataFrame:
    """One row per graph-written run: rows, moves of every trail, unmapped moves, stops, re-entries, notes, deliveries
    without a ship-gate pass before them, rows with a local path, and the last stop."""
    c = F.col
    ends = ledger.where(c("kind").isin(*L.END_KINDS))
    moves = L.trail_moves(ends, "trail", ["run", "seq"])
    conf = L.conformance(moves, allowed, ["run"]).withColumn("unmapped", c("moves") - c("mapped")).drop("mapped")
    is_gate = (c("kind") == "gate") & (c("step") == "ship_gate")
    dl = L.last_before(ledger.select("run", "seq", "kind", "step", "pass"), c("kind") == "deliver", is_gate, c("pass"))
    bad = dl.where(~F.coalesce(c("found.value"), F.lit(False))).groupBy("run").agg(F.count(F.lit(1)).alias("unproven_deliveries"))
    kinds = ledger.groupBy("run").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(c("kind").isin("close", "crashed").cast("bigint")).alias("stops"),
        F.sum((c("kind") == "resumed").cast("bigint")).alias("reentries"), F.sum(c("kind").isin("redacted", "corrected").cast("bigint")).alias("notes"),
        F.max(F.when(c("kind").isin(*L.END_KINDS), F.struct("seq", "kind", "step"))).alias("last"))
    out = kinds.join(conf, "run", "left").join(bad, "run", "left").na.fill(0, ["moves", "unmapped", "unproven_deliveries"])
    return out.select("run", "rows", "moves", "unmapped", "stops", "reentries", "notes", "unproven_deliveries",
                      c("last.kind").alias("end"), c("last.step").alias("last_step"))


def replay_rows(ledger: DataFrame, allowed: DataFrame) -> DataFrame:
    """The same audit for ledgers whose rows themselves are the steps."""
    moves = L.row_moves(ledger)
    conf = L.conformance(moves, allowed, ["run"])
    gaps = L.seq_gaps(ledger).groupBy("run").agg(F.count(F.lit(1)).alias("gaps"))
    base = ledger.groupBy("run").agg(F.count(F.lit(1)).alias("rows"), F.max(F.struct("seq", "step"))["step"].alias("last_step"))
    return (base.join(conf, "run", "left").join(gaps, "run", "left").na.fill(0, ["moves", "mapped", "gaps"])
            .select("run", "rows", "moves", (F.col("moves") - F.col("mapped")).alias("unmapped"), "gaps", "last_step"))
