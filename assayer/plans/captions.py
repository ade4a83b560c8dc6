"""Do burned captions say what is spoken, when it is spoken?"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions import text as X
from assayer.functions.similarity import less_similar
from assayer.operators.intervals import contained, overlapping


def cue_words(words: DataFrame, cues: DataFrame, on: list[str], cue: str = "cue") -> DataFrame:
    """Per cue: what was said in its window, when it began and ended, and how many words under it the window leaves out."""
    key = [*on, cue]
    windows = cues.select(*key, F.col("start_s").alias("cue_start"), F.col("end_s").alias("cue_end"), "spoken_start", "spoken_end")
    w = words.select(*on, "text", "start_s", "end_s")
    inside = contained(w, windows, on)
    said = inside.groupBy(*key).agg(
        F.min("start_s").alias("first"), F.max("end_s").alias("last"), F.count(F.lit(1)).alias("spoken"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_s", "end_s", "text"))), lambda x: x["text"]), " ").alias("said"))
    under = overlapping(w, windows, on)
    left_out = ~((F.col("start_s") >= F.col("spoken_start") - X.WINDOW_SLACK) & (F.col("end_s") <= F.col("spoken_end") + X.WINDOW_SLACK))
    missed = under.where(left_out).groupBy(*key).agg(F.count(F.lit(1)).alias("missed"))
    return cues.join(said, key, "left").join(missed, key, "left").na.fill(0, ["spoken", "missed"])


def timing_faults(first: Column, last: Column, start: Column, end: Column) -> Column:
    """Timing faults of a cue against the words it stands over."""
    lead, tail = first - start, end - last
    return F.array_compact(F.array(F.when(lead > X.CAPTION_LEAD, "early"), F.when(lead < -X.CAPTION_LATE, "late"), F.when(tail < X.CAPTION_TAIL, "drops")))


def caption_check(words: DataFrame, cues: DataFrame, on: list[str], cue: str = "cue", text: str = "text") -> DataFrame:
    """Per cue the faults found and ``ok``. A cue with missed words or without any word fails on that alone."""
    d = cue_words(words, cues, on, cue)
    d = d.withColumn("__t", X.tokens(F.col(text))).withColumn("__s", X.tokens(F.col("said")))
    d = d.withColumn("__tl", X.letters_of(F.col("__t"))).withColumn("__sl", X.letters_of(F.col("__s")))
    faults = timing_faults(F.col("first"), F.col("last"), F.col("start_s"), F.col("end_s"))
    numbers = F.when(X.numbers_of(F.col("__t")) != X.numbers_of(F.col("__s")), "numbers")
    ratio = F.when(less_similar(F.col("__tl"), F.col("__sl")), "text")
    all_faults = F.when(F.col("missed") > 0, F.array(F.lit("missed words"))).when(F.col("spoken") == 0, F.array(F.lit("no word"))).otherwise(
        F.concat(F.array_compact(F.array(numbers, ratio)), faults))
    return d.withColumn("faults", all_faults).withColumn("ok", F.size("faults") == 0).drop("__t", "__s", "__tl", "__sl")


def caption_verdict(checked: DataFrame, docs: DataFrame, on: list[str]) -> DataFrame:
    """PASS or FAIL per document; a document without cues fails, since nothing was inspected."""
    g = checked.groupBy(*on).agg(F.count(F.lit(1)).alias("cues"), F.sum((~F.col("ok")).cast("bigint")).alias("failed"))
    return docs.select(*on).distinct().join(g, on, "left").na.fill(0, ["cues", "failed"]).withColumn(
        "verdict", F.when((F.col("cues") == 0) | (F.col("failed") > 0), "FAIL").otherwise("PASS"))
