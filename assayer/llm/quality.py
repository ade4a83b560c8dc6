"""Quality rules: lines are cleaned first, then documents that lost too much are rejected. Column expressions only."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PCT = 20, 30
#: A line fails with more than this percentage of signs, two of them free; or with so many bars. A document is
#: rejected when its passing lines hold less than this percentage of its characters.
SIGNS_PCT, FREE_SIGNS, BARS, MIN_KEPT_PCT = 4, 2, 3, 50
BOILERPLATE = (r"(?i)\b(all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|enable javascript|licensed under"
               r"|subscribe to our|click here|sign up|log ?in to)\b")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words inside ``n``-word windows that occur twice or more, the first occurrence included."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.xxhash64(F.slice(words, i, n)))

    def covered(sorted_windows: Column) -> Column:
        same = F.filter(sorted_windows, lambda w, i: F.coalesce(w["h"] == F.get(sorted_windows, i - 1)["h"], F.lit(False))
                        | F.coalesce(w["h"] == F.get(sorted_windows, i + 1)["h"], F.lit(False)))
        places = F.array_sort(F.transform(same, lambda w: w["at"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n)))), F.lit(0), lambda a, b: a + b))

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, covered))

    return F.when(F.size(words) < n, F.lit(0)).otherwise(let(hashes, count))


def signs_in(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def line_passes(line: Column) -> Column:
    """Punctuation: few signs and exclamation marks for its length. Navigation: few bars. Boilerplate: none of the fixed phrases."""
    size = F.length(line)
    noisy = (signs_in(line, "#*$%&<>!") - FREE_SIGNS) * 100 > SIGNS_PCT * size
    return ~noisy & (signs_in(line, "|") < BARS) & ~line.rlike(BOILERPLATE)


def clean_lines(text: Column) -> Column:
    """Lines that pass; a line without a word is left out."""
    return F.filter(F.split(text, "\n"), lambda x: (F.length(F.btrim(x, F.lit(SPACE))) > 0) & line_passes(x))


def judge_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``cleaned`` (the passing lines) per row of ``df``.

    A document is rejected when it fails a base rule or when its passing lines hold less than ``MIN_KEPT_PCT`` percent of its
    characters in words. A null or empty text has no words and fails. Ids are passed through, null or repeated; other
    columns are not read. Each text is worked on in its own row, in time about linear in its length.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(F.col(id_col), text.alias("_text"), words_of(text).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    chars = lambda c: F.length(F.translate(c, SPACE, ""))
    m = base.select(
        id_col, "_text", F.size("_words").cast("long").alias("n_words"), chars(F.col("_text")).cast("long").alias("word_chars"),
        signs_in(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(F.col("_words"), lambda w: repeated_words(w)).cast("long").alias("n_repeat_words"),
        F.concat_ws("\n", clean_lines(F.col("_text"))).alias("cleaned"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    kept = ~failed & (100 * chars(F.col("cleaned")) >= MIN_KEPT_PCT * F.col("word_chars"))
    return m.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                    kept.alias("kept"), "cleaned")
