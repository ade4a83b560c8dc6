"""Text normalisation and comparison as column expressions; what folds spoken numbers is an Arrow function over ``words``.

A spoken and a written line that mean the same compare equal: quotes straightened, prices, clock times and spoken
numbers written as digits, punctuation dropped. Whole texts are processed.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions import words as W
from assayer.functions.words import SCALES, UNITS  # noqa: F401

# Fixed values.
CAPTION_SIMILARITY, CAPTION_LEAD, CAPTION_LATE, CAPTION_TAIL, WINDOW_SLACK = 0.90, 0.50, 0.30, -0.10, 0.05


_ARRAY = T.ArrayType(T.StringType())


def _each(fn, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``fn`` of every row; the words of a few texts are held as Python strings at a time."""
    parts = [pa.array([fn(*row) for row in zip(*[x.slice(i, 64).to_pylist() for x in columns], strict=True)], kind) for i in range(0, len(columns[0]), 64)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


@F.arrow_udf(_ARRAY)
def normalise(text: pa.Array) -> pa.Array:
    """The words of a text before number folding."""
    return _each(lambda t: None if t is None else W.plain(W.spelled(t)), pa.list_(pa.string()), text)


@F.arrow_udf(_ARRAY)
def marked_tokens(text: pa.Array) -> pa.Array:
    """Words with numbers folded; a word that punctuation split from the one before is led by ``MARK``."""
    return _each(W.marked, pa.list_(pa.string()), text)


@F.arrow_udf(_ARRAY)
def tokens(text: pa.Array) -> pa.Array:
    """The words both sides of a comparison are reduced to."""
    return _each(lambda t: W.plain(W.marked(t)), pa.list_(pa.string()), text)


@F.arrow_udf(T.BooleanType())
def split_only(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two marked word lists differ only where punctuation splits a word, never between two digits."""
    return _each(W.split_only, pa.bool_(), a, b)


@F.arrow_udf(T.StringType())
def same_words(a: pa.Array, b: pa.Array) -> pa.Array:
    """MATCH, MATCH (split), MISMATCH, or NOTHING COMPARED when a side is missing or holds no word."""
    return _each(W.verdict, pa.string(), a, b)


def simple_upper(text: Column) -> Column:
    """Capitals of the letters that have a single one; the others, such as the sharp s, stay."""
    return F.array_join(F.transform(F.split(text, ""), lambda x: F.when(F.length(F.upper(x)) == 1, F.upper(x)).otherwise(x)), "")


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed a single time per row, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def word_diff(a: Column, b: Column) -> Column:
    """Words only one side has, as struct(removed, added)."""
    return once(F.struct(tokens(a).alias("a"), tokens(b).alias("b")), lambda t: F.struct(
        F.array_except(t["a"], t["b"]).alias("removed"), F.array_except(t["b"], t["a"]).alias("added")))


def numbers_of(words: Column) -> Column:
    return F.filter(words, lambda w: w.rlike("^[0-9]+$"))


@F.arrow_udf(T.BooleanType())
def numbers_equal(a: pa.Array, b: pa.Array) -> pa.Array:
    """Digit tokens agree exactly and in order."""
    return _each(W.numbers_equal, pa.bool_(), a, b)


def letters_only(text: Column) -> Column:
    return letters_of(tokens(text))


def letters_of(words: Column) -> Column:
    return F.regexp_replace(F.array_join(words, ""), "[^a-z]", "")


def ratio_bound(a: Column, b: Column) -> Column:
    """No similarity ratio of two strings can be higher than this."""
    la, lb = F.length(a), F.length(b)
    return F.when(la + lb == 0, 1.0).otherwise(2.0 * F.least(la, lb) / (la + lb))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def sentences(text: Column) -> Column:
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.filter(F.split(bare, r"(?<=[.?!])\s+"), lambda s: F.trim(s) != "")


def sentence_count(text: Column, most: int | None = None) -> Column:
    """Sentences; with ``most``, merged down to that many."""
    n = F.size(sentences(text))
    return n if most is None else F.least(n, F.lit(most))


def distinct_words(text: Column, min_len: int = 5) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"([a-z]{{{min_len},}})"), F.lit(1)))


def word_count(text: Column) -> Column:
    """Words between white space; 0 for a blank text."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+")))
