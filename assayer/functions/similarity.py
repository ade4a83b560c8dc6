"""The functions Spark's expressions cannot state, as Arrow-batched pandas UDFs over single rows."""
from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions import text as X


@F.pandas_udf(T.DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two strings; NULL when a side is NULL."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def similarity_ratio(la: Column, lb: Column) -> Column:
    """Ratio of two letter strings (``text.letters_of``). Equal pairs are not compared in Python."""
    same = la == lb
    return F.when(same, 1.0).otherwise(matching_ratio(F.when(same, "").otherwise(la), F.when(same, "").otherwise(lb)))


def less_similar(la: Column, lb: Column, threshold: float = X.CAPTION_SIMILARITY) -> Column:
    """Whether the ratio lies under ``threshold``; pairs whose lengths alone decide that are not compared in Python."""
    bound = X.ratio_bound(la, lb)
    settled = (bound < threshold) | (la == lb)
    measured = matching_ratio(F.when(settled, "").otherwise(la), F.when(settled, "").otherwise(lb))
    return F.when(la == lb, F.lit(1.0) < threshold).when(bound < threshold, True).otherwise(measured < threshold)


@F.pandas_udf(T.ArrayType(T.StringType()))
def word_opcodes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edits from word list ``a`` to ``b`` as ``tag: words / words``."""
    out = []
    for x, y in zip(a, b, strict=True):
        if x is None or y is None:
            out.append(None)
            continue
        x, y = list(x), list(y)
        ops = SequenceMatcher(a=x, b=y, autojunk=False).get_opcodes()
        out.append([f"{tag}: {' '.join(x[i1:i2])} / {' '.join(y[j1:j2])}" for tag, i1, i2, j1, j2 in ops if tag != "equal"])
    return pd.Series(out)
