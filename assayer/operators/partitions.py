"""Partitioning helpers."""
from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, tasks: int | None) -> DataFrame:
    """Give CPU-heavy work on few input splits ``tasks`` of them; None, for a large scan, keeps its own splits and shuffles nothing.

    A small file is often a single row group and so a single task. Only the caller knows what it reads.
    """
    return df.repartition(tasks) if tasks else df
