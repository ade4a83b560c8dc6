"""Helpers for operators that read texts in Arrow batches."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``most`` bytes of ``column``; a longer single text is a slice by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; a null is an empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def scan(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(task, schema)


class Recent:
    """A cache of bounded size: when the young half is full it becomes the old half, and the old one goes."""

    def __init__(self, most: int):
        self.half, self.young, self.old = most // 2, {}, {}

    def get(self, key):
        v = self.young.get(key)
        if v is None and (v := self.old.get(key)) is not None:
            self.put(key, v)
        return v

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value
