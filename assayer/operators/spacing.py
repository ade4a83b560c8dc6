"""Greedy minimum spacing: keep an event when it lies at least ``gap`` after the last one kept.

The rule is sequential, yet a chunk of a series acts on its past as a small function: from the last event kept before it to
the last one kept at its end. Only the few events less than ``gap`` past the chunk's first can come first in it, so a table of
those events and where a walk from each ends is the whole function. Tables of neighbouring chunks compose into a table of
the same size. They are composed over a tree of ``FAN`` chunks a node; on the way down each node learns the last event kept before
it, and all chunks then emit their kept events in parallel. No task sees the borders of more than ``FAN`` chunks of a key.

Spark partitions by (key, node) and sorts; the tasks stream Arrow batches and hold one node at a time.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.session import settle

FAN = 256


def _successors(t: np.ndarray, gap: float) -> np.ndarray:
    """Index of the first event at least ``gap`` later, len(t) when there is none."""
    nxt = np.searchsorted(t, t + gap, side="left")
    return np.maximum(nxt, np.arange(len(t)) + 1)


def _whole_chunks(batches: Iterator[pd.DataFrame], work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], by: str = "c") -> Iterator[pd.DataFrame]:
    """Call ``work(rows, bounds)`` on runs of complete (k, ``by``) chunks of a sorted partition; a chunk cut by a batch
    border waits for its rest."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            rest = pdf
            continue
        k, c = pdf["k"].to_numpy(), pdf[by].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]) | (c[1:] != c[:-1])) + 1])
        rest = pdf.iloc[starts[-1]:]
        if len(starts) > 1:
            yield work(pdf.iloc[:starts[-1]], starts)
    if rest is not None and len(rest):
        yield work(rest.reset_index(drop=True), np.array([0, len(rest)]))


def _tables(pdf: pd.DataFrame, a: int, b: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(chunk, entries, ends) of the chunks in rows a to b."""
    c, entry, leaves = pdf["c"].to_numpy()[a:b], pdf["entry"].to_numpy()[a:b], pdf["leaves"].to_numpy()[a:b]
    cuts = [0, *(np.flatnonzero(c[1:] != c[:-1]) + 1), b - a]
    return [(c[i], entry[i:j], leaves[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def compose(first: tuple[np.ndarray, np.ndarray], then: tuple[np.ndarray, np.ndarray], gap: float) -> tuple[np.ndarray, np.ndarray]:
    """The table (entries, ends) of two chunks one after the other, from their own ones."""
    entry, leaves = first
    j = np.searchsorted(then[0], leaves + gap, side="left")
    ends = np.where(j < len(then[0]), then[1][np.minimum(j, len(then[0]) - 1)], leaves)
    if entry[-1] >= entry[0] + gap:
        return entry, ends
    # Every event of the first chunk may be blocked: those of the second that can then come first belong to the table.
    n = min(int(np.searchsorted(then[0], entry[0] + gap, side="left")) + 1, len(then[0]))
    return np.concatenate([entry, then[0][:n]]), np.concatenate([ends, then[1][:n]])


def spaced(df: DataFrame, key: str, t: str, gap: float, chunk: Column) -> DataFrame:
    """Rows (key, t) that survive greedy spacing. ``t`` is numeric; equal times of a key are one event.

    ``chunk`` is non-decreasing in ``t`` and should span many gaps.
    """
    ktype, ttype = df.schema[key].dataType.simpleString(), df.schema[t].dataType.simpleString()
    events = df.select(F.col(key).alias("k"), F.col(t).alias("t"), chunk.alias("c")).where(F.col("t").isNotNull() & F.col("k").isNotNull())

    def border_rows(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        k, c, times = pdf["k"].to_numpy(), pdf["c"].to_numpy(), pdf["t"].to_numpy()
        rows, entries, leaves = [], [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            ts = np.unique(times[a:b])
            nxt, end = _successors(ts, gap), np.arange(len(ts))
            for i in range(len(ts) - 1, -1, -1):
                if nxt[i] < len(ts):
                    end[i] = end[nxt[i]]
            # An event before this chunk blocks less than `gap` past the chunk's first event.
            n = min(int(np.searchsorted(ts, ts[0] + gap, side="left")) + 1, len(ts))
            rows.append(np.full(n, a))
            entries.append(ts[:n])
            leaves.append(ts[end[:n]])
        at = np.concatenate(rows)
        return pd.DataFrame({"k": k[at], "c": c[at], "entry": np.concatenate(entries), "leaves": np.concatenate(leaves)})

    def borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _whole_chunks(batches, border_rows)

    def composed_rows(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        k, node, rows, entries, leaves = pdf["k"].to_numpy(), pdf["node"].to_numpy(), [], [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            *before, (_, entry, ends) = _tables(pdf, a, b)
            table = (entry, ends)
            for _, entry, ends in reversed(before):
                table = compose((entry, ends), table, gap)
            rows.append(np.full(len(table[0]), a))
            entries.append(table[0])
            leaves.append(table[1])
        at = np.concatenate(rows)
        return pd.DataFrame({"k": k[at], "c": node[at], "entry": np.concatenate(entries), "leaves": np.concatenate(leaves)})

    def composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _whole_chunks(batches, composed_rows, "node")

    def swept_rows(pdf: pd.DataFrame, bounds: np.ndarray, lowest: bool) -> pd.DataFrame:
        k, rows, chunks, out = pdf["k"].to_numpy(), [], [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            last = None
            for c, entry, ends in _tables(pdf, a, b):
                if c < 0:  # what was kept before this node
                    last = entry[0]
                    continue
                i = 0 if last is None else int(np.searchsorted(entry, last + gap, side="left"))
                told = (entry[i] if i < len(entry) else None) if lowest else last
                if told is not None:
                    rows.append(a)
                    chunks.append(c)
                    out.append(told)
                if i < len(entry):
                    last = ends[i]
        return pd.DataFrame({"k": k[rows], "c": np.array(chunks, np.int64), "t": np.array(out, pdf["entry"].dtype)})

    def sweep(lowest: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        return lambda batches: _whole_chunks(batches, lambda pdf, bounds: swept_rows(pdf, bounds, lowest), "node")

    def kept_rows(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        k, times, first = pdf["k"].to_numpy(), pdf["t"].to_numpy(), pdf["first"].to_numpy(dtype=bool)
        rows, out = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            marks = np.flatnonzero(first[a:b])
            if not len(marks):
                continue
            ts = np.unique(times[a:b])
            nxt = _successors(ts, gap)
            i, walk_ = int(np.searchsorted(ts, times[a + marks[0]])), []
            while i < len(ts):
                walk_.append(i)
                i = int(nxt[i])
            rows.append(np.full(len(walk_), a))
            out.append(ts[walk_])
        if not rows:
            return pd.DataFrame({"k": k[:0], "t": times[:0]})
        return pd.DataFrame({"k": k[np.concatenate(rows)], "t": np.concatenate(out)})

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _whole_chunks(batches, kept_rows)

    table = f"k {ktype}, c bigint, entry {ttype}, leaves {ttype}"
    tables = [settle(events.repartition("k", "c").sortWithinPartitions("k", "c", "t").mapInPandas(borders, table), "borders")]
    low, high = tables[0].agg(F.min("c"), F.max("c")).first()
    if low is None:
        return df.select(key, t).limit(0)
    tables[0] = tables[0].withColumn("c", F.col("c") - F.lit(low))

    def nodes(rows: DataFrame) -> DataFrame:
        at = F.when(F.col("c") >= 0, F.floor(F.col("c") / FAN)).otherwise(-F.col("c") - 1).cast("bigint")
        return rows.withColumn("node", at).repartition("k", "node").sortWithinPartitions("k", "node", "c", "entry")

    width = high - low + 1
    while width > FAN:
        tables.append(settle(nodes(tables[-1]).mapInPandas(composed, table), "borders"))
        width = -(-width // FAN)
    told = None
    for depth in range(len(tables) - 1, -1, -1):
        # What was kept before a node joins its rows under a negative number that names the node.
        rows = tables[depth] if told is None else tables[depth].unionByName(told.select("k", (-F.col("c") - 1).alias("c"), F.col("t").alias("entry"), F.col("t").alias("leaves")))
        told = nodes(rows).mapInPandas(sweep(not depth), f"k {ktype}, c bigint, t {ttype}")
    first = told.withColumn("c", F.col("c") + F.lit(low))
    # The settled first event of a chunk travels as one more row of the chunk, so no join is needed.
    marked = events.withColumn("first", F.lit(False)).unionByName(first.withColumn("first", F.lit(True)))
    kept = marked.repartition("k", "c").sortWithinPartitions("k", "c", "t").mapInPandas(keep, f"k {ktype}, t {ttype}")
    return kept.select(F.col("k").alias(key), F.col("t").alias(t))
