"""Draw documents whose word buckets resemble a target's, by importance weights summed over bit planes."""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.numbering import numbered
from assayer.llm.scan import scan, slices, texts
from assayer.session import settle

BUCKETS, MIN_WORDS, PERCENT, SEED, SCALE = 10_000, 20, 10, 2024, 1_000
#: Documents whose planes are held at a time.
GROUP = 64
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def features(text: str, most: int = 1) -> tuple[Counter, int]:
    """Runs of 1 to ``most`` consecutive words with their counts, and the number of words."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    found = Counter(words)
    for n in range(2, most + 1):
        found.update(b" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
    return found, len(words)


def bucket_counts(found: Counter, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and count of each feature; a bucket may come more than once."""
    return (np.fromiter((crc32(w) % buckets for w in found), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found)))


def corpus_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most: int = 1) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sums its own texts; at most ``buckets`` rows come back."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in slices(batches, text_col):
            for t in texts(b, text_col):
                at, n = bucket_counts(features(t, most)[0], buckets)
                np.add.at(total, at, n)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    sums = scan(df.select(F.col(f"`{text_col}`").alias(text_col)), task, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), in doubles."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans packed into words of 64 bits."""
    packed = np.packbits(rows, axis=-1, bitorder="little")
    return np.pad(packed, [(0, 0)] * (rows.ndim - 1) + [(0, -packed.shape[-1] % 8)]).view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the gains in two's complement, and what a bit of each plane is worth: the last one is negative."""
    width = 1 + max(int(gain.max(initial=0)).bit_length(), int(-1 - gain.min(initial=0)).bit_length())
    worth = [1 << q for q in range(width - 1)] + [-(1 << (width - 1))]
    return np.stack([_bits((gain >> q & 1).astype(bool)) for q in range(width)]), np.array(worth, np.int64)


def count_planes(who: np.ndarray, bucket: np.ndarray, n: np.ndarray, documents: int, buckets: int) -> np.ndarray:
    """Bit planes of the bucket counts of some documents: documents x planes x words."""
    cells, inverse = np.unique(who * buckets + bucket, return_inverse=True)
    total = np.zeros(len(cells), np.int64)
    np.add.at(total, inverse, n)
    height = int(total.max(initial=0)).bit_length()
    words = -(-buckets // 64)
    planes = np.zeros((documents, height, words), np.uint64)
    doc, at = cells // buckets, cells % buckets
    for p in range(height):
        on = (total >> p & 1).astype(bool)
        np.bitwise_or.at(planes, (doc[on], p, at[on] >> 6), np.uint64(1) << (at[on] & 63).astype(np.uint64))
    return planes


def weights(planes: np.ndarray, gain: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """Sum over both sets of planes of 2^p times a gain plane's worth times the bits they share: exactly count x gain."""
    out = np.zeros(len(planes), np.int64)
    for q, plane in enumerate(gain):
        shared = np.bitwise_count(planes & plane).sum(axis=2, dtype=np.int64)
        out += worth[q] * (shared << np.arange(planes.shape[1], dtype=np.int64)).sum(axis=1)
    return out


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from a digest of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_col}`").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def score_documents(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
                    most: int = 1, seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) per row of ``df``, over whole texts; two scans, no shuffle but bucket sums.

    A null or empty text has no features and weight 0, the row of a null id no score. Repeated ids and equal texts count as
    often as they come. Only the two named columns are read; ``target`` needs ``text_col``, and may be empty.
    """
    planes, worth = gain_planes(gains(corpus_counts(df, text_col, buckets, most), corpus_counts(target, text_col, buckets, most)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in slices(batches, "_text"):
            for a in range(0, big.num_rows, GROUP):
                b = big.slice(a, GROUP)
                n_words, n_features, who, at, n = [], [], [], [], []
                for i, t in enumerate(texts(b, "_text")):
                    found, words = features(t, most)
                    x, y = bucket_counts(found, buckets)
                    who.append(np.full(len(x), i))
                    at.append(x)
                    n.append(y)
                    n_words.append(words)
                    n_features.append(int(y.sum()))
                held = count_planes(np.concatenate(who), np.concatenate(at), np.concatenate(n), b.num_rows, buckets)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                                                  pa.array(weights(held, planes, worth), pa.int64())], [id_col, "n_words", "n_features", "weight"])

    rows = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text"))
    scored = scan(rows, task, f"`{id_col}` {dict(rows.dtypes)[id_col]}, n_words bigint, n_features bigint, weight bigint")
    return scored.withColumn("score", F.col("weight") + noise(id_col, seed))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, most: int = 1,
             seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_features, weight, score, rank) per row of ``df``; rank is 1, 2, ... for the rows drawn, null for the others.

    Of the N rows with an id and at least ``min_words`` words the floor(percent N / 100) with the highest score are drawn, ties
    to the smaller id, then to the larger weight; rows that are equal in all of these are told apart by their place in the
    input. Ranks come from a range partitioning, not from one task. An empty table gives no rows. See ``score_documents``.
    """
    scored = settle(score_documents(df, target, id_col, text_col, buckets, most, seed).withColumn("_row", F.monotonically_increasing_id()), "scored")
    enough = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    placed = numbered(scored.filter(enough), [], [F.col("score").desc(), F.col(f"`{id_col}`").asc(), F.col("weight").desc(), F.col("_row").asc()], "_place", "_all")
    rank = F.when((F.col("_place") + 1) * 100 <= F.col("_all") * percent, F.col("_place") + 1)
    told = [F.col(f"`{id_col}`").alias(id_col), "n_features", "weight", "score"]
    rest = scored.filter(~F.coalesce(enough, F.lit(False)))
    return placed.select(*told, rank.alias("rank")).unionByName(rest.select(*told, F.lit(None).cast("bigint").alias("rank")))
