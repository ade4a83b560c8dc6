"""Toxicity: subword-bag embeddings averaged into a linear softmax, embeddings and softmax trained jointly."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.scan import scan, slices, texts
from assayer.session import settle

GRAMS = (3, 4, 5)
BUCKET_BITS, DIM = 17, 8
#: The training sample: at most so many labelled rows, each of at most so many characters.
TRAIN_ROWS, TRAIN_CHARS = 6_000, 10_000
STEPS, BATCH, RATE, SEED = 1_500, 32, 0.02, 7
#: N-grams in fewer than this share of the sample's texts (two texts at least) get no embedding: they would learn single texts.
#: Those that tell the classes apart, by so many standard deviations, need LEAST_TEXTS texts only.
LEAST_SHARE, DROPPED, DECAY = 0.02, 0.5, 0.2
LEAST_TEXTS, TELLING = 5, 4
#: Averages are of n-grams weighted by how rare they are in the sample, times this, so that few words among many can count.
SCALE = 20
#: Once the model gives class 1 this much on its own texts, on average, texts to whose label it gives less than the second
#: number are taken for wrongly labelled and left out.
LEARNED, DOUBT = 0.4, 0.3
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def grams(many: list[str], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of the words of all texts, in order, and how many each text has.

    A word is a run of letters, lower-cased in ASCII, UTF-8, with a border before and after it. N-grams lie in one word and its
    borders; a whole word with its borders counts as well if it is longer than the longest n-gram.
    """
    cleaned = [b" " + b" ".join(t.encode().translate(_FOLD).split()) + b" " for t in many]
    data = np.frombuffer(b"".join(cleaned), np.uint8)
    owner = np.repeat(np.arange(len(many), dtype=np.int32), [len(c) for c in cleaned])
    n = len(data)
    space = data == 32
    # Bytes from a position up to and with the next border behind it.
    borders = np.flatnonzero(space)
    after = np.searchsorted(borders, np.arange(n), side="right")
    reach = np.append(borders, n)[after] - np.arange(n) + 1
    h, out, whose = np.zeros(n, np.uint32), [], []
    for size in range(1, max(GRAMS) + 1):
        m = n - size + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(16777619) + data[size - 1:].astype(np.uint32) + np.uint32(1)
        if size in GRAMS:
            ok = (reach[:m] >= size) & (owner[:m] == owner[size - 1:])
            mixed = h[ok] ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(13)
            out.append(mixed >> np.uint32(32 - bits))
            whose.append(owner[:m][ok])
    ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
    who = np.concatenate(whose) if whose else np.zeros(0, np.int32)
    order = np.argsort(who, kind="stable")
    return ids[order].astype(np.int32), np.bincount(who, minlength=len(many))


@dataclass
class Model:
    weight: np.ndarray  # per bucket: its embedding's part in log-odds
    bias: float

    def score(self, many: list[str]) -> np.ndarray:
        ids, sizes = grams(many)
        who = np.repeat(np.arange(len(many)), sizes)
        total = np.bincount(who, weights=self.weight[ids], minlength=len(many))
        return 1 / (1 + np.exp(-(self.bias + total / np.maximum(sizes, 1))))


def train(many: list[str], labels: list[int], steps: int = STEPS, seed: int = SEED) -> Model:
    """Adam over embeddings of n-gram buckets, averaged per text, and a two-class softmax above them."""
    rng = np.random.default_rng(seed)
    buckets, y = 1 << BUCKET_BITS, np.array(labels)
    if len(set(labels)) < 2:
        p = float(np.mean(y)) if len(y) else 0.0
        return Model(np.zeros(buckets), float(np.log((p * len(y) + 0.5) / (len(y) - p * len(y) + 0.5))))
    bags = []
    for t in many:
        ids, count = np.unique(grams([t])[0], return_counts=True)
        bags.append((ids.astype(np.int32), (count / max(1, count.sum())).astype(np.float32)))
    spread = np.bincount(np.concatenate([b[0] for b in bags]), minlength=buckets)
    toxic = np.bincount(np.concatenate([b[0] for b, k in zip(bags, y, strict=True) if k]), minlength=buckets)
    p = y.mean()
    told = np.abs(toxic - spread * p) / np.sqrt(np.maximum(spread, 1) * p * (1 - p))
    useful = (spread >= max(2, LEAST_SHARE * len(y))) | (spread >= LEAST_TEXTS) & (told >= TELLING)
    rare = np.where(useful, SCALE * np.log((len(y) + 1) / np.maximum(spread, 1)), 0).astype(np.float32)
    bags = [(ids[useful[ids]], (share * rare[ids])[useful[ids]]) for ids, share in bags]
    emb, soft, bias = (rng.normal(0, 0.1, (buckets, DIM))).astype(np.float32), rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.log(np.bincount(y, minlength=2) / len(y))
    m_e, v_e = np.zeros_like(emb), np.zeros_like(emb)
    small = [[np.zeros_like(x), np.zeros_like(x)] for x in (soft, bias)]
    step, batches, learned, trimming = 0, max(1, len(y) // BATCH), 0.0, False
    for _ in range(-(-steps // batches)):
        for at in np.array_split(rng.permutation(len(y)), batches):
            step += 1
            rate = RATE * max(0.05, 1 - step / steps)
            ids = np.concatenate([bags[i][0] for i in at])
            share = np.concatenate([bags[i][1] for i in at])
            who = np.repeat(np.arange(len(at)), [len(bags[i][0]) for i in at])
            stay = rng.random(len(ids)) >= DROPPED
            ids, share, who = ids[stay], share[stay] / np.float32(1 - DROPPED), who[stay]
            mean = np.stack([np.bincount(who, weights=share * emb[ids, d], minlength=len(at)) for d in range(DIM)], 1)
            z = mean @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            own = p[np.arange(len(at)), y[at]]
            if y[at].any():
                learned = 0.95 * learned + 0.05 * own[y[at] == 1].mean()
                trimming = trimming or learned >= LEARNED
            trusted = (own >= DOUBT) | (not trimming)
            p[np.arange(len(at)), y[at]] -= 1
            p *= trusted[:, None]
            p /= len(at)
            g_mean = p @ soft.T
            rows, inverse = np.unique(ids, return_inverse=True)
            g = np.stack([np.bincount(inverse, weights=share * g_mean[who, d], minlength=len(rows)) for d in range(DIM)], 1).astype(np.float32)
            m_e[rows] = 0.9 * m_e[rows] + 0.1 * g
            v_e[rows] = 0.999 * v_e[rows] + 0.001 * g * g
            fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            emb[rows] -= rate * (fix * m_e[rows] / (np.sqrt(v_e[rows]) + 1e-8) + DECAY * emb[rows])
            for x, gx, mv in ((soft, mean.T @ p, small[0]), (bias, p.sum(0), small[1])):
                mv[0][...] = 0.9 * mv[0] + 0.1 * gx
                mv[1][...] = 0.999 * mv[1] + 0.001 * gx * gx
                x -= rate * fix * mv[0] / (np.sqrt(mv[1]) + 1e-8)
    return Model(rare * (emb.astype(np.float64) @ (soft[:, 1] - soft[:, 0]).astype(np.float64)), float(bias[1] - bias[0]))


def held_out(doc_id: Column | str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0 if isinstance(doc_id, str) else F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    """Train on a bounded sample of labelled rows, never on held-out ones.

    About ``rows`` ids (at most that many) are chosen by a hash, whatever their label; only they are looked up in ``docs``, and
    texts longer than ``chars`` characters are left out of training. Of several labels of an id the larger counts, of several
    texts the smaller. Null ids, labels and texts are not used. Without two classes the model is the share of class 1.
    """
    known = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic")))
    share = min(1.0, rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    ids = known.filter(place < int(share * (1 << 40))).orderBy(place, "doc_id").limit(rows).collect()
    chosen = docs.sparkSession.createDataFrame([tuple(r) for r in ids], known.schema)
    sample = (docs.select("doc_id", "text").filter(F.length("text") <= chars)
              .join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows of two numbers
              .groupBy("doc_id", "_toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect())
    return train([r["text"] for r in sample], [r["_toxic"] for r in sample])


def score_toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) per row of ``df``, whole texts.

    A null or empty text, or one without letters, gets the prior. Ids are passed through, null or repeated; only the two named
    columns are read. The model has a fixed size (1 MB) and is broadcast.
    """
    kind = dict(df.dtypes)[id_col]
    shared = df.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in slices(batches, text_col, 1 << 20):
            s = m.score(texts(b, text_col))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [id_col, "score", "predicted"])

    return scan(df.select(id_col, text_col), task, f"`{id_col}` {kind}, score double, predicted int")


def toxicity_digest(df: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(df, fit(df, labels))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def mild_only(df: DataFrame, model: Model) -> DataFrame:
    """The rows of ``df`` that are not predicted toxic; rows that share an id go when one of them is. A null id stays."""
    # Settled, so that its true size is known when Spark chooses how to join the texts with it.
    bad = settle(score_toxicity(df, model).filter("predicted = 1").select("doc_id").distinct(), "toxic")
    return df.join(bad, "doc_id", "left_anti").select(*df.columns)
