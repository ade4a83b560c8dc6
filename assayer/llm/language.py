"""Language of a text: a blended-spectrum string kernel, Nyström landmarks and one-versus-rest kernel ridge regression."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from assayer.llm.scan import scan, slices, texts

#: The kernel counts the distinct byte n-grams of 1 to so many bytes that two texts share.
SPECTRUM = 4
#: The training sample: of at most LANGS languages, the most frequent ones, so many rows each, texts of at most so many characters.
LANGS, LANG_ROWS, TRAIN_CHARS = 100, 300, 10_000
#: Landmarks over all languages, and bytes of a landmark.
LANDMARKS, LANDMARK_BYTES = 160, 4_000
RIDGE, SEED, UNKNOWN = 1e-3, "landmarks", "und"
#: Presence is multiplied with the landmarks' n-grams in blocks of so many columns.
BLOCK, GROUP_BYTES = 8_192, 1 << 19
_LETTER = regex.compile(r"\p{L}")


_FOLD = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def folded(text: str) -> bytes:
    """Lower case, in UTF-8; every run of ASCII characters that are no letters is one space."""
    return b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()) + b" "


def spectrum(data: bytes, most: int = SPECTRUM) -> np.ndarray:
    """The distinct n-grams of up to ``most`` bytes (four at the most) as ascending numbers that tell their lengths too."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    found, code = [], np.zeros(len(raw), np.uint64)
    for n in range(1, most + 1):
        if len(raw) < n:
            break
        code = code[:len(raw) - n + 1] << np.uint64(8) | raw[n - 1:]
        found.append(code | np.uint64(n << 32))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


@dataclass
class Model:
    """``grams``: n-grams of all landmarks; ``held``: which landmark has which; ``root``: square roots of the landmarks' n-gram
    counts; ``dual``: landmarks x languages."""

    langs: list[str]
    grams: np.ndarray
    held: np.ndarray
    root: np.ndarray
    dual: np.ndarray

    def kernel(self, many: list[bytes]) -> np.ndarray:
        """Shared n-grams of each text and each landmark, over the geometric mean of their own numbers."""
        out = np.zeros((len(many), self.held.shape[1]), np.float32)
        if not len(many) or not len(self.grams):
            return out
        who, at, size = [], [], []
        for i, data in enumerate(many):
            own = spectrum(data)
            spot = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
            spot = spot[self.grams[spot] == own]
            who.append(np.full(len(spot), i))
            at.append(spot)
            size.append(max(1, len(own)))
        who, at = np.concatenate(who), np.concatenate(at)
        for a in range(0, len(self.grams), BLOCK):
            inside = (at >= a) & (at < a + BLOCK)
            present = np.zeros((len(many), min(BLOCK, len(self.grams) - a)), np.float32)
            present[who[inside], at[inside] - a] = 1
            out += present @ self.held[a:a + BLOCK].astype(np.float32)
        return out / (np.sqrt(size)[:, None] * self.root[None, :])

    def predict(self, many: list[str]) -> tuple[list[str], list[float]]:
        """Best language and its margin mapped to 0..1; ``und`` and 0 for a text without a letter or where nothing was learned."""
        known = [i for i, t in enumerate(many) if self.langs and _LETTER.search(t)]
        lang, score = [UNKNOWN] * len(many), [0.0] * len(many)
        if known:
            margin = self.kernel([folded(many[i]) for i in known]).astype(np.float64) @ self.dual
            best = margin.argmax(axis=1)
            for i, k, m in zip(known, best.tolist(), margin[np.arange(len(known)), best].tolist(), strict=True):
                lang[i], score[i] = self.langs[k], min(1.0, max(0.0, (m + 1) / 2))
        return lang, score


def train(many: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Ridge regression of one language against the rest on Nyström features of the sample.

    Landmarks are the first texts of each language in the order given, the same number for each, cut to LANDMARK_BYTES;
    with K_mm of the landmarks and K_nm of the sample, the features are K_nm K_mm^(-1/2).
    """
    langs = sorted(set(labels))
    if not langs:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.uint8), np.zeros(0, np.float32), np.zeros((0, 0)))
    data, each = [folded(t) for t in many], max(1, landmarks // len(langs))
    chosen = [i for k in langs for i in [j for j, x in enumerate(labels) if x == k][:each]]
    marks = [spectrum(data[i][:LANDMARK_BYTES]) for i in chosen]
    grams = np.unique(np.concatenate(marks))
    held = np.zeros((len(grams), len(marks)), np.uint8)
    for j, m in enumerate(marks):
        held[np.searchsorted(grams, m), j] = 1
    root = np.sqrt([max(1, len(m)) for m in marks]).astype(np.float32)
    model = Model(langs, grams, held, root, np.zeros((len(marks), len(langs))))
    k_mm = model.kernel([data[i][:LANDMARK_BYTES] for i in chosen]).astype(np.float64)
    value, vector = np.linalg.eigh((k_mm + k_mm.T) / 2)
    keep = value > 1e-6 * value.max()
    half = vector[:, keep] / np.sqrt(value[keep])
    x = np.concatenate([model.kernel(data[a:a + 64]) for a in range(0, len(data), 64)]).astype(np.float64) @ half
    y = np.where(np.array(labels)[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    share = np.array([labels.count(k) for k in langs])
    weight = np.array([len(labels) / (len(langs) * share[langs.index(k)]) for k in labels])[:, None]
    solved = np.linalg.solve(x.T @ (weight * x) + ridge * len(labels) * np.eye(x.shape[1]), x.T @ (weight * y))
    model.dual = half @ solved
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the checksum of the id leaves 1 when divided by 3; null for a null id."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = LANG_ROWS,
        chars: int = TRAIN_CHARS, langs: int = LANGS) -> Model:
    """Learn from a bounded sample of the rows that are not held out and have an id, a text and a language.

    Of the ``langs`` most frequent languages at most ``rows`` texts each are drawn by a hash of the id, among texts of at most
    ``chars`` characters that hold a letter, whatever else they say. Without such rows nothing is learned.
    """
    known = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.col(f"`{lang_col}`").alias("_lang"),
                      held_out(id_col).alias("_out")).filter("_lang IS NOT NULL AND _text IS NOT NULL AND NOT _out")
    few = known.filter((F.length("_text") <= chars) & F.col("_text").rlike(r"\p{L}")).drop("_out")
    most = few.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "_lang").limit(langs).collect()
    if not most:
        return train([], [])
    # A share of each language, with room to spare, before anything is ordered; the rest is a few hundred rows a language.
    place = F.pmod(F.xxhash64(F.lit(SEED), "_id"), F.lit(1 << 40))
    share = F.lit(0).cast("bigint")
    for r in most:
        share = F.when(F.col("_lang") == r["_lang"], F.lit(int(min(1.0, 1.5 * (rows + 20) / r["_n"]) * (1 << 40)))).otherwise(share)
    drawn = few.withColumn("_place", place).filter(F.col("_place") < share)
    order = W.partitionBy("_lang").orderBy("_place", "_id", "_text")
    sample = drawn.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= rows).orderBy("_place", "_id", "_text").collect()
    return train([r["_text"] for r in sample], [r["_lang"] for r in sample])


def predict_language(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row of ``df``, over whole texts, in one scan.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing was learned. Ids are passed
    through, null or repeated; only the two named columns are read. Ties between languages go to the first by name. The model is
    broadcast: it is bounded by LANDMARKS texts of LANDMARK_BYTES bytes.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.grams, model.held, model.root, model.dual))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in slices(batches, "_text", GROUP_BYTES):
            lang, score = m.predict(texts(b, "_text"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [id_col, "lang_pred", "score"])

    rows = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text"))
    return scan(rows, task, f"`{id_col}` {dict(rows.dtypes)[id_col]}, lang_pred string, score double")


def language_digest(df: DataFrame) -> DataFrame:
    return predict_language(df, fit(df)).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
