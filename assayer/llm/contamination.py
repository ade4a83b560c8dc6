"""Benchmark decontamination: one Aho-Corasick automaton over windows of the items' words."""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.scan import scan, slices, texts
from assayer.session import settle

WINDOW = 10
#: Item text per automaton, in bytes. Its tree takes up to 600 times that (150 MB) in a worker; more items mean more passes.
BLOCK_BYTES = 256 << 10
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def normalised(text: str) -> list[bytes]:
    """Words of the lower-cased text, UTF-8: all but ASCII letters, digits and non-ASCII characters divides words."""
    return text.encode().translate(_FOLD).split()


def windows(words: list[bytes], n: int = WINDOW) -> set[bytes]:
    return {b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


class Matcher:
    def __init__(self, items: list[tuple[str, str]], n: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for w in windows(normalised(text), n):
                owners.setdefault(w, set()).add(item)
        self.found = ahocorasick.Automaton()
        for w, own in owners.items():
            self.found.add_word(f" {w.decode('latin-1')} ", (len(w), frozenset(own)))
        self.any = bool(owners)
        if owners:
            self.found.make_automaton()

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words (first, end) that occurrences cover, joined where they overlap or touch, and the items."""
        if not self.any or not words:
            return [], set()
        line, items, hits = f" {b' '.join(words).decode('latin-1')} ", set(), []
        for end, (size, own) in self.found.iter(line):
            items |= own
            hits.append((end - size, end))
        if not hits:
            return [], items
        starts = np.fromiter(accumulate((len(w) + 1 for w in words), initial=1), np.int64, len(words) + 1)
        ends = np.array(hits)
        spans: list[tuple[int, int]] = []
        for a, b in sorted(zip(np.searchsorted(starts, ends[:, 0]).tolist(), np.searchsorted(starts, ends[:, 1] + 1).tolist(), strict=True)):
            if spans and a <= spans[-1][1]:
                spans[-1] = spans[-1][0], max(spans[-1][1], b)
            else:
                spans.append((a, b))
        return spans, items


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as character spans of the original text."""
    at = [m.span() for m in WORD.finditer(text.translate(_ASCII_LOW))]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


_ASCII_LOW = {c: c + 32 for c in range(65, 91)}


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of bounded text. The benchmark is a stated query set; it is read block by block, by a hash of the item."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(text_col, F.lit("")).alias("t")).filter("item IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("t") + 1), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        yield [(r["item"], r["t"]) for r in items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).toLocalIterator()]


def contamination(df: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) per row of ``df``; spans are (start, end) characters of the original text.

    Items are taken in blocks of ``block_bytes`` text, one automaton and one pass over the texts for each; findings of several
    passes are united. A null or empty text has no words and no hit. A null item text has no window; a null item id is
    ignored; repeated items count once. Ids are passed through, null or repeated. Only the named columns are read.
    """
    kind = dict(df.dtypes)[id_col]
    passes = [_pass(df.select(id_col, text_col), items, n, kind) for items in item_blocks(benchmark, item_col, text_col, block_bytes)]
    out = passes[0]
    if len(passes) > 1:
        every = passes[0]
        for more in passes[1:]:
            every = every.unionByName(more)
        # Rows equal in id and text find the same in each pass, so they can be united as one and counted.
        out = (every.groupBy(id_col, "sig").agg(F.first("n_words").alias("n_words"), _united("words"), _united("spans"),
                                                F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                                                F.expr(f"CAST(count(*) DIV {len(passes)} AS INT)").alias("copies"))
               .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
    covered = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w["end"] - w["start"])
    return out.select(id_col, "n_words", covered.alias("n_hit"), "items", "spans")


SPANS = "array<struct<start:int,end:int>>"


def _pass(source: DataFrame, items: list[tuple[str, str]], n: int, kind: str) -> DataFrame:
    id_col, text_col = source.columns
    shared = source.sparkSession.sparkContext.broadcast(items)
    kept = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda spans: [{"start": a, "end": b} for a, b in spans]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, n)
        for b in slices(batches, text_col):
            rows = []
            for t in texts(b, text_col):
                words = normalised(t)
                spans, found = matcher.match(words)
                rows.append((xxhash.xxh64_intdigest(t.encode()) >> 1, len(words), as_rows(spans), sorted(found),
                             as_rows(offsets(t, spans)) if spans else []))
            kinds = (pa.int64(), pa.int64(), kept, pa.list_(pa.string()), kept)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))],
                                             [id_col, "sig", "n_words", "words", "items", "spans"])

    return scan(source, task, f"`{id_col}` {kind}, sig long, n_words long, words {SPANS}, items array<string>, spans {SPANS}")


def _united(name: str) -> Column:
    """Spans of all passes, joined where they overlap or touch."""
    last = lambda acc: F.element_at(acc, -1)
    grown = lambda acc, s: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
        last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], s["end"]).alias("end"))))
    step = lambda acc, s: F.when(F.size(acc) == 0, F.array(s)).when(s["start"] <= last(acc)["end"], grown(acc, s)).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(F.flatten(F.collect_set(name))), F.array().cast(SPANS), step).alias(name)


def contamination_digest(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(df, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean_of(df: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``df`` without a hit. Rows with a null id stay: no benchmark finding can be tied to them."""
    hit = settle(contamination(df, benchmark, **how).filter("n_hit > 0").select("doc_id").distinct(), "hit")
    return df.join(hit, "doc_id", "left_anti").select(*df.columns)
