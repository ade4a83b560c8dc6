"""SimHash near-duplicates: fingerprints, pigeonring candidates, links and components."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.components import components
from assayer.llm.scan import scan, slices, texts
from assayer.session import settle

BITS, TAU, SEGMENTS = 64, 2, 6
FEW = 24


def shingle_hashes(text: str, size: int, seed: int = 42) -> list[int]:
    """XXH64 of each shingle, repeats included; fewer words than ``size``: of the whole sequence; no word: none."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return []
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [h(joined, seed)]
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [h(joined[a:b - 1], seed) for a, b in zip(starts, starts[size:], strict=False)]


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes: a bit is set if it is set in over half of the run."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    sizes = np.diff(np.append(starts, len(hashes)))
    return np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(df: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of each row, whole texts; fp is the 64-bit fingerprint as a signed long. No word: zero."""
    kind = dict(df.dtypes)[id_col]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, 2 << 20):
            runs = [np.array(shingle_hashes(t, size), np.uint64) for t in texts(b, text_col)]
            full = [i for i, r in enumerate(runs) if len(r)]
            fp = np.zeros(len(runs), np.uint64)
            if full:
                sizes = np.array([len(runs[i]) for i in full])
                fp[full] = majority(np.concatenate([runs[i] for i in full]), np.cumsum(sizes) - sizes)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], [id_col, "fp"])

    return scan(df.select(id_col, text_col), task, f"`{id_col}` {kind}, fp long")


class Ring:
    """The segments of a fingerprint as a ring.

    Of two fingerprints with at most ``tau`` differing bits, some start has a chain in which every prefix of l segments differs in
    at most floor(l * tau / m) bits. With 6 segments and 2 bits: 0, 0, 1, 1, 1, 2. So the first two segments are equal, and of
    the next three at least two. A key is the chain of five without one of those three: four equal segments, 42 or 43 bits.
    """

    def __init__(self, tau: int = TAU, segments: int = SEGMENTS):
        edges = [BITS * i // segments for i in range(segments + 1)]
        self.tau, self.m = tau, segments
        self.masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
        self.budget = [l * tau // segments for l in range(segments + 1)]  # noqa: E741
        zero = next(l for l in range(segments, 0, -1) if self.budget[l] == 0)  # noqa: E741
        one = max(l for l in range(segments + 1) if self.budget[l] == 1)  # noqa: E741
        self.keys = []
        for start in range(segments):
            chain = [(start + k) % segments for k in range(one)]
            for free in chain[zero:]:
                self.keys.append(sum(self.masks[s] for s in chain if s != free))

    def chains(self, diff: int) -> bool:
        """Whether some chain of segments stays within its budgets all the way round."""
        each = [(diff & m).bit_count() for m in self.masks]
        return any(all(d <= self.budget[k + 1] for k, d in enumerate(accumulate(each[(s + k) % self.m] for k in range(self.m))))
                   for s in range(self.m))

    def links(self, fps: np.ndarray, key: int) -> list[tuple[int, int]]:
        """Links among distinct fingerprints that agree on the bits of ``key``.

        A few are compared by chain, then by all bits. Many are tied through their one-bit neighbours within the free bits: two
        of them within two bits of each other share one, and all that share one are within two bits, so a link from each to
        the first that shares it keeps them connected and makes at most one row per value and neighbour.
        """
        if len(fps) <= FEW or self.tau != 2:
            v = [int(x) for x in fps]
            return [(a, b) for i, a in enumerate(v) for b in v[:i] if self.chains(a ^ b) and (a ^ b).bit_count() <= self.tau]
        free = [np.uint64(1 << i) for i in range(BITS) if not key >> i & 1]
        near = np.concatenate([fps, *(fps ^ f for f in free)])
        who = np.tile(np.arange(len(fps)), len(free) + 1)
        order = np.lexsort((who, near))
        near, who = near[order], who[order]
        first = np.maximum.accumulate(np.where(np.append(True, near[1:] != near[:-1]), np.arange(len(near)), 0))
        pairs = np.unique(np.stack([who[first], who], 1)[who[first] != who], axis=0)
        return [(int(fps[a]), int(fps[b])) for a, b in pairs]


def link_fingerprints(fps: DataFrame, tau: int = TAU) -> DataFrame:
    """(a, b) links between distinct fingerprints (column fp) at ``tau`` or fewer differing bits, enough to connect all such.

    A key leaves about 21 bits free, so its group cannot outgrow 2^21 fingerprints (16 MB) whatever the input.
    """
    ring = Ring(tau)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(k))) for k in ring.keys])).alias("slot", "part"))
    groups = keyed.groupBy("slot", "part").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = set()
            for slot, fps_ in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found.update(ring.links(np.sort(fps_.values.to_numpy()).view(np.uint64), ring.keys[slot]))
            if found:
                ends = np.array(list(found), np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return scan(groups.select("slot", "fps"), task, "a long, b long")


def near_duplicates(df: DataFrame, size: int = 3, tau: int = TAU, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per row of ``df``; component_id is the smallest id that links can reach, itself included.

    Equal fingerprints meet once, so copies cost nothing further. A null text has no words; texts without words share
    fingerprint zero, which links like any other. Rows with a null id take part and get their component's smallest id, which is
    null if it has none. Repeated ids are repeated rows. Only the two named columns are read. An empty table gives no rows.
    """
    fps = settle(fingerprints(df, size, id_col, text_col), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min(id_col).alias("_low"))
    roots = settle(components(link_fingerprints(classes.select("fp"), tau)), "roots")
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("_root", F.coalesce("root", "fp"))
    lows = named.groupBy("_root").agg(F.min("_low").alias("component_id"))
    return (fps.join(named.select("fp", "_root").join(lows, "_root").drop("_root"), "fp")
            .select(id_col, "fp", "component_id"))


def simhash_digest(df: DataFrame) -> DataFrame:
    return near_duplicates(df).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, **how) -> DataFrame:
    """The rows of ``df`` whose id is its component's smallest; of rows that repeat an id, all stay. A null id stays."""
    first = near_duplicates(df, **how).filter("doc_id = component_id").select("doc_id").distinct()
    return df.filter("doc_id IS NULL").unionByName(df.join(first, "doc_id", "left_semi").select(*df.columns))
