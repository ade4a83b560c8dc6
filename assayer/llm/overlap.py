"""Texts with similar shingle sets: fingerprints, minima and neighbours connect what is alike, a prefix filter finds the rest, sets decide."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.components import components
from assayer.llm.scan import scan, slices, texts
from assayer.llm.simhash import link_fingerprints, majority
from assayer.session import settle

#: Words per shingle; two sets are similar if they share PART of WHOLE or more of their union.
SIZE, PART, WHOLE = 5, 4, 5
#: About so many texts tell which shingles are frequent. That decides the order of shingles, so the work but not the result.
SAMPLE, OFTEN, FREQUENT = 20_000, 3, 1 << 18
SKETCH, SKETCH_MOST, MINIMA = 4, 1 << 14, 4  # longs at least and at most, numbers
#: Rows of a bucket of shingles, at least and at most; classes of a frequent shingle that are compared in one piece.
FEW_ROWS, MANY_ROWS, PIECE = 1 << 16, 1 << 21, 1 << 19
#: Neighbours that a class of a crowd is compared with in a round, rounds at most; groups up to SMALL + 1 are judged whole before.
NEAR, ROUNDS, SMALL = 4, 2, 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def shingles(text: str, size: int = SIZE) -> np.ndarray:
    """A number of 64 bits for each run of ``size`` words, repeats included; fewer words are one run, no word is none."""
    h = xxhash.xxh64_intdigest
    words = np.array([h(w) for w in text.encode("utf-8", "surrogatepass").translate(_LOWER).split()], np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n if size else 0, size, np.uint64)
    for i in range(size):
        out = (out ^ words[i:i + n]) * _MIX[i % len(_MIX)]
        out ^= out >> np.uint64(29)
    out *= _MIX[1]
    return out ^ out >> np.uint64(32)


def shingle_set(text: str, size: int = SIZE) -> np.ndarray:
    return np.unique(shingles(text, size))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * WHOLE >= PART * (len(a) + len(b) - both)


def sketch(held: np.ndarray) -> np.ndarray:
    """Parities of the shingles by some of their bits: two sets differ in at least as many elements as their sketches in bits.

    There are as many parities as shingles or more, up to twice as many, so that they tell sets of any size apart. Sets that can
    be similar have sketches of one length, or of twice it; a longer one is halved by joining its halves (``_bits_apart``).
    """
    bits = min(max(64 * SKETCH, 1 << max(0, len(held) - 1).bit_length()), 64 * SKETCH_MOST)
    odd = np.bincount((held >> np.uint64(32)).astype(np.int64) & bits - 1, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _bits_apart(a: str, b: str) -> Column:
    """In how many bits two columns of sketches differ; one may be twice as long as the other."""
    def halved(long: str, short: str) -> Column:
        size = F.size(short)
        both = F.zip_with(F.slice(long, F.lit(1), size), F.slice(long, size + 1, size), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(long) > size, both).otherwise(F.col(long))

    return F.aggregate(F.zip_with(halved(a, b), halved(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)


def minima(held: np.ndarray) -> list[int]:
    """The least of the shingles in each of a few orders: similar sets have most of them in common."""
    if not len(held):
        return [0] * MINIMA
    mixed = held ^ held >> np.uint64(31)
    return [int((mixed * (_MIX[i] ^ np.uint64(2 * i))).min()) >> 3 << 2 | i for i in range(MINIMA)]


def _frequent(df: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Shingles that are frequent in a sample of ``df``, rising, in how many of its texts they are, and the sample's share."""
    share = min(1.0, SAMPLE / max(1, df.count()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            sets = [shingle_set(t) for t in texts(b, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    some = df.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    found = (scan(some, task, "h long").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN)
             .orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow())
    h, n = (found.column(i).to_numpy() for i in range(2))
    h = h.view(np.uint64)
    order = np.argsort(h)
    return h[order], n[order], share


def _times(often: np.ndarray, times: np.ndarray, held: np.ndarray) -> np.ndarray:
    """In how many texts of the sample each shingle is; 0 for those that are not frequent."""
    if not len(often):
        return np.zeros(len(held), np.int64)
    at = np.minimum(np.searchsorted(often, held), len(often) - 1)
    return np.where(often[at] == held, times[at], 0)


def _lists(many: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, many)]), pa.int32()), pa.array(np.concatenate(many)))


def _classes(df: DataFrame, shared) -> DataFrame:
    """(doc_id, cls, n, prefix, sketch, minima, fp) per row: a digest of its shingle set, the set's size, of its shingles, frequent
    ones last, as many as a set must share one of to be similar, and what connects likely pairs."""
    kind = dict(df.dtypes)["doc_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times, _ = shared.value
        for b in slices(batches, "text", 2 << 20):
            cols: list[list] = [[] for _ in range(6)]
            for t in texts(b, "text"):
                runs = shingles(t)
                s = np.unique(runs)
                fp = majority(runs, np.array([0]))[:1].view(np.int64)[0] if len(runs) else 0
                first = s[np.lexsort((s, _times(often, times, s)))][:len(s) + PART * -len(s) // WHOLE + 1] if len(s) else s
                for c, v in zip(cols, (xxhash.xxh64_intdigest(s.tobytes()), len(s), first.view(np.int64), sketch(s), np.array(minima(s), np.int64), int(fp)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(cols[0], np.uint64).view(np.int64)), pa.array(cols[1], pa.int32()), *map(_lists, cols[2:5]), pa.array(cols[5], pa.int64())],
                                             ["doc_id", "cls", "n", "prefix", "sketch", "minima", "fp"])

    return scan(df.select("doc_id", "text"), task, f"doc_id {kind}, cls long, n int, prefix array<long>, sketch array<long>, minima array<long>, fp long")


def _likely(classes: DataFrame) -> DataFrame:
    """(a, b) pairs that connect most of what is similar, at most a few per class: classes that share a minimum with the least class
    that has it, and those whose SimHash fingerprints link."""
    least = classes.select("cls", F.explode("minima").alias("m"))
    leads = least.groupBy("m").agg(F.min("cls").alias("a"))
    by_minimum = least.join(leads, "m").select("a", F.col("cls").alias("b"))
    fps = settle(classes.groupBy("fp").agg(F.min("cls").alias("lead")), "fingerprints")
    same = classes.join(fps, "fp").select(F.col("lead").alias("a"), F.col("cls").alias("b"))
    ends = fps.select(F.col("fp").alias("a"), F.col("lead").alias("x")), fps.select(F.col("fp").alias("b"), F.col("lead").alias("y"))
    linked = link_fingerprints(fps.select("fp")).join(ends[0], "a").join(ends[1], "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    every = by_minimum.unionByName(same).unionByName(linked).filter("a <> b")
    return every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


_PLACE = np.dtype([("h", "<u8"), ("unit", "<i8"), ("cls", "<i8"), ("root", "<i8"), ("n", "<i4"), ("i", "<i4"), ("piece", "<i4")])


#: A place with its class's sketch, folded to FOLDED longs.
FOLDED = 2 * SKETCH
_KNOWN = np.dtype([*_PLACE.descr, ("sketch", "<u8", (FOLDED,))])


def _packed(rows: np.ndarray) -> bytes:
    """Places column by column, a root as what it differs in from its class, so that a shuffle compresses them well."""
    return b"".join(np.ascontiguousarray(rows["root"] ^ rows["cls"] if c == "root" else rows[c]).tobytes() for c in rows.dtype.names)


def _unpacked(data: bytes, kind: np.dtype = _PLACE) -> np.ndarray:
    out, at = np.empty(len(data) // kind.itemsize, kind), 0
    for c in kind.names:
        out[c] = np.frombuffer(data, kind[c].base, len(out) * (kind[c].itemsize // kind[c].base.itemsize), at).reshape(out[c].shape)
        at += len(out) * kind[c].itemsize
    out["root"] ^= out["cls"]
    return out


def _dealt(rows: DataFrame, places, buckets: int) -> DataFrame:
    """(bucket, data) of the places that ``places(batch)`` makes of the batches of ``rows``, bucket by bucket."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for out in places(b):
                bucket = ((out["h"] ^ out["unit"].astype(np.uint64) * _MIX[3]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, out = bucket[order], out[order]
                starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
                ends = np.append(starts[1:], len(out))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array([_packed(out[x:y]) for x, y in zip(starts, ends, strict=True)], pa.binary())], ["bucket", "data"])

    return scan(rows, task, "bucket long, data binary").repartition("bucket").sortWithinPartitions("bucket")


def _each_bucket(batches: Iterator[pa.RecordBatch], kind: np.dtype = _PLACE) -> Iterator[np.ndarray]:
    now, held = None, []
    for b in batches:
        for bucket, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if bucket != now and held:
                yield np.concatenate(held)
                held = []
            now = bucket
            held.append(_unpacked(data, kind))
    if held:
        yield np.concatenate(held)


def _crowds(classes: DataFrame, root: DataFrame, shared, buckets: int) -> DataFrame:
    """The places whose shingle is in prefixes of classes of different roots, but for those that fit no other of theirs.

    Shingles meet in buckets of bounded size. A shingle that the sample says is in more than PIECE classes is met piece by
    piece: each class goes to the units that hold its piece, and a unit compares two pieces. Roots only grow together, so what is
    left out here is left out for good.
    """
    rows = classes.select("cls", "n", "prefix").join(root, "cls", "left").select("cls", "n", "prefix", F.coalesce("root", "cls").alias("root"))

    def placed(whole: pa.RecordBatch) -> Iterator[np.ndarray]:
        often, times, share = shared.value
        for b in (whole.slice(a, 256) for a in range(0, whole.num_rows, 256)):
            lists = b.column(2)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            who = np.repeat(np.arange(b.num_rows), size)
            out = np.zeros(len(who), _PLACE)
            out["h"] = lists.flatten().to_numpy().view(np.uint64)
            out["i"] = np.arange(len(who)) - (np.cumsum(size) - size)[who]
            for c, k in (("cls", 0), ("n", 1), ("root", 3)):
                out[c] = b.column(k).to_numpy()[who]
            pieces = np.ceil(_times(often, times, out["h"]) / share / PIECE).astype(np.int64)
            crowded = np.flatnonzero(pieces > 1)
            if len(crowded):
                more = []
                for r, k in zip(out[crowded], pieces[crowded].tolist(), strict=True):
                    own = int(r["cls"]) % k
                    for other in range(k):
                        r["piece"], r["unit"] = own, min(own, other) * k + max(own, other)
                        more.append(r.copy())
                out = np.concatenate([np.delete(out, crowded), np.array(more, _PLACE)])
            yield out

    once = _kept(_dealt(rows, placed, buckets), _PLACE)
    none = F.array_repeat(F.lit(0).cast("long"), FOLDED)
    folded = F.aggregate(F.sequence(F.lit(1), F.size("sketch"), F.lit(FOLDED)), none, lambda t, i: F.zip_with(
        t, F.slice("sketch", i, F.lit(FOLDED)), lambda x, y: x.bitwiseXOR(F.coalesce(y, F.lit(0).cast("long")))))
    return _kept(_redealt(once.join(classes.select("cls", folded.alias("sketch")), "cls"), root, buckets), _KNOWN)


def _kept(dealt: DataFrame, kind: np.dtype) -> DataFrame:
    """Places of ``_crowd``, a row each."""
    names = [c for c in kind.names if c != "root"]

    def crowd(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _each_bucket(batches, kind):
            kept = _crowd(rows)
            for a in range(0, len(kept), FEW_ROWS):
                cols = [np.ascontiguousarray(kept[c][a:a + FEW_ROWS]) for c in names]
                cols = [pa.array(v.view("<i8") if v.dtype == np.uint64 else v) if v.ndim == 1 else _lists(list(v.view("<i8"))) for v in cols]
                yield pa.RecordBatch.from_arrays(cols, names)

    kinds = {"n": "int", "i": "int", "piece": "int", "sketch": "array<long>"}
    return scan(dealt, crowd, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names))


def _redealt(rows: DataFrame, root: DataFrame, buckets: int) -> DataFrame:
    """Places with sketches, a row each, dealt into buckets again with their present roots."""
    names = [c for c in _KNOWN.names if c != "root"]

    def placed(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        out = np.zeros(b.num_rows, _KNOWN)
        for k, c in enumerate([*names, "root"]):
            col = b.column(k).flatten() if c == "sketch" else b.column(k)
            out[c] = col.to_numpy().view(_KNOWN[c].base).reshape(out[c].shape)
        yield out

    return _dealt(rows.join(root, "cls", "left").select(*names, F.coalesce("root", "cls").alias("root")), placed, buckets)


def _reached(crowds: DataFrame, root: DataFrame, buckets: int, turn: int | None = None) -> DataFrame:
    """(a, b) classes of different roots that share a shingle of their prefixes and may be similar by their sizes, its places and
    their sketches; in a ``turn`` only NEAR neighbours of each class, others each turn, so no more rows than NEAR times the places."""
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _each_bucket(batches, _KNOWN):
            yield from _pairs(rows) if turn is None else _neighbours(rows, turn)

    return scan(_redealt(crowds, root, buckets), met, "a long, b long").distinct()


def _met(classes: DataFrame, root: DataFrame, shared, buckets: int) -> DataFrame:
    """(a, b) classes of different roots that may be similar, all of them."""
    return _reached(_crowds(classes, root, shared, buckets), root, buckets)


def _in_order(rows: np.ndarray, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places of the groups that hold different roots, and the number of its group for each; a group goes by size. Those of one
    size are mixed, otherwise for each shingle and turn, so that a class has other neighbours from one to the next."""
    rows = rows[np.lexsort(((rows["cls"].view(np.uint64) ^ rows["h"]) * _MIX[0] ^ rows["cls"].view(np.uint64) * _MIX[1 + turn], rows["n"], rows["unit"], rows["h"]))]
    new = np.append(True, (rows["h"][1:] != rows["h"][:-1]) | (rows["unit"][1:] != rows["unit"][:-1]))[:len(rows)]
    starts = np.flatnonzero(new)
    if not len(starts):
        return rows, starts
    mixed = np.minimum.reduceat(rows["root"], starts) != np.maximum.reduceat(rows["root"], starts)
    group = np.cumsum(new) - 1
    return rows[mixed[group]], group[mixed[group]]


def _fit(rows: np.ndarray, group: np.ndarray, away: int) -> np.ndarray:
    """Whether each place from the ``away``-th on may be of a similar pair with the one so far before it: of one group, of
    different roots, by their sizes, by what of both sets is left from the shingle on and by their sketches, where they have them."""
    x, y = rows[away:], rows[:-away]
    n, left = (x["n"].astype(np.int64), y["n"].astype(np.int64)), np.minimum(x["n"] - x["i"], y["n"] - y["i"]).astype(np.int64)
    ok = ((group[away:] == group[:-away]) & (x["root"] != y["root"]) & (PART * n[0] <= WHOLE * n[1])
          & (left * (PART + WHOLE) >= PART * (n[0] + n[1])))
    if "sketch" in rows.dtype.names:
        at = np.flatnonzero(ok)
        ok[at] = _folded_apart(rows, at + away, at) * (PART + WHOLE) <= (WHOLE - PART) * (n[0] + n[1])[at]
    return ok


def _crowd(rows: np.ndarray) -> np.ndarray:
    """The places of a bucket that may be of a similar pair of different roots; of groups over SMALL + 1 all are kept."""
    rows, group = _in_order(rows)
    if not len(rows):
        return rows
    new = np.append(True, group[1:] != group[:-1])
    kept = (np.diff(np.append(np.flatnonzero(new), len(rows))) > SMALL + 1)[np.cumsum(new) - 1]
    for away in range(1, min(SMALL + 1, len(rows))):
        ok = _fit(rows, group, away)
        kept[away:] |= ok
        kept[:-away] |= ok
    return rows[kept]


def _neighbours(rows: np.ndarray, turn: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different roots that can be similar, of each place and the NEAR before it in its group."""
    rows, group = _in_order(rows, turn)
    for away in range(1, min(NEAR + 1, len(rows))):
        at = np.flatnonzero(_fit(rows, group, away))
        if len(at):
            x, y = rows["cls"][at + away], rows["cls"][at]
            both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def _folded_apart(m: np.ndarray, x: int | np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits at least the sketches of some places differ from that of one, or from others', folded to the length of the shorter."""
    apart = m["sketch"][y] ^ m["sketch"][x]
    half = np.bitwise_count(apart[:, :SKETCH] ^ apart[:, SKETCH:]).sum(axis=1, dtype=np.int64)
    short = 64 * SKETCH  # sets up to this size have a sketch of half the length
    return np.where((m["n"][y] > short) == (m["n"][x] > short), np.bitwise_count(apart).sum(axis=1, dtype=np.int64), half)


def _pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of different roots in the groups of a bucket that can be similar, if the shingle is the first one they share."""
    rows = rows[np.lexsort((rows["n"], rows["unit"], rows["h"]))]
    new = np.append(True, (rows["h"][1:] != rows["h"][:-1]) | (rows["unit"][1:] != rows["unit"][:-1]))
    starts = np.flatnonzero(new)
    if not len(starts) or len(starts) == len(rows):
        return
    mixed = np.flatnonzero(np.minimum.reduceat(rows["root"], starts) != np.maximum.reduceat(rows["root"], starts))
    ends = np.append(starts[1:], len(rows))
    known = "sketch" in rows.dtype.names
    out, held = [], 0
    for g in mixed.tolist():
        m = rows[starts[g]:ends[g]]
        n, left = m["n"].astype(np.int64), (m["n"] - m["i"]).astype(np.int64)
        pieces = len(np.unique(m["piece"])) > 1
        # Each with those before it, which are as large or smaller: by size from the first that is large enough.
        first = np.searchsorted(n, -(-PART * n // WHOLE))
        for x in range(1, len(m)):
            y = np.arange(first[x], x)
            if not len(y):
                continue
            ok = (m["root"][y] != m["root"][x]) & (np.minimum(left[y], left[x]) * (PART + WHOLE) >= PART * (n[y] + n[x]))
            if pieces:  # those of one piece meet in a unit of their own
                ok &= m["piece"][y] != m["piece"][x]
            y = y[ok]
            if known and len(y):
                y = y[_folded_apart(m, x, y) * (PART + WHOLE) <= (WHOLE - PART) * (n[y] + n[x])]
            if len(y):
                out.append(np.stack([np.minimum(m["cls"][y], m["cls"][x]), np.maximum(m["cls"][y], m["cls"][x])]))
                held += len(y)
                if held > 1 << 18:
                    both = np.unique(np.concatenate(out, axis=1), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])
                    out, held = [], 0
    if out:
        both = np.unique(np.concatenate(out, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that can be similar by their sizes and sketches."""
    side = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    both = F.col("na") + F.col("nb")
    near = (WHOLE * F.least("na", "nb") >= PART * F.greatest("na", "nb")) & (_bits_apart("sa", "sb") * (PART + WHOLE) <= (WHOLE - PART) * both)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(near).select("a", "b")


def _verified(df: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose sets are similar, by the sets themselves; a set is made again from its text and shuffled, never kept."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    # Settled, as elsewhere, so that its true size is known when Spark chooses how to join the texts with it.
    lead = settle(classes.join(asked, "cls").select("doc_id", "cls"), "asked")
    rows = df.filter("doc_id IS NOT NULL").select("doc_id", "text").join(lead.filter("doc_id IS NOT NULL"), "doc_id")
    rows = rows.unionByName(df.filter("doc_id IS NULL").select("doc_id", "text").withColumn("cls", F.lit(None).cast("long")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            found = [shingle_set(t) for t in texts(b, "text")]
            own = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in found], np.uint64).view(np.int64).tolist()
            at = [i for i, c in enumerate(b.column(2).to_pylist()) if c is None or c == own[i]]
            yield pa.RecordBatch.from_arrays([pa.array([own[i] for i in at], pa.int64()), pa.array([found[i].tobytes() for i in at], pa.binary())], ["cls", "shingles"])

    kept = scan(rows, sets, "cls long, shingles binary").dropDuplicates(["cls"])
    # The larger class meets its pairs once, whatever their number.
    of = settle(kept, "sets")
    side = lambda c: of.select(F.col("cls").alias(c), F.col("shingles").alias(f"s{c}"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(iter([whole]), "sa"):
                ok = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                               for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(ok)

    return scan(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb"), task, "a long, b long")


def similar_groups(df: DataFrame) -> DataFrame:
    """(doc_id, component_id) per row of ``df``; component_id is the smallest id reached over pairs of texts that share four fifths
    or more of all their five-word shingles.

    A text is known by its set of shingles, so copies cost nothing further. Pairs that SimHash fingerprints or common minima make
    likely, then pairs of neighbours in crowds of a common shingle, connect nearly all that is similar, at most a few per class and
    shingle; last come all others that are not connected yet and meet in a prefix.
    Similar sets share one of their first fifth of shingles in any order that is the same for all; here frequent shingles come
    last. All pairs of either pass are decided by whole sets, so the result is that of all pairs. A null text has no words; all
    texts without words are alike. Null ids take part and get their component's smallest id. Other columns are not read. An empty
    table gives no rows.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(_frequent(df))  # at most FREQUENT numbers
    rows = settle(_classes(df, shared), "shingles")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"]
    classes = settle(rows.groupBy("cls").agg(least.alias("doc_id"), *[F.first(c).alias(c) for c in ("n", "prefix", "sketch", "minima", "fp")]), "classes")
    links = settle(_verified(df, classes, settle(_plausible(_likely(classes), classes), "likely")), "similar")
    root = settle(components(links).select(F.col("node").alias("cls"), "root"), "roots")
    # What is alike in a crowd is connected through a few neighbours a round; else all its pairs would meet below.
    places = classes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    tasks = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    buckets = int(max(1, -(-places // MANY_ROWS), min(tasks, -(-places // FEW_ROWS))))
    crowds = settle(_crowds(classes, root, shared, buckets), "crowds")
    for turn in range(ROUNDS):
        found = settle(_verified(df, classes, settle(_plausible(_reached(crowds, root, buckets, turn), classes), "near")), "similar")
        if found.isEmpty():
            break
        links = links.unionByName(found)
        root = settle(components(links).select(F.col("node").alias("cls"), "root"), "roots")
    rest = settle(_plausible(_reached(crowds, root, buckets), classes), "met")
    if not rest.isEmpty():
        links = links.unionByName(settle(_verified(df, classes, rest), "similar"))
        root = settle(components(links).select(F.col("node").alias("cls"), "root"), "roots")
    named = classes.select("cls", "doc_id").join(root, "cls", "left").withColumn("_root", F.coalesce("root", "cls"))
    lows = named.groupBy("_root").agg(F.min("doc_id").alias("component_id"))
    return rows.select("doc_id", "cls").join(named.select("cls", "_root").join(lows, "_root"), "cls").select("doc_id", "component_id")


def keep_first(df: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id is its component's smallest; of rows that repeat an id, all stay. A null id stays."""
    first = settle(similar_groups(df).filter("doc_id = component_id").select("doc_id").distinct(), "first")
    return df.filter("doc_id IS NULL").unionByName(df.join(first, "doc_id", "left_semi").select(*df.columns))
