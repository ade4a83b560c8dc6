"""Repeated passages: shared k-mer seeds, collinear chains through a Fenwick tree, aligned word by word."""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.numbering import numbered
from assayer.llm.passages import KMER, MARGIN, MIN_WORDS, SPAN, align, chains, keys, word_hashes, worth_following
from assayer.llm.scan import Recent, scan, slices, texts
from assayer.session import settle

#: Words of texts whose seeds meet in one bucket, at least and at most; buckets are cut by size, not by key.
FEW_WORDS, MANY_WORDS = 1 << 18, 1 << 24
#: A seed in more texts of one slice than this goes on as its first text alone; the others are tied to that one and to each other.
HOT_IN_SLICE, HOT_REMEMBERED = 8, 1 << 16
#: Places of a seed in a text that are linked with each other.
FEW_PLACES = 4
_WORD = re.compile(r"[^ \t-\r]+")


_LINK = np.dtype([("doc", "<i8"), ("src", "<i8"), ("pos", "<i4"), ("spos", "<i4"), ("reach", "<i4")])
_SEED = np.dtype([("h", "<u8"), ("doc", "<i8"), ("pos", "<i4"), ("reach", "<i4")])


def _pack(rows: np.ndarray) -> bytes:
    """Seeds as columns: 48 bits of the hash, for a bucket tells more of it, and what compresses well, compressed. A few words far
    apart that look alike make links that the alignment drops."""
    rows = rows[np.lexsort((rows["pos"], rows["doc"]))]
    low = rows["doc"][:1].astype("<i8").tobytes()
    rest = np.diff(rows["doc"], prepend=rows["doc"][0]).astype("<i8").tobytes() + rows["pos"].astype("<i4").tobytes() + np.minimum(rows["reach"], 255).astype(np.uint8).tobytes()
    hashes = np.ascontiguousarray(rows["h"]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return len(rows).to_bytes(4, "little") + low + hashes + zstandard.ZstdCompressor(level=1).compress(rest)


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    rows = np.zeros(n, _SEED)
    h = np.zeros((n, 8), np.uint8)
    h[:, :6] = np.frombuffer(data, np.uint8, 6 * n, 12).reshape(-1, 6)
    rest = zstandard.ZstdDecompressor().decompress(data[12 + 6 * n:])
    rows["h"] = h.view("<u8").ravel()
    rows["doc"] = int.from_bytes(data[4:12], "little", signed=True) + np.cumsum(np.frombuffer(rest, "<i8", n))
    rows["pos"], rows["reach"] = np.frombuffer(rest, "<i4", n, 8 * n), np.frombuffer(rest, np.uint8, n, 12 * n)
    return rows


def _packed(kind: int, bucket: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """One row (kind, bucket, data) per bucket: seeds (0) or links (1)."""
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], rows[order]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(rows))
    made = [rows[a:b].tobytes() if kind else _pack(rows[a:b]) for a, b in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), kind, np.int32)), pa.array(bucket[starts] if len(bucket) else bucket), pa.array(made, pa.binary())], ["kind", "bucket", "data"])


def _links(rows: np.ndarray, src: np.ndarray, spos: np.ndarray) -> np.ndarray:
    """Links of seeds with places of other texts; those of earlier texts with later ones are turned."""
    out = np.zeros(len(rows), _LINK)
    turned = rows["doc"] < src
    out["doc"], out["src"] = np.where(turned, src, rows["doc"]), np.where(turned, rows["doc"], src)
    out["pos"], out["spos"], out["reach"] = np.where(turned, spos, rows["pos"]), np.where(turned, rows["pos"], spos), rows["reach"]
    return out[out["doc"] != out["src"]]


def _ties(rows: np.ndarray) -> np.ndarray:
    """Links of every place of a seed in a text with places in the first text that has the seed and in the one before it.

    Where both texts hold it a few times, all their places are linked, else those of equal number, and the rest with the last
    one. ``rows``: seeds in order of hash, text and place.
    """
    if not len(rows):
        return np.zeros(0, _LINK)
    h, doc, pos = rows["h"], rows["doc"], rows["pos"]
    fresh = np.append(True, h[1:] != h[:-1])
    other = fresh | np.append(True, doc[1:] != doc[:-1])
    starts = np.flatnonzero(other)  # first place of a seed in a text
    count = np.diff(np.append(starts, len(h)))
    group = np.cumsum(other) - 1
    lead = np.maximum.accumulate(np.where(fresh[starts], np.arange(len(starts)), 0))[group]
    nth = np.arange(len(h)) - starts[group]
    out = []
    for of, late in ((lead, lead < group), (group - 1, group - 1 > lead)):
        few = late & (count[group] <= FEW_PLACES) & (count[of] <= FEW_PLACES)
        for j in range(FEW_PLACES):
            at = np.flatnonzero(few & (count[of] > j))
            out.append(_links(rows[at], doc[starts[of[at]]], pos[starts[of[at]] + j]))
        at = np.flatnonzero(late & ~few)
        out.append(_links(rows[at], doc[starts[of[at]]], pos[starts[of[at]] + np.minimum(nth[at], count[of[at]] - 1)]))
    return np.concatenate(out)


def _met(words: DataFrame, buckets: int) -> DataFrame:
    """(kind, bucket, data): packed links by the bucket of their later text.

    Seeds meet by hash in buckets of bounded size. A seed frequent in a slice of texts, or in one before it in the same task,
    goes on as one text; the others are tied to that one and among themselves, so under the most frequent seed a few rows per task
    are gathered.
    """
    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = Recent(HOT_REMEMBERED)  # seed: (text, first place, last place)
        for b in slices(batches, "words", 4 << 20):
            if not b.num_rows:
                continue
            data = b.column(1).to_pylist()
            sizes = np.array([len(d) // 4 for d in data])
            h, who, pos, reach = keys(np.frombuffer(b"".join(data), np.uint32), sizes)
            rows = np.zeros(len(h), _SEED)
            rows["h"], rows["doc"], rows["pos"], rows["reach"] = h, b.column(0).to_numpy()[who], pos, reach
            rows = rows[np.lexsort((rows["pos"], rows["doc"], rows["h"]))]
            if not len(rows):
                continue
            fresh = np.append(True, rows["h"][1:] != rows["h"][:-1])
            other = fresh | np.append(True, rows["doc"][1:] != rows["doc"][:-1])
            begin = np.flatnonzero(fresh)
            held = np.add.reduceat(other.astype(np.int64), begin)
            seed_of = np.cumsum(fresh) - 1
            crowded = (held > HOT_IN_SLICE)[seed_of]
            first_doc = rows["doc"][begin][seed_of]
            if crowded.any():
                yield _packed(1, *_by_doc(_ties(rows[crowded]), buckets))
                known, leads = [], rows[crowded & (rows["doc"] == first_doc)]
                cut = np.flatnonzero(np.append(True, leads["h"][1:] != leads["h"][:-1]))
                stop = np.append(cut[1:], len(leads))
                stays = np.ones(len(leads), bool)
                for a, z in zip(cut.tolist(), stop.tolist(), strict=True):
                    key, own = int(leads["h"][a]), (int(leads["doc"][a]), int(leads["pos"][a]), int(leads["pos"][z - 1]))
                    before = hot.get(key)
                    if before is None:
                        hot.put(key, own)
                    else:
                        stays[a:z] = False
                        known.append((a, z, before))
                if known:
                    at = np.concatenate([np.arange(a, z) for a, z, _ in known])
                    src, lo, hi = (np.repeat([x[i] for _, _, x in known], [z - a for a, z, _ in known]) for i in range(3))
                    yield _packed(1, *_by_doc(np.concatenate([_links(leads[at], src, lo), _links(leads[at], src, hi)]), buckets))
                rows = np.concatenate([rows[~crowded], leads[stays]])
            yield _packed(0, ((rows["h"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64), rows)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for kind, bucket, data in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if kind:
                    yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([bucket], pa.int64()), pa.array([data], pa.binary())], ["kind", "bucket", "data"])
                    continue
                if bucket != now and held:
                    yield from _tied(held, buckets)
                    held = []
                now = bucket
                held.append(data)
        if held:
            yield from _tied(held, buckets)

    schema = "kind int, bucket bigint, data binary"
    return scan(_dealt(scan(words.select("tid", "words"), planted, schema), ["kind"]), met, schema)


def _by_doc(links: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return links["doc"] % buckets, links


def _tied(held: list[bytes], buckets: int) -> Iterator[pa.RecordBatch]:
    rows = np.concatenate([_unpack(d) for d in held])
    rows = rows[np.argsort(rows["h"], kind="stable")]
    # Most seeds are in one place only.
    shared = np.append(rows["h"][1:] == rows["h"][:-1], False)
    rows = rows[shared | np.append(False, shared[:-1])]
    rows = rows[np.lexsort((rows["pos"], rows["doc"], rows["h"]))]
    links = _ties(rows)
    if len(links):
        yield _packed(1, *_by_doc(links, buckets))


def _dealt(rows: DataFrame, order: list[str]) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", *order)


_CHAIN = ["doc", "src", "lo", "hi", "slo", "shi", "p", "s"]
_CHAIN_KINDS = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.list_(pa.int32()), pa.list_(pa.int32())]


def _chained(links: DataFrame) -> DataFrame:
    """(doc, src, lo, hi, slo, shi, p, s): a chain a row, with the places of its seeds in the words it needs of both texts."""
    def told(held: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.unique(np.frombuffer(b"".join(held), _LINK)) if held else np.zeros(0, _LINK)
        if not len(rows):
            return
        # A pair is worth a look if its seeds and runs span enough words.
        starts = np.flatnonzero(np.append(True, (rows["doc"][1:] != rows["doc"][:-1]) | (rows["src"][1:] != rows["src"][:-1])))
        size = np.diff(np.append(starts, len(rows)))
        span = np.maximum.reduceat(rows["pos"] + rows["reach"], starts) - np.minimum.reduceat(rows["pos"], starts)
        out: list[list] = [[] for _ in _CHAIN]
        for a in np.flatnonzero(span >= SPAN).tolist():
            pair = rows[starts[a]:starts[a] + size[a]]
            at = list(zip(pair["pos"].tolist(), pair["spos"].tolist(), strict=True))
            reach: dict[tuple[int, int], int] = {}
            for m, r in zip(at, pair["reach"].tolist(), strict=True):
                reach[m] = max(r, reach.get(m, 0))
            for chain in chains(at):
                if worth_following(chain, reach):
                    (p, s), (q, t) = chain[0], chain[-1]
                    lo, slo = max(0, p - MARGIN), max(0, s - MARGIN)
                    row = (int(pair["doc"][0]), int(pair["src"][0]), lo, q + KMER + MARGIN, slo, t + KMER + MARGIN, [x - lo for x, _ in chain], [y - slo for _, y in chain])
                    for c, v in zip(out, row, strict=True):
                        c.append(v)
            if len(out[0]) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, _CHAIN_KINDS, strict=True)], _CHAIN)
                out = [[] for _ in _CHAIN]
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, _CHAIN_KINDS, strict=True)], _CHAIN)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for bucket, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if bucket != now:
                    yield from told(held)
                    now, held = bucket, []
                held.append(data)
        yield from told(held)

    return scan(_dealt(links, []), task, "doc bigint, src bigint, lo int, hi int, slo int, shi int, p array<int>, s array<int>")


def _aligned(found: DataFrame, words: DataFrame) -> DataFrame:
    """(doc, src, start, end, source_start, source_end, matched, similarity) of the chains that hold a passage."""
    # Most texts have no chain; the words of the others are all that is moved.
    needed = found.select(F.explode(F.array("doc", "src")).alias("tid")).distinct()
    few = settle(words.join(needed, "tid", "left_semi").select("tid", "words"), "chained-words")
    part = lambda low, high: F.substring("words", 4 * F.col(low) + 1, 4 * (F.col(high) - F.col(low)))
    one = found.join(few.withColumnRenamed("tid", "doc"), "doc").select("doc", "src", "lo", "slo", "shi", "p", "s", part("lo", "hi").alias("a"))
    ready = one.join(few.withColumnRenamed("tid", "src"), "src").select("doc", "src", "lo", "slo", "p", "s", "a", part("slo", "shi").alias("b"))
    names = ["doc", "src", "start", "end", "source_start", "source_end", "matched", "similarity"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.float64()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "a", 1 << 20):
            rows = []
            for doc, src, lo, slo, p, s, a, b in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                anchors = [(i, j) for i, j in zip(p, s, strict=True) if (x[i:i + KMER] == y[j:j + KMER]).all()]  # not if hashes of seeds collide
                for i, e, j, f, matched in align(x, y, anchors) if anchors else ():
                    rows.append((doc, src, lo + i, lo + e, slo + j, slo + f, matched, 2 * matched / (e - i + f - j)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return scan(ready, task, "doc bigint, src bigint, start int, end int, source_start int, source_end int, matched int, similarity double").distinct()


def text_key(text: str | Column = "text") -> Column:
    """What tells texts under one id apart."""
    return F.xxhash64(text)


def repeated_passages(df: DataFrame) -> DataFrame:
    """(doc_id, text_key, source_id, start, end, source_start, source_end, matched, similarity) per repeated passage, in words.

    A passage of the text ``text_key`` of ``doc_id`` repeats one of a text of ``source_id`` that comes before it in the order of ids,
    if their aligned words agree to SIMILARITY (twice the matched words by the words of both) in MIN_MATCHED words or more,
    which is what a passage of MIN_WORDS words that similar has. Words are divided by white space and compared lower-cased (A-Z),
    as numbers of 32 bits. Of equal texts only the one of the smallest id is searched; the others repeat it as a whole, if they
    have MIN_WORDS words. Each seed of a passage is tied to the first text that has it and to the one before, so of many copies
    all but the first are found without comparing all pairs; words at the ends of a passage that only yet another text shares
    are not reported with it. Repeats inside one text don't count.

    Rows with a null id and null or short texts have no passage. Rows that repeat an id and text count once; different texts under
    one id are texts of their own. Other columns are not read. An empty table gives no rows.
    """
    spark = df.sparkSession
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("text_key"), F.md5("text").alias("m")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    known = settle(docs.groupBy("doc_id", "text_key", "m").agg(F.count(F.lit(1)).alias("rows")), "texts")
    leads = known.groupBy("m").agg(F.min(F.struct("doc_id", "text_key")).alias("x")).select("m", "x.*")
    ids = settle(numbered(leads, [], [F.col("doc_id").asc(), F.col("m").asc()], "tid", "texts"), "text-ids")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            made = [word_hashes(t) for t in texts(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(w) for w in made], pa.int32()), pa.array([w.tobytes() for w in made], pa.binary())], names)

    names = ["doc_id", "text_key", "n", "words"]
    words = scan(docs.select("doc_id", "text_key", "text"), hashed, "doc_id bigint, text_key bigint, n int, words binary")
    words = words.join(ids.select("doc_id", "text_key", "tid"), ["doc_id", "text_key"]).select("tid", "n", "words")
    if not known.filter("rows > 1").isEmpty():  # rows that repeat an id and text
        words = words.dropDuplicates(["tid"])
    words = settle(words, "words")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    buckets = int(max(1, -(-size // MANY_WORDS), min(least, -(-size // FEW_WORDS))))
    found = _aligned(settle(_chained(_met(words, buckets)), "chains"), words)
    later, earlier = ids.select(F.col("tid").alias("doc"), "doc_id", "text_key"), ids.select(F.col("tid").alias("src"), F.col("doc_id").alias("source_id"))
    told = ["doc_id", "text_key", "source_id", "start", "end", "source_start", "source_end", "matched", "similarity"]
    parts = found.join(later, "doc").join(earlier, "src").select(*told)
    long = ids.join(words.select("tid", "n").filter(F.col("n") >= MIN_WORDS), "tid").select("m", F.col("doc_id").alias("source_id"), "n")
    copies = known.join(long, "m").filter("doc_id <> source_id")
    zero, n = F.lit(0), F.col("n")
    return parts.unionByName(copies.select("doc_id", "text_key", "source_id", zero.alias("start"), n.alias("end"), zero.alias("source_start"), n.alias("source_end"),
                                           n.alias("matched"), F.lit(1.0).alias("similarity")))


def cut_passages(df: DataFrame, passages: DataFrame) -> DataFrame:
    """``df`` with the passages cut out of the texts (and what is left joined by a line break); other rows and columns as they were.

    A row is cut if it has the passage's id and text; so rows that repeat an id with another text stay whole. A column ``n_chars`` is
    set to the new length where a text was cut. Columns may have any names. Null ids and texts stay, an empty table gives no rows.
    """
    free = lambda name: name if name not in df.columns else free(f"_{name}")
    id_, key, spans = free("_id"), free("_text_key"), free("_spans")
    found = passages.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias(spans)).select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), spans)
    found = settle(found, "spans")
    joined = df.join(found, (F.col("doc_id") == F.col(id_)) & (text_key() == F.col(key)), "left").drop(id_, key)
    out = df.columns
    at = out.index("text")
    n_at = out.index("n_chars") if "n_chars" in out else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            cuts = b.column(len(out)).to_pylist()
            cut = [t if not s else cut_text(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(b.column(at).to_pylist(), cuts, strict=True)]
            cols = [b.column(i) for i in range(len(out))]
            cols[at] = pa.array(cut, cols[at].type)
            if n_at is not None:
                cols[n_at] = pa.array([len(t) if s else n for n, s, t in zip(cols[n_at].to_pylist(), cuts, cut, strict=True)], cols[n_at].type)
            yield pa.RecordBatch.from_arrays(cols, out)

    return joined.mapInArrow(task, df.schema)


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (start, end)."""
    at = [m.span() for m in _WORD.finditer(text)]
    parts, done = [], 0
    for a, b in sorted(spans):
        if a > done:
            parts.append(text[at[done][0] if done else 0:at[a - 1][1]])
        done = max(done, b)
    if done < len(at):
        parts.append(text[at[done][0] if done else 0:])
    return "\n".join(parts)
