"""Token ids in files of Simple-8b words.

A file is Parquet; each row is a block: its part and the ids before it there, documents in order with their ends, and one stream of 64-bit little-endian words. The
four high bits of a word select how many ids of what width share its other 60 bits, lowest id first. Selector 0 is the escape:
the next word is one id in full. Ids of a document may continue in its next word but never in another block.
"""
from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from assayer.llm.bpe import pieces
from assayer.llm.scan import scan, slices, texts
from assayer.session import settle, shared_dir

#: Selectors 1 to 14: ids a word and their bits.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE, BLOCK_IDS = 0, 1 << 16
PIECES = 1_000_000
SCHEMA = "part int, before long, doc_ids array<{kind}>, ends array<long>, n_ids long, words binary"


def pack(ids: np.ndarray) -> bytes:
    """Simple-8b, each word as full as its next ids allow."""
    ids = np.ascontiguousarray(ids)
    n = len(ids)
    if not n:
        return b""
    selector, count = np.zeros(n, np.uint8), np.ones(n, np.uint8)
    widest = int(ids.max()).bit_length()
    for s in range(len(PACKS), 0, -1):  # later, fuller packs overwrite
        most, bits = PACKS[s - 1]
        if most > n:
            continue
        if widest <= bits:
            fits = slice(0, n - most + 1)
        else:
            big = np.zeros(n + 1, np.int32)
            np.cumsum(ids >> ids.dtype.type(bits) > 0, out=big[1:])
            fits = big[most:] == big[:-most]
            if not fits.any():
                break  # narrower ids cannot come in longer runs
            fits = np.flatnonzero(fits)
        selector[fits], count[fits] = s, most
    ids = ids.astype(np.uint64)
    heads, at, step = [], 0, count.tolist()
    while at < n:
        heads.append(at)
        at += step[at]
    heads = np.array(heads)
    chosen = selector[heads]
    size = np.where(chosen == ESCAPE, 2, 1)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(chosen).tolist():
        mine, to = heads[chosen == s], place[chosen == s]
        if s == ESCAPE:
            out[to + 1] = ids[mine]
            continue
        most, bits = PACKS[s - 1]
        word = np.full(len(mine), s << 60, np.uint64)
        for k in range(most):
            word |= ids[mine + k] << np.uint64(bits * k)
        out[to] = word
    return out.astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    words = np.frombuffer(data, "<u8")
    if not len(words):
        return np.zeros(0, np.uint64)
    top = (words >> np.uint64(60)).astype(np.int64)
    literal = np.zeros(len(words), bool)
    if (top == ESCAPE).any():  # a literal may look like any word, so escapes are told apart from the left
        at = 0
        zero = np.flatnonzero(top == ESCAPE).tolist()
        for z in zero:
            if z >= at:
                literal[z + 1] = True
                at = z + 2
    head = ~literal
    counts = np.array([1, *(c for c, _ in PACKS)])[top[head]]
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    mine, tops, at = words[head], top[head], np.flatnonzero(head)
    for s in np.unique(tops).tolist():
        rows = tops == s
        if s == ESCAPE:
            out[place[rows]] = words[at[rows] + 1]
            continue
        most, bits = PACKS[s - 1]
        low = np.uint64((1 << bits) - 1)
        for k in range(most):
            out[place[rows] + k] = mine[rows] >> np.uint64(bits * k) & low
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple[Tokenizer, np.ndarray, dict[str, bytes]]:
    """The tokenizer, the bytes that each id stands for, counted, and the pieces encoded so far."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    sizes = np.zeros(t.get_vocab_size(), np.int64)
    for token, i in t.get_vocab().items():
        sizes[i] = len(token)  # a character per byte in a byte-level vocabulary
    return t, sizes, {}


def _encode_pieces(tokenizer: Tokenizer, sizes: np.ndarray, new: list[str], group: int = 2_000) -> Iterator[tuple[str, bytes]]:
    """Each piece with its ids.

    Words with a space before them are encoded many in one string: the pre-tokenizer divides that string at the spaces again,
    and the bytes of the ids tell where a word ends. Other pieces go one by one.
    """
    words, others = [], []
    for p in new:
        (words if p[0] == " " and p[1:].isalpha() else others).append(p)
    for p, e in zip(others, tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
        yield p, np.array(e.ids, "<u4").tobytes()
    groups = [words[i:i + group] for i in range(0, len(words), group)]
    for ps, e in zip(groups, tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(e.ids, "<u4")
        ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum([len(p.encode()) for p in ps])) + 1
        data, at = ids.tobytes(), 0
        for p, end in zip(ps, (4 * ends).tolist(), strict=True):
            yield p, data[at:end]
            at = end


def encoder(path: str, pattern: str):
    """Texts to little-endian uint32 ids. The library encodes each piece of the pre-tokenizer's pattern once while it is remembered.

    The name of an added token, such as that of the end of a text, is ordinary text where a document says it
    (``encode_special_tokens``, as the vocabulary's notes advise): a document can't end itself.
    """
    tokenizer, sizes, known = _tokenizer(path)
    split = regex.compile(pattern)

    def encode(many: list[str]) -> list[np.ndarray]:
        if len(known) > PIECES:  # forget the older half
            for p in list(islice(known, PIECES // 2)):
                del known[p]
        found = [pieces(t, split) for t in many]
        ids = [list(map(known.get, ps)) for ps in found]
        lacking = [(i, [k for k, v in enumerate(row) if v is None]) for i, row in enumerate(ids) if None in row]
        new = list({found[i][k] for i, at in lacking for k in at})
        known.update(_encode_pieces(tokenizer, sizes, new))
        for i, at in lacking:
            row, ps = ids[i], found[i]
            for k in at:
                row[k] = known[ps[k]]
        return [np.frombuffer(b"".join(row), "<u4") for row in ids]

    return encode


def write_tokens(df: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int | None = 2, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode every whole text and write blocks in ascending id order.

    Texts are dealt by ranges of the id and sorted inside them, so part and block order is id order. Rows of one id, or of a null
    one (first), are ordered by text. A null text is empty. Other columns are not read. A task keeps one block and the texts of
    one slice; a longer document is a block by itself. An empty table gives no block.
    """
    kind = dict(df.dtypes)[id_col]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.select(id_col, text_col).repartitionByRange(parts, id_col, F.xxhash64(text_col)).sortWithinPartitions(id_col, text_col)
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before, size, held, docs = encoder(tokenizer, pattern), 0, 0, [], []
        part = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            ends = np.cumsum([len(h) for h in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([docs], pa.list_(id_type)), pa.array([ends.tolist()], pa.list_(pa.int64())),
                 pa.array([len(ids)], pa.int64()), pa.array([pack(ids)], pa.binary())], ["part", "before", "doc_ids", "ends", "n_ids", "words"])

        for b in slices(batches, text_col, 1 << 20):
            for doc, ids in zip(b.column(0).to_pylist(), encode(texts(b, text_col)), strict=True):
                held.append(ids if end_id is None else np.append(ids, np.uint32(end_id)))
                docs.append(doc)
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield flush()
                    before, size, held, docs = before + size, 0, [], []
        if docs:
            yield flush()

    scan(ordered, task, SCHEMA.format(kind=kind)).write.parquet(path)


def read_tokens(spark, path: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, ids as little-endian uint32 bytes, n_tokens) in file order; start counts the ids before the document.

    Blocks know what comes before them in their part, so only one row per part is summed; that table is written first, so
    Spark sees its size and joins it without moving blocks where it is small.
    """
    blocks = spark.read.parquet(path)
    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("_all"))
    starts = settle(parts.select("part", (F.sum("_all").over(W.orderBy("part")) - F.col("_all")).alias("_start")), "part-starts")
    joined = blocks.join(starts, "part").select((F.col("_start") + F.col("before")).alias("first"), "doc_ids", "ends", "words")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, docs, ends, words in zip(*(b.column(i) for i in range(4)), strict=True):
                ids = unpack(words.as_py()).astype("<u4")
                stop = np.array(ends.as_py(), np.int64)
                start = np.append(0, stop[:-1])
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(start + first.as_py()), pa.array([ids[x:y].tobytes() for x, y in zip(start, stop, strict=True)], pa.binary()),
                     pa.array(stop - start)], [id_col, "start", "ids", "n_tokens"])

    return scan(joined, task, f"`{id_col}` {kind}, start long, ids binary, n_tokens long")


def token_digest(df: DataFrame, tokenizer: str, pattern: str, path: str | None = None) -> DataFrame:
    path = path or shared_dir(df.sparkSession, "tokens")
    write_tokens(df, path, tokenizer, pattern)
    return read_tokens(df.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))
