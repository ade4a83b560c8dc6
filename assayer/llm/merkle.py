"""A Merkle manifest of a table: trees of 16 children per group of rows, one above the groups, proofs and their check.

Digests are kept in blocks, aligned subtrees of ``HEIGHT`` levels. A block is one binary value in van Emde Boas
order: its levels are cut at half height, the upper half lies first, the lower subtrees follow one after another, and each is laid
out in the same way. Addresses are computed, never stored. Roots of blocks are the leaves of the blocks above them.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.numbering import numbered
from assayer.session import settle

FAN, SHIFT = 16, 4
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tree_size(levels: int) -> int:
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` of a depth (root: 0) lie in a tree of so many levels."""
    if levels == 1:
        return np.zeros_like(index)
    upper = (levels + 1) // 2
    if depth < upper:
        return address(upper, depth, index)
    below = SHIFT * (depth - upper)
    tree = index >> below
    return tree_size(upper) + tree * tree_size(levels - upper) + address(levels - upper, depth - upper, index - (tree << below))


def height_of(n: int) -> int:
    """Levels below the root of a tree of ``n`` leaves."""
    h = 0
    while FAN ** h < n:
        h += 1
    return h


def counts(leaves: int, height: int) -> list[int]:
    """Nodes by depth, from the root to the leaves."""
    return [-(-leaves // FAN ** (height - d)) for d in range(height + 1)]


def runs(level: np.ndarray) -> list[str]:
    """The hex text of each run of 16 digests."""
    return [level[i:i + FAN].tobytes().hex() for i in range(0, len(level), FAN)]


def build(leaves: np.ndarray, height: int) -> bytes:
    """All digests of the tree over ``leaves`` (n x 32 bytes) in van Emde Boas order; places without a node are zero."""
    spots = [address(height + 1, d, np.arange(n)) for d, n in enumerate(counts(len(leaves), height))]
    nodes = np.zeros((1 + max(int(s[-1]) for s in spots), 32), np.uint8)
    level = leaves
    for d in range(height, -1, -1):
        nodes[spots[d]] = level
        if d:
            level = np.frombuffer(b"".join(sha256(r.encode()).digest() for r in runs(level)), np.uint8).reshape(-1, 32)
    return nodes.tobytes()


def siblings(nodes: bytes, leaves: int, height: int) -> list[list[str]]:
    """For each depth from the leaves up to that below the root, the hex text of its runs, fetched by address."""
    stored = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    n = counts(leaves, height)
    return [runs(stored[address(height + 1, d, np.arange(n[d]))]) for d in range(height, 0, -1)]


def steps(fetched: list[list[str]], i: int) -> list[tuple[str, str]]:
    """What stands left and right of leaf ``i`` and of its ancestors below the block's root."""
    out = []
    for level in fetched:
        run, at = level[i >> SHIFT], 64 * (i & (FAN - 1))
        out.append((run[:at], run[at + 64:]))
        i >>= SHIFT
    return out


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


def digest_of(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its byte count, a colon and its value."""
    told = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*told).cast("binary"), 256))


def _shape(n: int, block: int, tall: int) -> tuple[int, int]:
    """Height and leaves of a block of a tree of ``n`` leaves; blocks are ``tall`` levels high unless the tree is lower."""
    wide = FAN ** tall
    return (tall, min(wide, n - block * wide)) if n > wide else (height_of(n), n)


def _blocks(rows: DataFrame, keys: list[str], carried: list[str], tall: int) -> DataFrame:
    """(keys, block, n, carried as arrays, nodes) of ``rows`` (keys, pos, n, digest, carried): at most 16^tall rows a block."""
    one = F.sort_array(F.collect_list(F.struct("pos", "digest", *carried)))
    grouped = rows.groupBy(*keys, F.expr(f"pos div {FAN ** tall}").alias("block"), "n").agg(one.alias("_rows"))
    many = grouped.select(*keys, "block", "n", F.col("_rows.digest").alias("_digests"), *[F.col(f"_rows.{c}").alias(c) for c in carried])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes = []
            for n, block, digests in zip(b["n"].to_pylist(), b["block"].to_pylist(), b["_digests"], strict=True):
                leaves = np.frombuffer(b"".join(digests.as_py()), np.uint8).reshape(-1, 32)
                nodes.append(build(leaves, _shape(n, block, tall)[0]))
            kept = [c for c in b.schema.names if c != "_digests"]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in kept], pa.array(nodes, pa.binary())], [*kept, "nodes"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in many.schema if f.name != "_digests") + ", nodes binary"
    return many.mapInArrow(task, schema)


def build_levels(rows: DataFrame, keys: list[str], carried: list[str], most: int, tall: int) -> list[DataFrame]:
    """The block tables of all trees, lowest first; ``most`` is the largest ``n``. Each level is written to the shared folder."""
    levels, wide = [settle(_blocks(rows, keys, carried, tall), "blocks")], FAN ** tall
    while most > wide:
        most = -(-most // wide)
        roots = levels[-1].filter(F.col("n") > wide).select(*keys, F.col("block").alias("pos"),
                                                            F.expr(f"(n + {wide - 1}) div {wide}").alias("n"), F.expr("substring(nodes, 1, 32)").alias("digest"))
        levels.append(settle(_blocks(roots, keys, [], tall), "blocks"))
    return levels


def tops(levels: list[DataFrame], keys: list[str], tall: int) -> DataFrame:
    """(keys, digest): the root of each tree."""
    found = [b.filter(F.col("n") <= FAN ** tall).select(*keys, F.expr("substring(nodes, 1, 32)").alias("digest")) for b in levels]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _below(blocks: DataFrame, keys: list[str], tall: int) -> DataFrame:
    """(keys, _at, lefts, rights, subroot, root) of the leaves of ``blocks``, which carry those columns for their own roots."""
    kinds = dict(blocks.dtypes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, (n, block, nodes, lefts, rights, subroot, root) in enumerate(zip(*[b[c].to_pylist() for c in (
                    "n", "block", "nodes", "lefts", "rights", "subroot", "root")], strict=True)):
                height, leaves = _shape(n, block, tall)
                fetched = siblings(nodes, leaves, height)
                for a in range(0, leaves, 256):
                    few = range(a, min(a + 256, leaves))
                    paths = [steps(fetched, i) for i in few]
                    same = [pa.array([b[k][at].as_py()] * len(few), b.schema.field(k).type) for k in keys]
                    yield pa.RecordBatch.from_arrays(
                        [*same, pa.array([block * FAN ** tall + i for i in few], pa.int64()), pa.array([[x for x, _ in p] + lefts for p in paths], pa.list_(pa.string())),
                         pa.array([[y for _, y in p] + rights for p in paths], pa.list_(pa.string())), pa.array([subroot] * len(few), pa.string()),
                         pa.array([root] * len(few), pa.string())], [*keys, "_at", "lefts", "rights", "subroot", "root"])

    one = blocks.select(*keys, "n", "block", "nodes", "lefts", "rights", "subroot", "root")
    told = [f"`{k}` {kinds[k]}" for k in keys]
    return one.mapInArrow(task, ", ".join([*told, "_at bigint, lefts array<string>, rights array<string>, subroot string, root string"]))


def _met(blocks: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """``blocks`` with the path of their own roots."""
    other = above.select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(keys)], "_at", "lefts", "rights", "subroot", "root")
    on = blocks["block"] == other["_at"]
    for i, k in enumerate(keys):
        on = on & blocks[k].eqNullSafe(other[f"_m{i}"])
    return blocks.join(other, on).select(*[blocks[c] for c in blocks.columns], "lefts", "rights", "subroot", "root")


def descend(levels: list[DataFrame], keys: list[str], roots: DataFrame, tall: int) -> DataFrame:
    """The lowest blocks with the paths of their roots. ``roots``: (keys, lefts, rights, subroot, root) of each tree."""
    start = settle(roots.withColumn("_at", F.lit(0).cast("bigint")), "paths")
    above = None
    for depth in range(len(levels) - 1, -1, -1):
        blocks = levels[depth]
        met = _met(blocks.filter(F.col("n") <= FAN ** tall), start, keys)
        if above is not None:
            met = met.unionByName(_met(blocks.filter(F.col("n") > FAN ** tall), above, keys))
        if depth:
            above = settle(_below(met, keys, tall), "paths")
    return met


def _proven(blocks: DataFrame, id_col: str, tall: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = ("n", "block", "nodes", "claim", "lefts", "rights", "subroot", "root")
            for at, (n, block, nodes, claims, lefts, rights, subroot, root) in enumerate(zip(*[b[c].to_pylist() for c in names], strict=True)):
                height, leaves = _shape(n, block, tall)
                fetched = siblings(nodes, leaves, height)
                upper = list(zip(lefts, rights, strict=True))
                beside = "".join(x + y for x, y in upper)
                stored = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
                own = stored[address(height + 1, height, np.arange(leaves))].tobytes().hex()
                leaf = [own[64 * i:64 * i + 64] for i in range(leaves)]
                proofs, folded = [], []
                for i in range(leaves):
                    path = steps(fetched, i)
                    proofs.append(sha256(("".join(x + y for x, y in path) + beside).encode()).hexdigest())
                    folded.append(fold(claims[i].hex() if claims[i] is not None else leaf[i], path + upper))
                yield pa.RecordBatch.from_arrays([b["ids"][at].values, pa.array(leaf), pa.array([subroot] * leaves), pa.array([root] * leaves), pa.array(proofs),
                                                  pa.array(folded), pa.array([x == root for x in folded])],
                                                 [id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    kind = dict(blocks.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    return blocks.mapInArrow(task, f"`{id_col}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def verify_rows(df: DataFrame, claims: dict[str, Column] | None = None, id_col: str = "doc_id", group_col: str = "source",
                fields: tuple[str, ...] = FIELDS, tall: int = HEIGHT) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``df``.

    A group's leaves ascend by id, then digest; null ids come first, and a null group is a group, the first one. Groups ascend
    bytewise. ``claims`` replaces fields by what a copy of the row says; it may be null where the copy is not to differ. A row
    whose claims are its own values folds to the root. Equal rows are leaves of their own. Columns not in ``fields`` are not
    read, whatever they are called. An empty table gives no rows.

    Leaves are digested in the JVM; only digests, ids and groups are shuffled, never texts. A group of any size is cut into
    blocks of 4,096 leaves. A block's task sees it and the path of its root, which is 15 digests a level.
    """
    own = [F.col(f"`{c}`") for c in fields]
    copy = [(claims or {}).get(c, F.col(f"`{c}`")) for c in fields]
    changed = F.lit(False)
    for c, value in (claims or {}).items():
        changed = changed | ~value.eqNullSafe(F.col(f"`{c}`"))
    leaves = df.select(F.col(f"`{id_col}`").alias("ids"), F.col(f"`{group_col}`").alias("_group"), digest_of(own).alias("digest"),
                       F.when(changed, digest_of(copy)).alias("claim"), F.monotonically_increasing_id().alias("_row"))
    leaves = settle(leaves, "leaves")
    rows = numbered(leaves, ["_group"], [F.col("ids").asc_nulls_first(), F.col("digest").asc(), F.col("_row").asc()])
    rows = settle(rows.drop("_row"), "numbered")
    most = rows.agg(F.max("n")).first()[0] or 0
    trees = build_levels(rows, ["_group"], ["ids", "claim"], most, tall)
    subroots = settle(tops(trees, ["_group"], tall), "subroots")
    groups = settle(numbered(subroots, [], [F.col("_group").asc_nulls_first()]), "groups")
    above = build_levels(groups, [], ["_group"], groups.agg(F.max("n")).first()[0] or 0, tall)
    root = F.lower(F.hex("digest"))
    none = F.array().cast("array<string>")
    start = tops(above, [], tall).select(none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"), root.alias("root"))
    lowest = descend(above, [], start, tall)
    by_place = _below(lowest, [], tall).drop("subroot")
    told = groups.select("_group", "pos", F.lower(F.hex("digest")).alias("subroot")).join(by_place, F.col("pos") == F.col("_at"))
    return _proven(descend(trees, ["_group"], told.select("_group", "lefts", "rights", "subroot", "root"), tall), id_col, tall)


def tampered_text(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text with A-Z lower-cased where ``TAMPERED`` divides the checksum of the id."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % TAMPERED == 0
    return F.when(hit, F.translate(text_col, _UPPER, _LOWER)).otherwise(F.col(text_col))


def merkle_digest(df: DataFrame) -> DataFrame:
    return verify_rows(df, {"text": tampered_text()})
