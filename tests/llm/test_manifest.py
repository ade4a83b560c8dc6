"""The manifest against a plain tree; its layout and numbering."""
import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from assayer.llm import merkle
from assayer.llm.numbering import numbered
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int, pos int, n int"


def digest(s):
    return sha256(s.encode()).hexdigest()


def told(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        x = out[-1]
        out.append([digest("".join(x[i:i + 16])) for i in range(0, len(x), 16)])
    return out


def path(tree, i):
    out = []
    for x in tree[:-1]:
        a = i // 16 * 16
        out.append(("".join(x[a:i]), "".join(x[i + 1:a + 16])))
        i //= 16
    return out


def plain(rows):
    """What ``merkle_digest`` must return for rows (doc_id, text, lang, source, n_chars)."""
    leaf = lambda r, t: told(r[0], r[3], r[2], r[4], t)
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))):
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf(r, r[1]) for r in groups[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps, own = path(trees[s], i) + path(top, k), leaf(r, r[1])
            cur = own
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                cur = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
            for a, b in steps:
                cur = digest(a + cur + b)
            out.append((r[0], own, trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in steps)), cur, cur == top[-1][0]))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    text = lambda i: None if i % 11 == 0 else "" if i % 13 == 0 else " ".join(r.choice(["Ab", "cd", "Ünï", "日本", "Z"]) for _ in range(r.randrange(1, 30)))
    out = [(i, text(i), r.choice(["en", None, "de"]), "hot", i % 7 or None) for i in range(700)]
    out += [(1000 + i, text(i), "en", r.choice(["a", "é", "Z", "", None]), i) for i in range(60)]
    out += [(2000, "One", "en", "alone", 3), (None, "No Id", None, "hot", 1), (5, "Twice A", "en", "hot", 1), (5, "Twice A", "en", "hot", 1), (2001, "Long " * 60_000, "en", "a", 1)]
    out += [(3000 + i, f"x{i}", "en", f"g{i}", i) for i in range(40)]
    return out


@pytest.mark.parametrize("tall", [1, 2, 3])
def test_rows_and_proofs_are_those_of_a_plain_tree(spark, rows, tall):
    df = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], SCHEMA).repartition(7)
    got = merkle.verify_rows(df, {"text": merkle.tampered_text()}, tall=tall)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_claims_that_say_the_same_are_verified(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows[:50]], SCHEMA)
    assert merkle.verify_rows(df, {"text": F.col("text")}).filter("verified").count() == 50
    assert merkle.verify_rows(df, {"lang": F.lit("xx")}).filter("verified").count() == 0
    assert merkle.verify_rows(df.limit(0)).count() == 0


@pytest.mark.parametrize("depths", [1, 2, 3, 4])
def test_addresses_are_a_permutation_with_subtrees_in_one_piece(depths):
    spots = [merkle.address(depths, d, np.arange(16 ** d)) for d in range(depths)]
    assert sorted(np.concatenate(spots).tolist()) == list(range(merkle.tree_size(depths)))
    upper = (depths + 1) // 2
    for t in range(16 ** upper if depths > 1 else 0):
        below = np.concatenate([spots[d][t * 16 ** (d - upper):(t + 1) * 16 ** (d - upper)] for d in range(upper, depths)])
        assert below.max() - below.min() + 1 == len(below) == merkle.tree_size(depths - upper)


@pytest.mark.parametrize("leaves", [1, 2, 16, 17, 255, 257, 4096])
def test_blocks_hold_every_level(leaves):
    r = np.random.default_rng(leaves)
    x = r.integers(0, 256, (leaves, 32), dtype=np.uint8)
    tree, height = levels([d.tobytes().hex() for d in x]), merkle.height_of(leaves)
    nodes = merkle.build(x, height)
    assert nodes[:32].hex() == tree[-1][0]
    fetched = merkle.siblings(nodes, leaves, height)
    assert [merkle.steps(fetched, i) for i in range(leaves)] == [path(tree, i) for i in range(leaves)]


def test_numbers_go_through_a_hot_key(spark):
    df = spark.range(20_000).select((F.col("id") % 10 == 0).alias("k"), F.xxhash64("id").alias("v"), F.col("id").alias("i"))
    df = df.withColumn("k", F.when(F.col("i") % 7 == 0, None).otherwise(F.col("k")))
    got, want = numbered(df, ["k"], [F.col("v").desc()]).collect(), {}
    for r in df.collect():
        want.setdefault(r["k"], []).append(r["v"])
    want = {k: sorted(v, reverse=True) for k, v in want.items()}
    assert all(r["pos"] == want[r["k"]].index(r["v"]) and r["n"] == len(want[r["k"]]) for r in got[::97]) and len(got) == 20_000
    assert all(sorted(r["pos"] for r in got if r["k"] is k) == list(range(len(v))) for k, v in want.items())
