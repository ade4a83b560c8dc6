"""The near-duplicate stage against all pairs: five words, similarity 0.8."""
import random

import corpus_pipeline
import numpy as np
from assayer.llm import overlap


def test_edited_copies_go(spark):
    r, rows = random.Random(4), []
    words = [f"w{i}" for i in range(3000)]
    for g in range(12):
        base = [r.choice(words) for _ in range(60 + 20 * g)]
        rows.append(base)
        for k in range(6):
            copy = list(base)
            for _ in range(1 + k * (1 + g // 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append(copy)
    rows += [["short", "one"], ["short", "one"], ["other"], [], []]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)] + [(None, " ".join(rows[0])), (900, None)], "doc_id long, text string").repartition(5)
    texts = [" ".join(w) for w in rows]
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in map(str.split, texts)]
    low = list(range(len(rows)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    links = 0
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links += sets[i] != sets[j]
                a, b = sorted((find(i), find(j)))
                low[b] = a
    assert links > 10
    want = sorted(i for i in range(len(rows)) if find(i) == i)
    got = [x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, d, "").collect()]
    assert sorted(x for x in got if x is not None) == want and got.count(None) == 1


def test_a_crowd_of_near_copies_is_one_group(spark):
    r = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        w[r.randrange(5, 115)] = f"x{i}"
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x["component_id"] for x in overlap.similar_groups(d).collect()} == {0}


def test_empty_tables_and_clashing_columns(spark):
    d = spark.createDataFrame([(1, "a b c d e f", 1, 2), (2, "a b c d e f", 1, 2), (2, "x", 1, 2), (None, None, 1, 2)], "doc_id long, text string, cls int, root int")
    assert overlap.keep_first(d.limit(0)).count() == 0 and overlap.similar_groups(d.limit(0)).count() == 0
    got = sorted(((x["doc_id"], x["text"]) for x in overlap.keep_first(d).collect()), key=repr)
    assert got == sorted([(1, "a b c d e f"), (2, "x"), (2, "a b c d e f"), (None, None)], key=repr)


def test_edited_templates_that_are_not_similar_meet_in_no_pair(spark):
    """Many texts share a template in three quarters of their words: its shingles are in every prefix, yet too late in it."""
    r = random.Random(7)
    template, rows = [f"t{i}" for i in range(175)], []
    for i in range(3_000):
        own = [f"o{i}x{k}" for k in range(25)]
        at = r.randrange(176)
        rows.append((i, " ".join(template[:at] + own + template[at:])))
    rows += [(5_000 + i, rows[i][1] + " more") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    shared = spark.sparkContext.broadcast(overlap._frequent(d))
    classes = overlap._classes(d, shared).cache()
    root = classes.selectExpr("cls", "cls AS root")
    assert overlap._met(classes, root, shared, 16).count() < 3 * len(rows)
    got = {x["doc_id"]: x["component_id"] for x in overlap.similar_groups(d).collect()}
    assert all(got[5_000 + i] == i for i in range(40)) and sum(k == v for k, v in got.items()) == 3_000


def test_pieces_of_a_frequent_shingle_lose_no_pair():
    r = np.random.default_rng(3)
    members = np.zeros(60, overlap._PLACE)
    members["h"], members["cls"], members["n"], members["i"] = 7, np.arange(60), r.integers(40, 60, 60), r.integers(0, 5, 60)
    members["root"] = members["cls"] % 13

    def found(rows):
        return {(a, b) for batch in overlap._pairs(rows) for a, b in zip(*batch.to_pydict().values(), strict=True)}
    n, left = members["n"].astype(int), (members["n"] - members["i"]).astype(int)
    want = {(a, b) for b in range(60) for a in range(b) if a % 13 != b % 13 and 5 * min(n[a], n[b]) >= 4 * max(n[a], n[b]) and 9 * min(left[a], left[b]) >= 4 * (n[a] + n[b])}
    assert found(members) == want and want
    units = []
    for m in members:
        own = m["cls"] % 3
        for other in range(3):
            x = m.copy()
            x["piece"], x["unit"] = own, min(own, other) * 3 + max(own, other)
            units.append(x)
    assert found(np.array(units, overlap._PLACE)) == want


def test_sketches_tell_large_sets_apart_and_lose_no_similar_pair(spark):
    """Sets of thousands that share half of their shingles go before they are compared whole; those that share enough stay."""
    r, sets, pairs, near = np.random.default_rng(5), [], [], []
    for n in (3, 60, 300, 500, 1_000, 2_040, 4_000, 9_000):
        for share in (1.0, 0.95, 0.9, 0.89, 0.5, 0.3):
            one = np.unique(r.integers(0, 1 << 63, n, np.int64).view(np.uint64))
            two = np.unique(np.concatenate([one[:int(share * n)], r.integers(0, 1 << 63, n - int(share * n) + n // 40, np.int64).view(np.uint64)]))
            pairs.append((len(sets), len(sets) + 1))
            sets += [one, two]
            if overlap.similar(one, two):
                near.append(pairs[-1])
    classes = spark.createDataFrame([(i, len(s), overlap.sketch(s).tolist()) for i, s in enumerate(sets)], "cls long, n int, sketch array<long>")
    kept = {tuple(x) for x in overlap._plausible(spark.createDataFrame(pairs, "a long, b long"), classes).collect()}
    assert set(near) <= kept and len(near) > 20
    assert not {(a, b) for a, b in kept if len(sets[a]) > 250 and 2 * len(np.intersect1d(sets[a], sets[b])) <= 1.02 * len(sets[a])}


def test_packed_places_are_read_back():
    places = np.zeros(300, overlap._PLACE)
    for k, c in enumerate(overlap._PLACE.names):
        places[c] = np.random.default_rng(k).integers(0, 1 << 30, 300)
    assert (overlap._unpacked(overlap._packed(places)) == places).all() and not len(overlap._unpacked(b""))


def test_a_crowd_that_no_minimum_connects_meets_in_few_pairs(spark, monkeypatch):
    """Of some hundred edited copies each two are similar now and then: they are connected before all their pairs meet."""
    r, settle, made = random.Random(11), overlap.settle, {}
    base, texts = [f"b{i}" for i in range(150)], []
    for i in range(700):
        w = list(base)
        for k in range(r.choice((1, 2, 2, 2, 2, 3))):
            w[r.randrange(150)] = f"x{i}y{k}"
        texts.append(" ".join(w))

    def counted(df, what):
        out = settle(df, what)
        made[what] = made.get(what, 0) + out.count()
        return out
    monkeypatch.setattr(overlap, "settle", counted)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in overlap.similar_groups(d).collect()}
    sets, low, links = [overlap.shingle_set(t) for t in texts], list(range(len(texts))), 0

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if overlap.similar(sets[i], sets[j]):
                links += 1
                a, b = sorted((find(i), find(j)))
                low[b] = a
    assert got == {i: find(i) for i in range(len(texts))} and links > 20 * len(texts)
    assert made["met"] < 10 * len(texts) and made.get("near", 0) < 3 * 40 * len(texts)


def test_folded_sketches_lose_no_similar_pair():
    r, sets = np.random.default_rng(6), []
    for n in (5, 200, 250, 256, 257, 300, 500, 512, 513, 900, 5_000):
        for share in (1.0, 0.97, 0.9, 0.3):
            one = np.unique(r.integers(0, 1 << 63, n, np.int64).view(np.uint64))
            sets += [one, np.unique(np.concatenate([one[:int(share * n)], r.integers(0, 1 << 63, n // 12, np.int64).view(np.uint64)]))]
    places = np.zeros(len(sets), overlap._KNOWN)
    for p, s in zip(places, sets, strict=True):
        long = overlap.sketch(s).view("<u8")
        long = np.append(long, np.zeros(-len(long) % overlap.FOLDED, "<u8"))
        p["n"], p["sketch"] = len(s), np.bitwise_xor.reduce(long.reshape(-1, overlap.FOLDED), axis=0)
    near = 0
    for i in range(len(sets)):
        apart = overlap._folded_apart(places, i, np.arange(len(sets)))
        for j in range(len(sets)):
            assert apart[j] <= len(np.setxor1d(sets[i], sets[j], assume_unique=True))
            near += overlap.similar(sets[i], sets[j])
    assert near > len(sets) + 40
    kept = overlap._unpacked(overlap._packed(places), overlap._KNOWN)
    assert (kept == places).all()
