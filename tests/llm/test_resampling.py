"""Importance weights against a plain count, planes against sums."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from assayer.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, most):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return Counter(" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)), len(w)


def plain(rows, target, buckets, most, seed, least, percent):
    bag = lambda t: Counter({b: n for b, n in _sum(runs(t, most)[0], buckets).items()})
    s, t = sum((bag(x) for _, x in rows), Counter()), sum((bag(x) for x in target), Counter())
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
    out = []
    for i, x in rows:
        weight, score = sum(gain(b) * n for b, n in bag(x).items()), None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, sum(runs(x, most)[0].values()), weight, score, None, runs(x, most)[1]])
    able = sorted((r for r in out if r[5] >= least and r[3] is not None), key=lambda r: (-r[3], r[0], -r[2]))
    for k in range(percent * len(able) // 100):
        able[k][4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def _sum(found, buckets):
    out = Counter()
    for w, n in found.items():
        out[zlib.crc32(w.encode()) % buckets] += n
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    words = ["the", "The", "of", "Ünï", "日本", "x1"] + [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    out = [(i, prose(r.randrange(1, 120))) for i in range(150)]
    out += [(900, None), (901, ""), (902, " .;\n"), (903, "the " * 40_000), (None, prose(40)), (3, out[3][1]), (3, out[3][1]), (4, prose(50)), (904, out[5][1])]
    return out


@pytest.mark.parametrize(("buckets", "most", "percent"), [(10_000, 1, 10), (97, 1, 100), (1_000, 2, 33)])
def test_weights_and_ranks_are_those_of_a_plain_count(spark, rows, buckets, most, percent):
    target = [rows[7][1], "w1 w2 w3 The of", None, ""]
    d = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], "doc_id long, text string, rank string, weight int, bucket int").repartition(5)
    b = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    got = resampling.resample(d, b, buckets=buckets, most=most, percent=percent, seed=11)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, target, buckets, most, 11, 20, percent)
    assert resampling.resample(d.limit(0), b).count() == 0
    assert resampling.resample(d, b.limit(0)).count() == len(rows)


def test_planes_sum_to_the_products():
    r = np.random.default_rng(3)
    for low, high, most in ((-5, 6, 3), (-40_000, 30_000, 90_000), (0, 1, 1), (-9, -1, 70), (3, 9, 1)):
        gain = r.integers(low, high, 777)
        count = r.integers(0, most + 1, (9, 777)) * (r.random((9, 777)) < 0.2)
        who, at = np.nonzero(count)
        planes, worth = resampling.gain_planes(gain)
        held = resampling.count_planes(np.append(who, who), np.append(at, at), np.append(count[who, at], count[who, at]), 9, 777)
        assert (resampling.weights(held, planes, worth) == 2 * count @ gain).all()
