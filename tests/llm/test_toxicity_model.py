"""The toxicity model against plain counts of its n-grams and its formula."""
import random
import re

import numpy as np
from assayer.llm import toxicity


def plain_grams(text):
    """Hashes of the n-grams of each word with a border before and after it, by the definition."""
    out = []
    cleaned = re.sub(rb"[^a-z\x80-\xff]+", b" ", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode())).strip()
    for word in cleaned.split():
        w = b" " + word + b" "
        for size in toxicity.GRAMS:
            for i in range(len(w) - size + 1):
                h = 0
                for c in w[i:i + size]:
                    h = (h * 16777619 + c + 1) & 0xFFFFFFFF
                h ^= size * 0x9E3779B1 & 0xFFFFFFFF
                h ^= h >> 15
                h = h * 0x85EBCA6B & 0xFFFFFFFF
                h ^= h >> 13
                out.append(h >> 32 - toxicity.BUCKET_BITS)
    return sorted(out)


def test_n_grams_are_those_of_each_word():
    r = random.Random(1)
    many = ["", " ", "a", "Ab  cd, EF!", "don't we'll", "Ünï 日本 été", "x" * 60] + [" ".join("".join(r.choice("abcXYZé1-") for _ in range(r.randrange(1, 9))) for _ in range(r.randrange(12))) for _ in range(60)]
    ids, sizes = toxicity.grams(many)
    at = 0
    for t, n in zip(many, sizes.tolist(), strict=True):
        assert sorted(ids[at:at + n].tolist()) == plain_grams(t), t
        at += n
    assert at == len(ids)


def test_a_score_is_the_logistic_of_the_mean_weight():
    r = np.random.default_rng(2)
    m = toxicity.Model(r.normal(size=1 << toxicity.BUCKET_BITS), -0.3)
    many = ["some words here", "", "Été 日本", "a b c d", "some words here some"]
    for t, s in zip(many, m.score(many), strict=True):
        g = plain_grams(t)
        assert abs(s - 1 / (1 + np.exp(0.3 - (np.mean(m.weight[g]) if g else 0)))) < 1e-12


def test_unseen_misspellings_share_n_grams():
    r = random.Random(3)
    mild = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4))) for _ in range(300)]
    bad = ["vuzzquack", "gribblenox", "wexlorphy", "jyxtumble"]
    text = lambda toxic: " ".join(r.choice(mild) for _ in range(40)) + (" " + " ".join(r.choice(bad) for _ in range(4)) if toxic else "")
    labels = [int(r.random() < 0.3) for _ in range(600)]
    m = toxicity.train([text(k) for k in labels], labels, steps=400)
    assert np.mean((m.score([text(1) for _ in range(100)]) >= 0.5)) > 0.95 and np.mean((m.score([text(0) for _ in range(100)]) >= 0.5)) < 0.05
    swapped = lambda w: w[:4] + w[5] + w[4] + w[6:]
    near = [" ".join(r.choice(mild) for _ in range(20)) + " " + " ".join(swapped(r.choice(bad)) for _ in range(6)) for _ in range(100)]
    assert np.mean(m.score(near) >= 0.5) > 0.8
    assert set(m.score(["", " 12 "]).round(9)) == {round(float(1 / (1 + np.exp(-m.bias))), 9)}
