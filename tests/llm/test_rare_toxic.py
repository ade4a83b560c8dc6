"""Toxic words that each stand in under one per cent of the training texts."""
import random

from assayer.llm import toxicity


def test_rare_toxic_words_are_learned():
    r = random.Random(1)
    words = ["".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randrange(4, 9))) for _ in range(4000)]
    bad = ["".join(r.choice("abcdefghijklmnoprstuvwxyz") for _ in range(8)) for _ in range(10)]

    def text(seed, word):
        q = random.Random(seed)
        w = [q.choice(words) for _ in range(60)]
        for _ in range(2 if word else 0):
            w[q.randrange(60)] = word
        return " ".join(w)
    labels = [int(i % 12 == 0) for i in range(3000)]
    model = toxicity.train([text(i, bad[i // 12 % 10] if y else None) for i, y in enumerate(labels)], labels)
    assert (model.score([text(10**6 + i, bad[i % 10]) for i in range(100)]) >= 0.5).mean() >= 0.9
    assert (model.score([text(2 * 10**6 + i, None) for i in range(300)]) >= 0.5).mean() <= 0.05
