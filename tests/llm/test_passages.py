"""Repeated passages that other texts, repeats or edits used to hide."""
import random

import numpy as np
import pytest
from assayer.llm import passages, substrings


def fresh(r, n):
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n)]


def covered(spark, texts, doc):
    """Word places of ``doc`` that some passage covers."""
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = [x for x in substrings.repeated_passages(d).collect() if x["doc_id"] in doc]
    return {i: {k for x in found if x["doc_id"] == i for k in range(x["start"], x["end"])} for i in doc}


def test_every_copy_inside_a_text_is_found(spark):
    r = random.Random(1)
    p = fresh(r, 60)
    source = fresh(r, 30) + p + fresh(r, 30)
    early = fresh(r, 30) + p[20:26] + fresh(r, 30) + p + fresh(r, 200) + p + fresh(r, 200) + p
    got = covered(spark, [source, early], [1])[1]
    for at in (66, 326, 586):
        assert len(got & set(range(at, at + 60))) >= 58


@pytest.mark.parametrize("spread", [True, False])
def test_recall_of_edited_passages(spark, spread):
    """Every 17th, 12th, 10th or 8th word of a copy is another, evenly or at random; found: four fifths are covered."""
    r, texts, cases = random.Random(3), [], []
    for size in (50, 55, 60, 100):
        for step in (17, 12, 10, 8):
            for _ in range(40):
                p = fresh(r, size)
                off = r.randrange(step)
                changed = set(range(off, size, step)) if spread else set(r.sample(range(size), size // step))
                q = ["x" + w if k in changed else w for k, w in enumerate(p)]
                cases.append((size, step, len(texts) + 1))
                texts += [fresh(r, 50) + p + fresh(r, 50), fresh(r, 50) + q + fresh(r, 50)]
    got = covered(spark, texts, [c[2] for c in cases])
    found = {}
    for size, step, i in cases:
        found.setdefault((size, step), []).append(len(got[i] & set(range(50, 50 + size))) >= 0.8 * size)
        assert len(got[i] - set(range(50, 50 + size))) <= 2
    share = {k: sum(v) / len(v) for k, v in found.items()}
    assert sum(map(sum, found.values())) >= 0.95 * len(cases) and min(share.values()) >= 0.8, share


def test_rows_that_repeat_an_id_are_texts_of_their_own(spark):
    r = random.Random(6)
    p, other, short = fresh(r, 60), fresh(r, 201), fresh(r, 3)
    long = fresh(r, 30) + p + fresh(r, 30)
    rows = [(1, fresh(r, 20) + p), (7, long), (7, short), (7, other), (7, long), (8, other), (None, long), (9, [])]
    d = spark.createDataFrame([(i, " ".join(t), len(" ".join(t)), "a", 1) for i, t in rows] + [(10, None, None, "a", 1)], "doc_id long, text string, n_chars long, _id string, _text_key long")
    cut = [(x["doc_id"], x["text"], x["n_chars"], x["_id"], x["_text_key"]) for x in substrings.cut_passages(d, substrings.repeated_passages(d)).collect()]
    kept = " ".join(long[:30]) + "\n" + " ".join(long[90:])
    want = [(i, kept if t is long and i == 7 else "" if i == 8 else " ".join(t)) for i, t in rows] + [(10, None)]
    assert sorted(((i, t) for i, t, *_ in cut), key=repr) == sorted(want, key=repr)
    assert all(n == (None if t is None else len(t)) and (x, y) == ("a", 1) for _, t, n, x, y in cut)
    assert substrings.cut_passages(d.limit(0), substrings.repeated_passages(d.limit(0))).count() == 0


def test_very_long_texts_with_many_edits(spark):
    r = random.Random(8)
    for same, differ, found in ((17, 10, False), (20, 13, False), (20, 4, True)):
        a, b = [], []
        for _ in range(43_200 // (same + differ)):
            p = fresh(r, same)
            a += p + fresh(r, differ)
            b += p + fresh(r, differ)
        got = covered(spark, [a, b], [1])[1]
        assert len(got) >= 0.95 * len(b) if found else not got


def test_repeated_lines_and_equal_texts(spark):
    r = random.Random(9)
    line = fresh(r, 8)
    block = line * 300
    texts = [block, fresh(r, 60) + block, fresh(r, 70)]
    texts += [texts[2], texts[2], line * 2]
    got = covered(spark, texts, range(6))
    assert len(got[1] & set(range(60, len(texts[1])))) >= 2_300 and len(got[1]) <= len(block) + 8
    assert got[3] == got[4] == set(range(70)) and not got[0] and not got[2] and not got[5]


def test_seeds_are_the_same_in_any_text(spark):
    r = np.random.default_rng(4)
    p = r.integers(0, 1 << 32, 400, dtype=np.uint32)
    a, b = np.concatenate([p, r.integers(0, 1 << 32, 30, dtype=np.uint32)]), np.concatenate([r.integers(0, 1 << 32, 77, dtype=np.uint32), p])
    h, who, pos, reach = passages.keys(np.concatenate([a, b]), np.array([len(a), len(b)]))
    first = {(int(x), int(y)) for x, w, y, n in zip(h, who, pos, reach, strict=True) if w == 0 and y + n <= 400 - passages.FILL}
    second = {(int(x), int(y) - 77) for x, w, y in zip(h, who, pos, strict=True) if w == 1}
    late = {x for x in first if passages.FILL <= x[1]}
    assert len(late) > 150 and late <= second
    still = np.zeros(200, np.uint32)
    assert len(passages.seeds(still, np.array([200]))[0]) > 0


def test_alignment_against_plain_edit_distances(spark):
    r = random.Random(10)
    for _ in range(200):
        a = [r.randrange(6) for _ in range(r.randrange(0, 14))]
        b = [x if r.random() < 0.7 else r.randrange(6) for x in a if r.random() < 0.9] + [r.randrange(6)] * r.randrange(3)
        edits = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                edits[i][j] = min(edits[i - 1][j - 1] + (a[i - 1] != b[j - 1]), edits[i - 1][j] + 1, edits[i][j - 1] + 1)
        i, j, m = passages._furthest(np.array(a, np.uint32), np.array(b, np.uint32), True)
        if a and b:
            # An alignment with so few edits: matches plus edits make up both sides.
            assert (i, j) == (len(a), len(b)) and len(a) + len(b) - 2 * m <= 2 * edits[-1][-1] and m <= min(len(a), len(b))


def test_lines_of_other_texts_hide_no_passage(spark):
    r, texts, last = random.Random(2), [], []
    for size in (15, 20, 30):
        for _ in range(8):
            lines = [fresh(r, size) for _ in range(60 // size)]
            for line in lines:
                texts += [fresh(r, 40) + line + fresh(r, 40) for _ in range(2)]
            p = sum(lines, [])
            first = len(texts)
            texts += [fresh(r, 50) + p + fresh(r, 50)]
            for line in lines:
                texts += [fresh(r, 40) + line + fresh(r, 40)]
            last.append(len(texts))
            texts += [fresh(r, 50) + p + fresh(r, 50)]
            assert first < last[-1]
    got = covered(spark, texts, last)
    assert sum(len(got[i] & set(range(50, 110))) >= 58 for i in last) == len(last)
