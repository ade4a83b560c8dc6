"""Languages against held-out labels, the kernel against its definition."""
import random

import numpy as np
import pytest
from assayer.llm import language
from assayer.llm.scan import table

ALPHABETS = {"aa": "abcde", "bb": "cdefg", "cc": "éèàç", "dd": "日本語漢"}


def words(r, lang, n):
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randint(2, 7))) for _ in range(n))


def shared(a, b):
    grams = lambda d: {d[i:i + n] for n in range(1, 5) for i in range(len(d) - n + 1)}
    x, y = grams(language.folded(a)), grams(language.folded(b))
    return len(x & y) / np.sqrt(len(x) * len(y))


def test_kernel_counts_shared_n_grams():
    r = random.Random(1)
    many = [words(r, k, 20) for k in ALPHABETS for _ in range(5)] + ["a", "zzz", "Éa 12 ab"]
    m = language.train(many[:20], [k for k in ALPHABETS for _ in range(5)], landmarks=8)
    marks = [many[5 * i + j] for i in range(4) for j in range(2)]
    want = np.array([[shared(t, x) for x in marks] for t in many])
    assert np.abs(m.kernel([language.folded(t) for t in many]) - want).max() < 1e-5


def test_dual_weights_solve_the_ridge_problem():
    r = random.Random(2)
    labels = [k for k in ALPHABETS for _ in range(12)]
    many = [words(r, k, 15) for k in labels]
    m = language.train(many, labels, landmarks=48, ridge=1e-2)
    # With every text a landmark the fit is kernel ridge regression itself, languages being equally frequent.
    k = np.array([[shared(a, b) for b in many] for a in many])
    order = [i for x in m.langs for i in range(len(labels)) if labels[i] == x]
    y = np.where(np.array(labels)[:, None] == np.array(m.langs)[None, :], 1.0, -1.0)
    want = k @ np.linalg.solve(k + 1e-2 * len(labels) * np.eye(len(labels)), y)
    assert np.abs(k[:, order] @ m.dual - want).max() < 1e-3


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in language.language_digest(docs).collect()}
    out = [(r["lang"], got[r["doc_id"]]["lang_pred"]) for r in docs.select("doc_id", "lang").collect() if got[r["doc_id"]]["held_out"]]
    assert len(out) > 300 and sum(a == b for a, b in out) / len(out) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


@pytest.fixture(scope="module")
def mixed(spark):
    r = random.Random(3)
    rows = [(i, words(r, k, 30), k) for i, k in enumerate(list(ALPHABETS) * 40)]
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "12 -- !?", "cc"), (503, words(r, "dd", 20_000), None), (None, words(r, "aa", 9), "aa"), (7, rows[7][1], "cc"), (7, rows[7][1], None)]
    return spark.createDataFrame([(*x, "text", 1.0) for x in rows], "doc_id long, text string, lang string, lang_pred string, score double")


def test_odd_texts_have_defined_results(spark, mixed):
    got = language.language_digest(mixed)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == mixed.count()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert by[500] == by[501] == by[502] == ("und", 0.0) and by[503][0] == "dd" and by[None][0] == "aa"
    assert language.language_digest(mixed.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.language_digest(mixed.withColumn("lang", mixed["lang"].substr(9, 1))).collect()} >= {""}
    unknown = language.language_digest(mixed.selectExpr("doc_id", "text", "cast(NULL AS STRING) AS lang")).collect()
    assert {(r["lang_pred"], r["score"]) for r in unknown} == {("und", 0.0)}


def test_held_out_labels_teach_nothing(spark, mixed):
    from pyspark.sql import functions as F
    lied = mixed.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(tuple, language.language_digest(lied).collect()), key=repr) == sorted(map(tuple, language.language_digest(mixed).collect()), key=repr)
