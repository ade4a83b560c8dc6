"""The stages one after another, each held against its own input."""
import re

import corpus_pipeline
import pytest
from assayer.llm import contamination, toxicity
from assayer.llm.scan import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF).cache()
        out.append((name, docs, kept))
        docs = kept
    return {name: (a, b) for name, a, b in out}


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_stay_but_for_the_last(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "byte_bpe"]
    for name, (before, after) in stages.items():
        assert after.columns == before.columns or name == "byte_bpe"


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.fit(before, table(spark, SF, "labels"))
    want = sorted(r["doc_id"] for r in before.collect() if model.score([r["text"] or ""])[0] < 0.5)
    assert ids(after) == want


def test_one_of_each_group_stays(stages):
    """All pairs of texts that share four fifths of their five-word shingles, by brute force."""
    before, after = stages["near_duplicates"]
    docs = sorted((r["doc_id"], re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))) for r in before.collect())
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for _, w in docs]
    low = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((low[i], low[j]))
                low = [a if x == b else x for x in low]
    want = sorted({docs[x][0] for x in low})
    assert ids(after) == want and len(want) < len(docs)


def test_repeats_are_cut_and_clean_texts_stay(stages):
    before, after = stages["repeated_passages"]
    a, b = ({r["doc_id"]: r for r in d.collect()} for d in (before, after))
    assert a.keys() == b.keys() and all(r["n_chars"] == len(r["text"]) for i, r in b.items() if r["text"] != a[i]["text"])
    seen, shared = {}, set()
    for i in sorted(a):
        w = re.findall(r"\S+", a[i]["text"].lower())
        for k in range(len(w) - 16):
            if seen.setdefault(tuple(w[k:k + 17]), i) != i:
                shared.add(i)
    assert all(b[i]["text"] == a[i]["text"] for i in a.keys() - shared)
    first = {}
    for i in sorted(b):
        w = re.findall(r"\S+", b[i]["text"].lower())
        assert all(first.setdefault(tuple(w[k:k + 50]), i) == i for k in range(len(w) - 49))


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    hit = {r["doc_id"] for r in contamination.contamination(before, table(spark, SF, "benchmark")).filter("n_hit > 0").collect()}
    assert ids(after) == sorted(set(ids(before)) - hit)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages["byte_bpe"][1].select("doc_id", "ids_sha256").collect()))


def test_empty_tables_and_texts_go_through_all_stages(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "", None, None, None), (None, "one two three", "en", "s", 13), (None, None, None, None, None)], docs.schema)
    for start in (docs.limit(0), odd):
        kept = start
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, SF).cache()
            assert kept.columns == docs.columns or name == "byte_bpe"
            assert kept.count() <= start.count()
        assert (kept.count() > 0) == (start is odd)
