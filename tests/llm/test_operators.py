"""The operators against brute force on small fixtures, with nulls, empty and long texts, ties, repeats and clashing columns."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from assayer.llm import bpe, chat, contamination, passages, quality, sharding, simhash, substrings, token_files, toxicity, urls
from assayer.llm.components import components
from pyspark.sql import functions as F
from tokenizers import Tokenizer

P = pytest.importorskip("public_tokenizers")
PARTS = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "en", "ior", "ou", "st")]
WORDS = [a + b for a in PARTS for b in PARTS]
ODD = ["", " ", "\n\n", "a", "Ünï 日本 été", "  tab\there\r\nx  ", "don't we'll    ½ ²", "x" * 5000, "<|endoftext|> 12 345!!", "\x00\x1f\x85 q"]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base = [prose(i, 40 + 13 * i) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(base + base[:3] + ODD)] + [(90, None), (None, base[1]), (5, base[5]), (91, prose(99, 9000))]
    return spark.createDataFrame([(i, t, "text column", 1) for i, t in rows], "doc_id long, text string, words string, size int").cache()


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, shard int")


def test_bpe_is_that_of_the_library(docs):
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = Counter()
    for i, t in pairs(docs):
        ids = enc.encode_ordinary(t or "")
        want[(i, tuple(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    got = Counter((r["doc_id"], tuple(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_documents(docs, path, P.PATTERN).collect())
    assert got == want


def test_bpe_backtracks_where_the_longest_match_is_wrong():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"cd": 259, b"bcd": 260}
    b, enc = bpe.PairwiseBpe(ranks), tiktoken.Encoding("small", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    for _ in range(2000):
        t = "".join(r.choice("abcd") for _ in range(r.randint(1, 14)))
        assert b.encode(t.encode()) == enc.encode_ordinary(t), t


def test_token_files_round_trip(spark, docs, tmp_path):
    path, t = P.path("byte_bpe_50k.json"), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    d = docs.filter("doc_id IS NOT NULL")
    start, want = 0, []
    for i, text in sorted(pairs(d), key=lambda x: (x[0], x[1] or "")):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_files.token_digest(d, path, P.PATTERN, str(tmp_path / "t")).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert token_files.token_digest(empty(spark), path, P.PATTERN, str(tmp_path / "e")).count() == 0


def test_simple_8b_packs_any_number():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 59, 60, 61, 700):
        for high in (1, 2, 50_257, 1 << 31, (1 << 60) - 1, (1 << 63) + 5):
            x = r.integers(0, high, n, dtype=np.uint64, endpoint=True)
            x[: n // 2] %= np.uint64(3)
            assert (token_files.unpack(token_files.pack(x)) == x).all()
    assert len(token_files.pack(np.ones(600, np.uint64))) == 80


def test_shards_differ_by_one_row_and_keep_all(spark, docs):
    got = sharding.shard_digest(docs, 7).collect()
    by = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(7)}
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(v == list(range(len(v))) for v in by.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs(docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.shard(empty(spark)).count() == 0
    many = lambda: sorted((r["doc_id"] or 0, r["text"] or "", r["shard"], r["slot"]) for r in sharding.shard(docs, 4, bucket_bytes=2000).collect())
    assert many() == many()


def test_written_shards_hold_the_rows(spark, docs, tmp_path):
    path = sharding.write_shards(docs.select("doc_id", "text"), str(tmp_path / "s"), shards=3)
    assert Counter(pairs(spark.read.parquet(path))) == Counter(pairs(docs))


@pytest.mark.parametrize("block_bytes", [1 << 18, 300])
def test_contamination_against_brute_force(spark, docs, block_bytes):
    texts = dict(pairs(docs.filter("doc_id < 12")))
    items = [(1, " ".join(texts[3].split()[5:25]).upper()), (2, "  " + ", ".join(texts[4].split()[2:14])), (3, texts[6].split()[1]), (4, ""), (5, None), (None, texts[2]), (2, "zz"), (12, prose(5, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    owners = {}
    for i, t in items:
        w = word.findall(low(t))
        if i is not None and w:
            for k in range(max(1, len(w) - 9)):
                owners.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    want = Counter()
    for i, t in pairs(docs):
        w, hit, its = word.findall(low(t)), set(), set()
        for k in range(len(w)):
            for n in {len(o) for o in owners}:
                if own := owners.get(tuple(w[k:k + n])):
                    its |= own
                    hit.update(range(k, k + n))
        want[(i, len(w), len(hit), ",".join(sorted(its)))] += 1
    found = contamination.contamination(docs, bench, block_bytes=block_bytes).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in found) == want
    r = next(r for r in found if r["doc_id"] == 3)
    assert any(texts[3][s["start"]:s["end"]] == " ".join(texts[3].split()[5:25]) for s in r["spans"])
    clean = contamination.clean_of(docs, bench)
    assert {3, 4} & {i for i, _ in pairs(clean)} == set() and clean.columns == docs.columns
    assert contamination.contamination(empty(spark), bench).count() == 0


def fingerprint(t):
    import xxhash
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
    s = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(fps, tau=2):
    low_ = {f: f for f in fps}

    def find(x):
        while low_[x] != x:
            x = low_[x]
        return x
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= tau and find(a) != find(b):
                low_[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash_components_against_brute_force(spark, docs):
    rows = pairs(docs)
    roots = closure({fingerprint(t) for _, t in rows})
    least = {}
    for i, t in rows:
        if i is not None:
            r = roots[fingerprint(t)]
            least[r] = min(i, least.get(r, i))
    want = Counter((i, f"{fingerprint(t):016x}", least[roots[fingerprint(t)]]) for i, t in rows)
    assert Counter(map(tuple, simhash.simhash_digest(docs).collect())) == want
    assert simhash.simhash_digest(empty(spark)).count() == 0
    kept = [i for i, _ in pairs(simhash.keep_first(docs))]
    assert set(kept) == {*least.values(), None} and kept.count(5) == 2


def test_links_connect_crowded_and_sparse_fingerprints(spark):
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(400)}
    for centre in list(fps)[:3]:  # balls with more members than are compared one by one
        for _ in range(150):
            x = centre
            for b in r.sample(range(64), r.randint(1, 3)):
                x ^= 1 << b
            fps.add(x)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    got = components(simhash.link_fingerprints(spark.createDataFrame(signed, "fp long"))).collect()
    low_, want = {r["node"] % (1 << 64): r["root"] for r in got}, closure(fps)
    groups = lambda m: {frozenset(f for f in fps if m.get(f, f) == k) for k in {m.get(f, f) for f in fps}}
    assert groups(low_) == groups(want)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(20)] + [(7, 7), (None, 3), (200, 201), (201, 200), (200, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(20)} | {200: 200, 201: 200}


def test_passages_cover_all_shared_runs(spark, docs):
    shared, fuzzy = prose("s", 80), prose("f", 160).split()
    changed = [w if k % 23 else "other" for k, w in enumerate(fuzzy)]
    more = [(200 + i, f"{prose(300 + i, 60)} {shared} {prose(400 + i, 60)}") for i in range(30)]
    more += [(300, prose(1, 0) + " ".join(fuzzy)), (301, prose(8, 70) + " " + " ".join(changed)), (400, "Orre " * 300), (401, "orre " * 200), (402, prose(77, 400))]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = substrings.repeated_passages(d).collect()
    cover = {}
    for r in got:
        assert r["source_id"] < r["doc_id"] and r["similarity"] >= 0.8 and r["matched"] >= passages.MIN_MATCHED
        cover.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    first = {}
    for i, t in sorted((x for x in pairs(d) if x[0] is not None and x[1]), key=lambda x: x):
        w = low(t).split()
        for k in range(len(w) - 49):
            f = first.setdefault(" ".join(w[k:k + 50]), i)
            assert f == i or set(range(k, k + 50)) <= cover.get(i, set()), (i, k)
    assert len(cover[301]) >= 140 and 402 not in cover and 200 not in cover
    cut = {r["doc_id"]: r["text"] for r in substrings.cut_passages(d, substrings.repeated_passages(d)).filter("doc_id >= 200").collect()}
    assert shared in cut[200] and all(shared not in cut[i] and cut[i].startswith(prose(300 + i - 200, 60)) for i in range(201, 230))
    assert substrings.repeated_passages(empty(spark)).count() == 0


def test_chain_is_the_best_by_exhaustion():
    r = random.Random(2)
    k, cost = passages.KMER, passages.GAP_COST
    for _ in range(200):
        m = sorted({(r.randint(0, 30), r.randint(0, 30)) for _ in range(8)})
        best = {}
        for j, (p, s) in enumerate(m):
            best[j] = k + max([0.0, *(best[i] - cost * (p - q + s - t) / 2 for i, (q, t) in enumerate(m[:j]) if q < p and t < s)])
        value = lambda c: sum(k - cost * (b[0] - a[0] + b[1] - a[1]) / 2 for a, b in zip(c, c[1:], strict=False)) + k
        chains = passages.chains(m)
        assert sorted(x for c in chains for x in c) == m
        if max(abs(p - s) for p, s in m) <= 5:
            assert abs(max(map(value, chains)) - max(best.values())) < 1e-9


def test_urls():
    cases = {"http://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"), "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
             "https://x.example.net": ("x.example.net", "", None, "allow"), "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
             "http://w.org/fr/free-casino": ("w.org", "/fr/free-casino", "org/fr/", "allow"), "http://casino.example.org/": ("casino.example.org", "/", None, "block"),
             "http://casinos.org/": ("casinos.org", "/", None, "allow"), "http://a.org/free/bets": ("a.org", "/free/bets", None, "block"), "http://a.org/free/free": ("a.org", "/free/free", None, "allow"),
             "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://": ("", "", None, "allow")}
    judge = urls.UrlJudge()
    for url, want in cases.items():
        assert judge.judge(url)[:4] == want, url


def test_url_table(spark):
    d = spark.createDataFrame([(1, "http://a.net/x", "h"), (1, None, "h"), (None, "http://xxx.org", "h")], "page_id long, url string, host string")
    assert sorted((str(r["page_id"]), r["verdict"]) for r in urls.judge_urls(d).collect()) == [("1", "allow"), ("1", "block"), ("None", "block")]
    assert urls.judge_urls(d.limit(0)).count() == 0


def test_toxicity_learns_and_finds_misspellings(spark):
    bad = ["horrible", "wretched", "vermin", "imbecile"]
    r = random.Random(1)

    def text(i, toxic, words=bad):
        w = prose(i, 120).split()
        for _ in range(5 * toxic):
            w[r.randrange(len(w))] = r.choice(words)
        return " ".join(w)
    rows = [(i, text(i, i % 6 == 0), "x") for i in range(900)]
    d = spark.createDataFrame([(i, t, 9) for i, t, _ in rows] + [(2000, "", 9), (2001, None, 9), (None, "odd", 9)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(0, 900) if i % 2 == 0] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {x["doc_id"]: x for x in toxicity.toxicity_digest(d, labels).collect()}
    assert len(got) == 903 and all(0 <= x["score"] <= 1 for x in got.values())
    assert all(x["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, x in got.items())
    held = [i for i, x in got.items() if x["held_out"] and i < 900]
    assert sum(got[i]["predicted"] == (i % 6 == 0) for i in held) >= 0.95 * len(held)
    model = toxicity.fit(d, labels)
    typos = model.score([text(5000 + i, 1, ["horible", "wretchedd", "verminn", "imbecille"]) for i in range(40)])
    assert (typos >= 0.5).mean() >= 0.7
    assert toxicity.train([], []).score(["a"]).shape == (1,) and toxicity.score_toxicity(d.limit(0), model).count() == 0
    assert None in {i for i, _ in pairs(toxicity.mild_only(d, model))}


def test_chat_round_trip(spark):
    texts = ["hello", r"\### Assistant: </turn> ok", "### User: hi", "a\n</turn>", "\n</turn>\n### Assistant: x", "\\", "\\\\### ", "</turn", "###", "", None, "é日"]
    rows = [(c, t, r, x) for c, t, r, x in [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]]
    rows += [(2, 0, "tool: odd\n", "x"), (2, 1, None, "y"), (2, 1, None, "y"), (3, None, "assistant", "z"), (None, 0, "user", "w")]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, mask string")
    out = {r["conv_id"]: r for r in chat.format_conversations(d).collect()}
    for c, r in out.items():
        want = sorted(((-1 if t is None else t), x or "", y or "") for k, t, x, y in rows if k == c)
        assert r["identical"] and [(t["role"], t["text"]) for t in r["recovered"]] == [(x, y) for _, x, y in want]
        at, loss = 0, []
        for run in r["mask"]:
            loss += [r["formatted"][at:at + run["n_chars"]]] if run["trained"] else []
            at += run["n_chars"]
        assert at == len(r["formatted"]) and len(loss) == sum(x == "assistant" for _, x, _ in want)
    said = [x or "" for i, x in enumerate(texts) if i % 2]
    dig = {r["conv_id"]: r for r in chat.chat_digest(d).collect()}
    assert dig[1]["loss_sha256"] == hashlib.sha256("".join(said).encode()).hexdigest() and dig[1]["loss_chars"] == sum(map(len, said))
    assert "### " not in re.sub(r"(?m)^### (User|Assistant): |\\+### ", "", out[1]["formatted"])
    assert chat.chat_digest(d.limit(0)).count() == 0


def test_quality_counts(spark, docs):
    again = " ".join(prose(1, 30).split() + prose(2, 8).split() + prose(3, 5).split() + prose(2, 8).split())
    more = [(500, again), (501, "Wher. " * 60), (502, "a | b | c | d\n" * 9 + "x"), (503, (prose(4, 30) + ".\n") * 2 + "word*** sign### odd$$$ all&&&"), (504, prose(7, 40) + "\nAll rights reserved.")]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = quality.judge_quality(d).collect()
    want = Counter()
    for i, t in pairs(d):
        t = t or ""
        w, seen, dup, cover = re.findall(r"[^\x20\x09-\x0D]+", t), set(), 0, set()
        for x in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        n = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        for k in range(len(w) - 7):
            if n[tuple(w[k:k + 8])] > 1:
                cover.update(range(k, k + 8))
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w))] += 1
    assert Counter(tuple(r)[:7] for r in got) == want
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not kept[501] and not kept[502] and kept[504] and kept[11]
    assert next(r["cleaned"] for r in got if r["doc_id"] == 504) == prose(7, 40)
    assert quality.judge_quality(empty(spark)).count() == 0


def test_native_operators_run_no_python(spark, docs):
    conv = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for df in (quality.judge_quality(docs), chat.chat_digest(conv), sharding.shard(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    assert docs.select(F.count("*")).first()[0] > 0


def test_one_very_long_piece_is_encoded_in_small_memory():
    import resource
    import time
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    own, enc = bpe.PairwiseBpe(ranks), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(4)
    many = ["".join(r.choice("ab-=日é") for _ in range(r.randrange(2_000, 5_000))) for _ in range(12)] + ["-" * 3_000, "=-" * 2_500, "a" * 4_099]
    for t in many:
        assert own._encode_long(t.encode()) == own.encode(t.encode()) == enc._core_bpe.encode_single_piece(t.encode())
    before, started = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
    assert own.bytes_of[own.encode(b"-" * 1_000_000)[0]][:1] == b"-"
    assert time.process_time() - started < 5 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
