"""Parts that must hold for long keys, long rule tables and many draws, each against the plain rule."""
import random
import re
from hashlib import md5

import numpy as np
import pytest
from assayer.functions.leak_rules import RULES, Rule
from assayer.operators import leaks as K
from assayer.operators import ledger as L
from assayer.operators import resampling as B
from assayer.operators import rule_index as I
from assayer.operators import series, spacing
from assayer.operators.ordered import chunk_of
from pyspark.sql import functions as F


def greedy(times, gap):
    out = []
    for t in sorted(set(times)):
        if not out or t >= out[-1] + gap:
            out.append(t)
    return out


@pytest.mark.parametrize(("gap", "width"), [(7, 20), (50, 20), (3, 1)])
def test_spacing_over_ten_thousand_chunks_of_a_key(spark, gap, width):
    r = np.random.default_rng(gap)
    hot = np.unique(r.integers(-5_000, 12_000 * width, 30_000))
    few = [5, 6, 7, 9_000, 9_001]
    rows = [("hot", int(t)) for t in hot] + [("few", t) for t in few] + [("none", None), (None, 3)]
    df = spark.createDataFrame(rows, "k STRING, t BIGINT")
    got = spacing.spaced(df, "k", "t", gap, chunk_of("t", width)).collect()
    assert sorted(x["t"] for x in got if x["k"] == "hot") == greedy(hot.tolist(), gap)
    assert sorted(x["t"] for x in got if x["k"] == "few") == greedy(few, gap) and len({x["k"] for x in got}) == 2
    assert spacing.spaced(df.limit(0), "k", "t", gap, chunk_of("t", width)).count() == 0


def test_tables_of_chunks_compose(spark):
    r = np.random.default_rng(1)

    def table(ts, gap):
        ends = []
        for i in range(len(ts)):
            last = ts[i]
            for t in ts[i:]:
                last = t if t >= last + gap else last
            ends.append(last)
        n = min(int(np.searchsorted(ts, ts[0] + gap)) + 1, len(ts))
        return ts[:n], np.array(ends[:n])
    for _ in range(500):
        ts, gap = np.unique(r.integers(0, r.integers(5, 200), r.integers(2, 60))), int(r.integers(1, 30))
        cut = int(r.integers(1, len(ts))) if len(ts) > 1 else 0
        if cut:
            got, want = spacing.compose(table(ts[:cut], gap), table(ts[cut:], gap), gap), table(ts, gap)
            assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_spend_with_missing_prices_and_refunds(spark):
    r = random.Random(3)
    rows = [(run, seq, None if r.random() < 0.004 * run else r.randrange(-20, 60)) for run in range(4) for seq in range(900)] + [(None, 1, 5), (None, 2, 999_999)]
    df = spark.createDataFrame(rows, "run BIGINT, seq BIGINT, cents BIGINT").repartition(5)
    for width in (7, 300, 10_000):
        got = {(x["run"], x["seq"]): (x["spent"], x["state"]) for x in L.running_spend(df, 6_000, chunk_of("seq", width)).collect()}
        spent, broke = {}, {}
        for run, seq, cents in rows:
            spent[run] = spent.get(run, 0) + (cents or 0)
            state = "not sent" if broke.get(run) else "refused" if cents is None or spent[run] > 6_000 else "sent"
            broke[run] = broke.get(run) or state == "refused"
            assert got[run, seq] == (spent[run], state)
    plan = L.running_spend(df, 6_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 0 and "CartesianProduct" not in plan


def test_five_thousand_rules_find_what_each_finds(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("bcdfgaeiou") for _ in range(6))
    names = [word() for _ in range(4_950)]
    rules = [("LOW", "N", f"name-{i}", rf"\b{n}\b" if i % 3 else f"({n}|{n[::-1]})[0-9]*", "-i" if i % 2 else None) for i, n in enumerate(names)]
    rules += [("HIGH", "X", f"digits-{i}", rf"[0-9]{{{3 + i}}}", None) for i in range(50)] + [("LOW", "N", "none", None, None), ("LOW", "N", "blank", "", None)]
    texts = [(i, "\n".join(" ".join(r.choice([word(), r.choice(names), r.choice(names).upper(), str(r.randrange(10 ** 6))]) for _ in range(8)) for _ in range(5))) for i in range(40)]
    texts += [(90, None), (91, "")]
    table = spark.createDataFrame(rules, "severity STRING, class STRING, label STRING, regex STRING, flags STRING")
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id BIGINT, text STRING, label STRING")
    want = sorted((i, n, lab) for _, _, lab, rx, flag in rules if rx for p in [re.compile(rx, re.A | (re.I if flag else 0))]
                  for i, t in texts if t is not None for n, line in enumerate(t.split("\n"), 1) if p.search(line))
    for size in (1 << 20, 20_000):
        got = I.scan_rule_table(docs, table, block_bytes=size).collect()
        assert sorted((x["doc_id"], x["line_no"], x["label"]) for x in got) == want
    assert len(want) > 500 and I.scan_rule_table(docs, table.limit(0)).count() == 0


@pytest.mark.parametrize(("regex", "needs"), [
    (r"\bhf_[A-Za-z0-9]{28,}", {"hf_"}), ("a(bcd|ef)+g", {"bcd", "ef"}), ("(x|)abc?", {"ab"}), ("[0-9]{3}", None), ("a|[bc]", None), ("(?:foo)?bar.baz9", {"baz9"}), ("(key|token)=x", {"key", "token"}),
])
def test_required_literals(regex, needs):
    assert I.required_literals(Rule("", "", "", regex)) == (needs and frozenset(needs))


def test_builtin_rules_need_what_the_index_says():
    r = random.Random(1)
    for rule in RULES:
        need = I.required_literals(rule)
        p = re.compile(I.python_regex(rule), re.A)
        for _ in range(40):
            line = " ".join(r.choice(["sk-ant-" + "a" * 24, "AKIA" + "A1" * 8, "a.b@c.org", "10.1.2.3", "every morning", "ABC-123", "/home/me", "20:15", "2024-01-02", "Sprint 4", "+14155550100"]) for _ in range(3))
            assert not need or not p.search(line) or any(x in line for x in need)


def test_redaction_is_that_of_all_rules_in_turn(spark):
    r = random.Random(8)
    bits = ["sk-ant-" + "a" * 24, "AKIA" + "A1" * 8, "a.b@c.org", "10.1.2.3", "every morning", "ABC-123", "/home/me", "20:15", "2024-01-02 03:04", "plain", "Sprint", "0123456789abcdef" * 2, "* * * * *", "-", "x"]
    texts = ["\n".join("".join(r.choice([" ", "", "-", "="]) + r.choice(bits) for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 5))) for _ in range(150)] + ["", "\n", None, "a\n\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")

    def chained(x):
        for rule in RULES:
            x = F.regexp_replace(x, K._context_kept(K.java_regex(rule)), f"<{rule.label}>")
        return x
    plain = F.array_join(F.transform(F.split("t", "\n", -1), chained), "\n")
    got = df.select("i", K.redact(F.col("t"), list(RULES)).alias("a"), plain.alias("b")).collect()
    assert [x["a"] for x in got] == [x["b"] for x in got] and sum(x["a"] != t for x, t in zip(got, texts, strict=True)) > 100


def test_vertical_counters_count():
    r = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 31, 1_000):
        words = r.integers(0, 1 << 32, (n, 5), dtype=np.uint32)
        want = np.unpackbits(words.view(np.uint8).reshape(n, -1), axis=1, bitorder="little").sum(axis=0) if n else np.zeros(160)
        assert (B.vertical_counts(words) == want).all()


def test_coins_are_the_hex_digits_of_the_digests(spark):
    words = B.coin_words(["17", None], 3, 7)
    for b in range(3):
        for i, name in enumerate((f"7:{b}:17", f"7:{b}")):
            want = [int(d, 16) >= 8 for d in md5(name.encode()).hexdigest()]
            assert [bool(words[i, b] >> k & 1) for k in range(32)] == want
    r = random.Random(2)
    votes = [(i, "g" if i % 9 else None, *r.sample("pqr", 2)) for i in range(400)]
    df = spark.createDataFrame(votes, "vote_id BIGINT, brief STRING, a STRING, b STRING")
    won = {}
    for i, g, a, b in votes:
        for rep in range(40):
            heads = int(md5(f"5:{rep // 32}:{i}".encode()).hexdigest()[rep % 32], 16) >= 8
            for item, other, points in ((a, b, heads), (b, a, not heads)):
                won.setdefault((rep, g, item), {}).setdefault(other, []).append(points)
    want = {k: round(sum(sum(v) / len(v) for v in o.values()) / len(o), 12) for k, o in won.items()}
    got = {(x["rep"], x["brief"], x["item"]): x["value"] for x in B.coin_values(df, "vote_id", "brief", 40, 5).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_packed_weights_are_the_unit_weights(spark):
    units, reps = 1_300, 9
    want = {(x["rep"], x["idx"]): x["w"] for x in B.unit_weights(spark, units, reps, 4).collect()}
    got = {}
    for x in B.packed_weights(spark, units, reps, 4).collect():
        for i, w in enumerate(np.frombuffer(x["w"], "<u2")):
            if w:
                got[x["rep"], x["block"] * B.UNITS + i] = int(w)
    assert got == want


def test_unequal_trials_and_a_hundred_thousand(spark):
    r = np.random.default_rng(6)
    rows = [("few", i, float(p)) for i, p in enumerate(r.random(40))] + [("one", 0, 0.25), ("sure", 0, 1.0), ("sure", 1, 0.0), ("null", 0, None), ("null", 1, 0.5)]
    df = spark.createDataFrame(rows, "k STRING, i BIGINT, p DOUBLE")
    got = {(x["k"], h): x["tail"] for h in (0, 1, 20, 41) for x in B.successes_at_least(df, "k", "i", "p", h).collect()}
    dist = np.array([1.0])
    for k, _, p in rows:
        if k == "few":
            dist = np.convolve(dist, [1 - p, p])
    assert all(abs(got["few", h] - dist[h:].sum()) < 1e-12 for h in (0, 1, 20, 41))
    assert [got[k, 1] for k in ("one", "sure", "null")] == [0.25, 1.0, 0.5]
    n = 100_000
    many = spark.range(n).select(F.lit("m").alias("k"), "id", (0.2 + (F.col("id") % 7) / 10).alias("p"))
    p = 0.2 + np.arange(n) % 7 / 10
    mean, sd = p.sum(), np.sqrt((p * (1 - p)).sum())
    tails = {z: B.successes_at_least(many, "k", "id", "p", int(mean + z * sd)).first() for z in (-2, 0, 2)}
    assert all(x["n"] == n for x in tails.values())
    assert abs(tails[0]["tail"] - 0.5) < 5e-3 and abs(tails[2]["tail"] - 0.02275) < 1e-3 and abs(tails[-2]["tail"] - 0.97725) < 1e-3


def test_spaced_top_k_limits_before_the_shuffle(spark):
    df = spark.range(60_000).select(F.lit("s").alias("k"), F.col("id").alias("pos"), F.rand(1).alias("change"), F.rand(2).alias("energy"))
    found = series.spaced_top_k(df, "k", "pos", "change", "energy", 10, 6, 50, 0.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # From the bottom up: rank in chunks on the rows' own partitioning, then a shuffle of what is left.
    ranks = [line for line in plan.splitlines()[::-1] if "row_number" in line and "Window" in line or "Exchange hashpartitioning" in line or "Filter (__rk" in line]
    first_rank = next(i for i, x in enumerate(ranks) if "row_number" in x)
    assert sum("Exchange" in x for x in ranks[:first_rank]) == 1
    rows = {x["pos"]: (x["change"], x["energy"]) for x in df.collect()}
    chosen = []
    for i in sorted(rows, key=lambda i: (-round(rows[i][1], 9), i)):
        peak = max(range(max(0, i - 6), min(60_000, i + 7)), key=lambda j: (rows[j][0], -j))
        if all(abs(peak - x) >= 50 for x in chosen):
            chosen.append(peak)
        if len(chosen) == 10:
            break
    assert sorted(x["pos"] for x in found.collect()) == sorted(chosen)


def test_differences_at_all_lags_by_convolution():
    r = np.random.default_rng(4)
    for whole in (True, False):
        x, y = (r.integers(-40, 40, 90).astype(float) if whole else r.normal(size=90) for _ in range(2))
        hx, hy = r.random(90) < 0.8, r.random(90) < 0.9
        total, both = series.lag_differences(x, y, hx, hy, whole)
        for d in range(-89, 90):
            at = [p for p in range(90) if 0 <= p + d < 90 and hx[p] and hy[p + d]]
            want = sum((x[p] - y[p + d]) ** 2 for p in at)
            assert both[d + 89] == len(at) and (total[d + 89] == want if whole else abs(total[d + 89] - want) < 1e-9)


def test_repeats_of_a_million_samples_and_of_gaps(spark):
    n, period = 1_000_000, 217_351
    wave = F.col("id") % period
    long = spark.range(n).select(F.lit("long").alias("series"), F.col("id").alias("pos"), ((wave * 7_919 + wave * wave % 1_013) % 997).cast("double").alias("v"))
    got = series.repeat_scan(long, "series", "pos", "v").first()
    assert (got["period"], got["share"], got["verdict"]) == (period, 0.0, "REPLAYS")
    r = random.Random(3)
    rows = [(k, i, None if r.random() < 0.05 else float(r.randrange(30))) for k in ("a", "b") for i in range(400) if r.random() < 0.97]
    df = spark.createDataFrame(rows, "series STRING, pos BIGINT, v DOUBLE")
    for fps, most in ((1, None), (3, None), (2, 40)):
        got = {x["series"]: (x["period"], x["share"]) for x in series.repeat_scan(df, "series", "pos", "v", fps=fps, max_period=most, floor=0.0).collect()}
        for k in ("a", "b"):
            at = {i: v for s, i, v in rows if s == k}
            m = max(at) + 1
            known = {i: v for i, v in at.items() if v is not None}
            pairs = [(known[i] - known[(i + m // 3) % m]) ** 2 for i in known if i % 11 == 0 and (i + m // 3) % m in known]
            tops = [x for x in range(5, m) if x < m / fps / 1.5 and x <= m // fps - 1 and x <= (most or m)]
            msd = {}
            for x in tops:
                d = [(known[i] - known[i + x * fps]) ** 2 for i in known if i % 5 == 0 and i + x * fps in known]
                if d:
                    msd[x] = round(sum(d) / len(d), 9)
            best = min(msd, key=lambda x: (msd[x], x))
            assert got[k][0] == best and abs(got[k][1] - msd[best] / max(sum(pairs) / len(pairs), 1e-9)) < 1e-9


def test_drawn_counts_are_the_draws_of_spark(spark):
    # 12,345 slots have one to five digits; the last seed's text is longer than a block of the digest.
    for seed, rep, units in ((7, 0, 12_345), (7, 3_999, 999), (10 ** 60, 5, 40), (3, 1, 1), (3, 1, 0)):
        slots = spark.range(units).select(B.draw(seed, units, F.lit(rep), "id").alias("idx")) if units else None
        want = dict(slots.groupBy("idx").count().collect()) if units else {}
        got = B.drawn_counts(seed, rep, units)
        assert len(got) == units and {int(i): int(got[i]) for i in np.flatnonzero(got)} == want


def test_unit_weights_are_drawn_without_a_shuffle(spark):
    df = B.unit_weights(spark, 5_000, 3, 9)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert sum(x["w"] for x in df.collect()) == 15_000


def test_guards_hold_for_every_alternative(spark):
    lines = ["10.0.0.1", "at 192.168.1.7 now", "172.16.0.3", "172.31.9.9", "on EKS now", "namespace a1", "namespace ab-cd", "staging7", *[f"{k}0ABCDEFGH1" for k in "UDCBTGWE"],
             "while you are asleep", "while they were asleep", "every morning", "every night", "every evening", "overnight run", "overnight session", "wake time", "goes to sleep",
             "just-past-midnight", "before dawn", "before sunrise", "Calendar.app", "Mail.app", "iCloud", "Photos library", "osascript -e Mail", *[f"she {v}: 'no'" for v in
             ("said", "says", "asked", "wrote", "told me")], "credit remaining", "credits remaining", "credit balance", "billing cycle", "renewal date", "subscription tier", "Plan: pro",
             "session transcript", "session transcripts", "/projects/x.jsonl", "history/logs.md", "self-model", "job search", "job-search"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id BIGINT, text STRING")
    slow = ("private-lan-address", "internal-cluster-reference", "chat-workspace-object-id", "presence-or-routine-prose", "personal-mail-or-calendar-ingest",
            "private-conversation-quote", "account-financial-state", "private-corpus-ingest")
    rules = [r for r in RULES if r.label in slow]
    assert len(rules) == len(slow) and all(r.guard and "." not in r.guard for r in rules)
    got = sorted(tuple(x) for x in K.regex_scan(docs, rules).collect())
    assert {x[0] for x in got} == set(range(len(lines)))
    assert got == sorted(tuple(x) for x in K.regex_scan(docs, [r._replace(guard=()) for r in rules]).collect())
