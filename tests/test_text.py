"""Spoken and written lines, captions, leak scanning and board lint."""
import random
import re

import pytest
from pyspark.sql import functions as F

from assayer.functions import text as X
from assayer.functions.leak_rules import RULES, Rule, parse_rules
from assayer.functions.similarity import similarity_ratio, word_opcodes
from assayer.operators import leaks as K
from assayer.operators import lint as B
from assayer.plans import captions as P

c = F.col
TENS = ["", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety"]
SMALL = list(X.UNITS)[:20]


def in_words(n, r):
    """A number below ten million as words, hyphens and ``and`` drawn at random."""
    if n >= 1_000_000:
        return in_words(n // 1_000_000, r) + " million" + (" " + in_words(n % 1_000_000, r) if n % 1_000_000 else "")
    if n >= 1_000:
        return in_words(n // 1_000, r) + " thousand" + (" " + in_words(n % 1_000, r) if n % 1_000 else "")
    if n >= 100:
        return SMALL[n // 100] + " hundred" + (r.choice([" ", " and "]) + in_words(n % 100, r) if n % 100 else "")
    return SMALL[n] if n < 20 else TENS[n // 10] + (r.choice([" ", "-"]) + SMALL[n % 10] if n % 10 else "")


def drawn_word(r, low=4, high=9):
    return "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(r.randint(low, high) // 2 + 1))


def drawn(r):
    """A line as words, one number among them."""
    words = [drawn_word(r) for _ in range(r.randint(3, 8))]
    at = r.randrange(len(words))
    return words, at, r.choice([r.randrange(10), r.randrange(100), r.randrange(1_000), r.randrange(1_000_000)])


def line(words, at, number):
    return " ".join([*words[:at], str(number), *words[at:]])


# Name of an edit: what it makes of a drawn line. Each draws no letter anew.
KEEP = {
    "spelled number": lambda w, i, n, r: line(w, i, in_words(n, r)),
    "grouped digits": lambda w, i, n, r: line(w, i, f"{n:,}"),
    "capitals": lambda w, i, n, r: line(w, i, n).upper(),
    "blanks": lambda w, i, n, r: line(w, i, n).replace(" ", r.choice(["  ", "\t", "\n", "\u00a0"])),
    "stops and commas": lambda w, i, n, r: line([x + r.choice([",", ".", "!", "?", ";", ""]) for x in w], i, n),
    "curly quotes": lambda w, i, n, r: "\u201c" + line(w, i, n) + "\u201d",
    "a dash": lambda w, i, n, r: line([w[0] + r.choice([" \u2014", " -", "\u2013"]), *w[1:]], max(1, i), n) if i else "- " + line(w, i, n),
}
SPLIT = {
    "hyphen in a word": lambda w, i, n, r: line([w[0][:2] + "-" + w[0][2:], *w[1:]], i, n),
    "points in a word": lambda w, i, n, r: line([*w[:-1], w[-1][:3] + "." + w[-1][3:]], i, n),
}
CHANGE = {
    "a letter": lambda w, i, n, r: line([w[0][:-1] + "xy"[w[0][-1] == "x"], *w[1:]], i, n),
    "a word less": lambda w, i, n, r: line(w[1:], max(0, i - 1), n),
    "a word more": lambda w, i, n, r: line([*w, "more"], i, n),
    "the next number": lambda w, i, n, r: line(w, i, n + 1),
    "digits apart": lambda w, i, n, r: line(w, i, f"{n} {n}"),
    "a space in a word": lambda w, i, n, r: line([w[0][:2] + " " + w[0][2:], *w[1:]], i, n),
    "two words in one": lambda w, i, n, r: line([w[0] + w[1], *w[2:]], max(0, i - 1), n),
    "a point between digits": lambda w, i, n, r: line(w, i, f"1{n}.{n}") + " ",
}


@pytest.mark.parametrize(("edits", "verdict"), [(KEEP, "MATCH"), (SPLIT, "MATCH (split)"), (CHANGE, "MISMATCH")])
def test_edits_keep_split_or_change_words(spark, edits, verdict):
    r, rows = random.Random(len(edits)), []
    for name, edit in edits.items():
        for _ in range(25):
            words, at, number = drawn(r)
            rows.append((name, line(words, at, number), edit(words, at, number, r)))
    df = spark.createDataFrame(rows, "edit STRING, a STRING, b STRING")
    got = df.select("*", X.same_words(c("a"), c("b")).alias("v"), X.same_words(c("b"), c("a")).alias("w")).collect()
    wrong = [tuple(x) for x in got if x["v"] != verdict or x["w"] != verdict]
    assert not wrong, wrong[:5]


def test_prices_and_clocks_are_said_as_numbers(spark):
    r, rows = random.Random(7), []
    for _ in range(60):
        noun, price, hour, minute = drawn_word(r), r.randrange(1, 1_000_000), r.randrange(1, 24), r.randrange(10, 60)
        rows += [(f"{noun} for ${price:,}", f"{noun} for {in_words(price, r)} dollars"), (f"{noun} until {hour}:00", f"{noun} until {in_words(hour, r)}"),
                 (f"{noun} at {hour:02d}:{minute}", f"{noun} at {in_words(hour, r)} {minute}")]
    got = spark.createDataFrame(rows, "a STRING, b STRING").select("a", "b", X.same_words(c("a"), c("b")).alias("v")).where("v <> 'MATCH'").collect()
    assert not got, got[:5]


def test_number_words(spark):
    r, rows = random.Random(11), []
    for _ in range(200):
        n, m, noun = r.randrange(10_000_000), r.randrange(10), drawn_word(r)
        rows.append((f"{in_words(n, r)} {noun}", f"{n} {noun}"))
        rows.append((f"{noun} and {in_words(n, r)}, {noun}", f"{noun} and {n} {noun}"))
        # A unit can't follow a unit or a teen, nor a ten a ten: two numbers.
        rows.append((f"{SMALL[m]} {SMALL[r.randrange(10)]}", None))
        rows.append((f"{TENS[2 + m % 8]} {TENS[2 + n % 8]}", f"{10 * (2 + m % 8)} {10 * (2 + n % 8)}"))
        rows.append((f"{SMALL[10 + m]} {SMALL[m]} {noun}", f"{10 + m} {m} {noun}"))
        rows.append((f"a {r.choice(list(X.SCALES))}", None))
    rows = [(t, w if w is not None else " ".join(str(X.UNITS[x]) for x in t.split()) if t[:2] != "a " else str(X.SCALES[t[2:]])) for t, w in rows]
    df = spark.createDataFrame(rows, "t STRING, want STRING").select("t", "want", F.array_join(X.tokens(c("t")), " ").alias("got"))
    wrong = [tuple(x) for x in df.collect() if x["got"] != x["want"]]
    assert not wrong, wrong[:5]


def test_sentences_words_and_diffs(spark):
    r = spark.createDataFrame([("One. Two!  Three? Four.\n", "a b c", "a x c")], "t STRING, a STRING, b STRING").select(
        X.sentence_count(F.col("t")).alias("n"), X.word_count(F.lit("  a  b ")).alias("w"), X.word_count(F.lit(" ")).alias("z"),
        X.word_diff(F.col("a"), F.col("b")).alias("d"), word_opcodes(F.split("a", " "), F.split("b", " ")).alias("o")).first()
    assert (r["n"], r["w"], r["z"]) == (4, 2, 0)
    assert (r["d"]["removed"], r["d"]["added"], r["o"]) == (["b"], ["x"], ["replace: b / x"])


def test_ratio_never_passes_its_bound(spark):
    df = spark.createDataFrame([("abcd", "abcd"), ("abcdefghij", "abcdefghix"), ("ab", "abcdefgh"), ("", ""), ("xy", "abcdefgh")], "a STRING, b STRING")
    got = [r[0] for r in df.select(similarity_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.9, 0.4, 1.0, 0.0]


def test_captions(spark):
    words = spark.createDataFrame([("d", w, float(i), i + 0.5) for i, w in enumerate("only one hundred ninety nine dollars today".split())], "doc STRING, text STRING, start_s DOUBLE, end_s DOUBLE")
    cue = "doc STRING, cue INT, text STRING, start_s DOUBLE, end_s DOUBLE, spoken_start DOUBLE, spoken_end DOUBLE"
    cues = spark.createDataFrame([("d", 1, "Only $199", 0.0, 5.6, 0.0, 5.5), ("d", 2, "Only $999", 0.0, 5.6, 0.0, 5.5), ("d", 3, "Only $199 today", 0.0, 7.0, 0.0, 5.5),
                                  ("d", 4, "nothing", 50.0, 51.0, 50.0, 51.0), ("d", 5, "today", 5.2, 6.6, 6.0, 6.5)], cue)
    got = {r["cue"]: (r["ok"], list(r["faults"])) for r in P.caption_check(words, cues, ["doc"]).collect()}
    assert got[1][1] == ["text"] or got[1][0]  # dollars is spoken and written
    assert "numbers" in got[2][1]
    assert got[3] == (False, ["missed words"]) and got[4] == (False, ["no word"])
    assert "missed words" in got[5][1] or "early" in got[5][1]
    v = P.caption_verdict(P.caption_check(words, cues, ["doc"]), spark.createDataFrame([("d",), ("empty",)], "doc STRING"), ["doc"])
    assert {r["doc"]: r["verdict"] for r in v.collect()} == {"d": "FAIL", "empty": "FAIL"}


def test_every_rule_finds_what_its_expression_finds(spark):
    lines = ["mail a.b@c.org", "ip 10.1.2.3 and 300.1.1.1", "sk-ant-" + "a" * 24, "key AKIA" + "A1" * 8, "x 0123456789abcdef0123456789abcdef y", "at 23:15 sharp",
             "é0123456789abcdef0123456789abcdef", "call +14155550100 or 415-555-0100", "* * * * *", "0 5 * * 1", "host db1.internal", "ABC-123 ticket", "every morning",
             "https://u:secretpw@h.io/", "\tnothing", "", "token_" + "a" * 30, "com.acme.tool-x", "Europe/Paris", "2024-01-02 03:04", "namespace prod-1", "staging12"]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "clean text")], "doc_id BIGINT, text STRING")
    got = sorted((r["line_no"], r["label"]) for r in K.regex_scan(df).collect())
    want = sorted((n, r.label) for r in RULES for n, line in enumerate(lines, 1)
                  if re.search(r.regex.replace("[[:space:]]", r"\s").replace("[:space:]", r"\s"), line, re.A))
    assert got == want and len(want) > 15


def test_case_flag_reaches_a_table_rule(spark):
    table = "# comment\n\nHIGH\tX\tany\tthe name\t-i\nLOW\tX\texact\tThe Name\n"
    rules = parse_rules(table)
    df = spark.createDataFrame([(1, "the name\nTHE NAME\nThe Name\nno")], "doc_id BIGINT, text STRING")
    got = sorted((r["label"], r["line_no"]) for r in K.regex_scan(df, rules).collect())
    assert got == [("any", 1), ("any", 2), ("any", 3), ("exact", 3)]
    frame = spark.createDataFrame([("HIGH", "X", "any", "the name", "-i"), ("LOW", "X", "blank", "", None)], "severity STRING, class STRING, label STRING, regex STRING, flags STRING")
    assert [r.any_case for r in K.rules_from(frame)] == [True]


def test_names_are_cleaned_and_a_missing_roster_is_skipped(spark):
    df = spark.createDataFrame([(1, "Anne-Marie met o'connor and RUNNER")], "doc_id BIGINT, text STRING")
    got = {(r["severity"], r["label"]) for r in K.scan_names(df, ["Anne-Marie", "O'Connor", "x|y"], ["runner", "ab"]).collect()}
    assert got == {("BLOCKER", "known-person-name"), ("SKIPPED", "owner-identity-token")}


def test_suppress_dismiss_and_redact(spark):
    f = spark.createDataFrame([("src/a", "C1", "mail", "x pii-allow"), ("src/a", "C1", "mail", "x"), ("src/b", "C1", "mail", "y1")], "path STRING, class STRING, label STRING, line STRING")
    assert [r["suppressed"] for r in K.suppress(f, [("src/b", "mail")], "path").collect()] == [True, False, True]
    assert [r["dismissed_by"] for r in K.dismiss(f, [("C2", "*", "."), ("C1", "src/?", "[0-9]")], "path").collect()] == [None, None, 2]
    r = spark.createDataFrame([("mail a@b.org now",)], "t STRING").select(K.redact(F.col("t"), [x for x in RULES if x.label == "email-address"])).first()[0]
    assert r == "mail <email-address> now"
    secret = "key\nsk-" + "a1" * 20 + "\nnext\nSprint\n42 (sk-" + "b2" * 20 + ")"
    hidden = spark.createDataFrame([(secret,)], "t STRING").select(K.redact(F.col("t"), list(RULES))).first()[0]
    assert hidden == "key\n<model-api-key-legacy>\nnext\nSprint\n42 (<model-api-key-legacy>)"


def test_word_borders_are_ascii():
    assert r"\b" not in K.java_regex(Rule("", "", "", r"\bab\b|x\b|(\b[0-9]{3}\b)"))


def test_packs_hold_every_document_once(spark):
    sizes = [5000, 8000, 100, 12000, 1, 1, 11999, 3]
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate(sizes)], "source STRING, doc_id BIGINT, bytes BIGINT")
    got = {r["doc_id"]: r["pack_start"] for r in K.pack_chunks(df, "source", "doc_id", F.col("bytes"), 12_000).collect()}
    packs, current, size = [], [], 0
    for i, n in enumerate(sizes):
        current.append(i)
        size += n
        if size >= 12_000:
            packs.append(current)
            current, size = [], 0
    packs += [current] if current else []
    by_start = {}
    for i, s in got.items():
        by_start.setdefault(s, []).append(i)
    assert sorted(sorted(v) for v in by_start.values()) == sorted(packs)


BOARD = {"spot": "mug", "brand": "Acme", "scenes": {"a": "A mug. Nobody speaks.", "b": "The mug tips, mouth closed.", "c": "Acme closes it, nobody speaks."},
         "narration": "You drop it. You look. You laugh.", "quirk": "gravity reversed", "hook": "a", "order": None, "chain": None, "slots": None, "props": ["mug", "saucer"],
         "switches": "slots", "escalation": False, "character_noun": None, "scores": {"hook": 3, "realism": 2, "absurdity": 2, "logic": 3}, "scored_by": "eye", "guard": "keep the middle third"}
BROKEN = {
    "product_absent": {"scenes": BOARD["scenes"] | {"a": "Acme mug. Nobody speaks."}}, "escalation": {"scenes": BOARD["scenes"] | {"b": "It solves it, nobody speaks."}},
    "quirk_unspoken": {"narration": "Gravity fails. You look. You laugh."}, "mouths_closed": {"scenes": BOARD["scenes"] | {"b": "The mug tips."}},
    "crop_clause": {"guard": "anything"}, "cast": {"scenes": BOARD["scenes"] | {"b": "A woman, mouth closed."}}, "register": {"narration": "She drops it. You look. You laugh."},
    "chain": {"chain": ["a", "c", "b"]}, "slots": {"slots": [["a"], ["b"]]}, "switches": {"switches": "loud"}, "props": {"props": ["Mug", " mug"]}, "hook_first": {"hook": "b"},
    "scene_length": {"scenes": BOARD["scenes"] | {"b": "mouth closed " + "word " * 80}},
}


@pytest.mark.parametrize("rule", [None, *BROKEN])
def test_one_failing_board_per_rule(spark, rule):
    board = BOARD | (BROKEN[rule] if rule else {})
    r = B.lint(spark.createDataFrame([board], B.BOARD_SCHEMA)).first()
    assert list(r["failed"]) == ([rule] if rule else []) and r["verdict"] == ("FAIL" if rule else "PASS")


def test_more_board_shapes(spark):
    def lint(**kw):
        return B.lint(spark.createDataFrame([BOARD | kw], B.BOARD_SCHEMA)).first()

    assert lint(slots=[["a"], ["b"], ["c"]], chain=["a", "c"], order=["a", "b", "c"])["verdict"] == "PASS"
    assert lint(scenes={})["verdict"] == "FAIL"
    assert "order" in lint(order=["b", "a", "c"])["why"]["hook_first"]
    assert "hook_first" in lint(slots=[["b"], ["a"], ["c"]])["failed"]
    pronoun = BOARD["scenes"] | {"b": "{character} lifts her mug, mouth closed."}
    assert lint(scenes=pronoun)["verdict"] == "PASS"
    assert "chain" in lint(scenes=pronoun, chain=["a", "b"])["failed"]
    card = B.score_card(spark.createDataFrame([BOARD | {"scores": {"hook": 1, "realism": 9, "logic": 2}, "scored_by": " "}], B.BOARD_SCHEMA)).first()
    assert card["unmet"] == {"hook": "under 2", "realism": "not a whole number from 0 to 3", "absurdity": "missing", "scored_by": "missing"}


def test_long_runs_of_number_words(spark):
    big = " ".join(["hundred"] * 12)  # 10^24 is beyond 64 bits
    rows = [("a " * 20_000, " ".join(["a"] * 20_000)), ("one " * 20_000, " ".join(["1"] * 20_000)), (big, str(100 ** 12)),
            ("two " + "hundred " * 2_700, "2" + "0" * 5_400), ("six and " * 5_000 + "six", " ".join(["6 and"] * 5_000) + " 6")]
    df = spark.createDataFrame(rows, "t STRING, want STRING")
    got = df.select("want", F.array_join(X.tokens(c("t")), " ").alias("got"), X.same_words(c("t"), c("want")).alias("v"), X.numbers_equal(c("t"), c("want")).alias("e"),
                    X.split_only(X.marked_tokens(c("t")), X.marked_tokens(F.replace(c("t"), F.lit("a a "), F.lit("a-a ")))).alias("s")).collect()
    assert all(x["got"] == x["want"] and x["v"] == "MATCH" and x["e"] and x["s"] for x in got), [x["got"][:80] for x in got]
    none = spark.createDataFrame([(None, "one"), (None, None)], "a STRING, b STRING").select(
        X.tokens(c("a")).alias("t"), X.normalise(c("a")).alias("n"), X.numbers_equal(c("a"), c("b")).alias("e"), X.same_words(c("a"), c("b")).alias("v")).collect()
    assert {tuple(x) for x in none} == {(None, None, None, "NOTHING COMPARED")}
