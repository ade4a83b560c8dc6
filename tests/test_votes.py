"""Golden cases for votes, judge calls, resampling and replies."""
import itertools
import random

import pytest
from pyspark.sql import functions as F

from assayer.functions.replies import parse_replies
from assayer.operators import resampling as B
from assayer.operators import votes as V

CALL = "brief STRING, item STRING, judge STRING, rep INT, craft DOUBLE, message DOUBLE, warmth DOUBLE"


def calls(spark, *rows):
    return spark.createDataFrame([("b", i, "A", n, float(c) if c is not None else None, 5.0, 5.0) for n, (i, c) in enumerate(rows, 1)], CALL)


def test_kill_takes_the_lowest_and_the_smallest_name_on_a_tie(spark):
    t = V.item_total(calls(spark, ("z", 2), ("a", 2), ("m", 9)), ["brief", "item"])
    assert V.kill(t, ["brief"]).first()["killed"] == "a"
    assert sorted(r["item"] for r in V.ship(t, ["brief"]).collect()) == ["m", "z"]
    assert V.pick_top(t, ["brief"]).first()["picked"] == "m"


def test_fewer_than_three_items_are_not_killed(spark):
    t = V.item_total(calls(spark, ("a", 1), ("b", 2)), ["brief", "item"])
    assert V.kill(t, ["brief"]).first()["killed"] is None


def test_more_calls_only_move_the_mean(spark):
    t = {r["item"]: r["total"] for r in V.item_total(calls(spark, ("a", 1), ("a", 3), ("b", 2)), ["brief", "item"]).collect()}
    assert t == {"a": 12.0, "b": 12.0}


def test_calls_that_are_no_scores(spark):
    ok, bad = V.valid_calls(calls(spark, ("a", 5), ("b", None), ("c", float("nan")), ("d", 11), ("e", 0)))
    assert [r["item"] for r in ok.collect()] == ["a"]
    assert {r["item"]: r["reason"] for r in bad.collect()} == {"b": "missing", "c": "not a finite number", "d": "out of range", "e": "out of range"}


def vote_table(spark, rows):
    return spark.createDataFrame([(i, r, "b", a, b, w) for i, (r, a, b, w) in enumerate(rows)], "vote_id BIGINT, rater STRING, brief STRING, a STRING, b STRING, winner STRING")


def test_policy_lines_by_hand(spark):
    v = vote_table(spark, [("r1", "x", "y", "x"), ("r2", "y", "z", "y"), ("r3", "x", "z", None), ("r4", "x", "y", "y")])
    rates = V.pair_rates(V.both_directions(v, ["brief"]), ["brief"])
    val = {r["item"]: r["value"] for r in V.human_value(rates, ["brief"]).collect()}
    assert val == {"x": 0.5, "y": 0.75, "z": 0.25}
    totals = spark.createDataFrame([("b", "x", 1.0), ("b", "y", 2.0), ("b", "z", 3.0)], "brief STRING, item STRING, total DOUBLE")
    line = V.policy_lines(V.values_with_totals(V.human_value(rates, ["brief"]), totals, ["brief", "item"]), ["brief"]).first()
    assert (line["uniform"], line["gate"], line["pick"], line["oracle"]) == (0.5, 0.5, 0.25, 0.625)
    assert (line["killed"], line["worst"], line["picked"]) == ("x", "z", "z")


def test_round_robin_is_counted_and_not_enumerated(spark):
    p = spark.createDataFrame([("full", "a", "b"), ("full", "c", "b"), ("full", "c", "a"), ("gap", "a", "b"), ("gap", "b", "c")], "g STRING, x STRING, y STRING")
    assert {r["g"]: r["round_robin"] for r in V.round_robin(p, ["g"]).collect()} == {"full": True, "gap": False}


def test_no_hit_is_scored_without_a_round_robin(spark):
    s = spark.createDataFrame([("b", i, v, t) for i, v, t in (("x", .2, 1.), ("y", .5, 2.), ("z", .8, 3.))], "brief STRING, item STRING, value DOUBLE, total DOUBLE")
    met = spark.createDataFrame([("b", "x", "y"), ("b", "y", "z")], "brief STRING, x STRING, y STRING")
    assert V.kill_hits(s, met, ["brief"]).first()["hit"] is None
    full = met.union(spark.createDataFrame([("b", "z", "x")], met.schema))
    got = V.kill_hits(s, full, ["brief"]).first()
    assert (got["hit"], round(got["coin"], 6), got["kill_rank"]) == (True, 0.333333, 1)


def test_a_conflicting_pair_leaves_its_cell_unreported(spark):
    v = spark.createDataFrame([("j", "base", "1", "A"), ("j", "base", "2", "B"), ("j", "base", "2", "B"), ("j", "tail", "1", "A"), ("j", "tail", "1", "B")],
                              "judge STRING, variant STRING, pair_id STRING, pick STRING")
    got = {r["variant"]: (r["pairs"], r["conflicts"], r["picked_b"]) for r in V.position_bias(v, ["judge", "variant"]).collect()}
    assert got == {"base": (2, 0, 1), "tail": (1, 1, None)}


def test_rep_completeness_names_the_offender(spark):
    rows = [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1), ("c", 1)]
    df = spark.createDataFrame(rows, "item STRING, rep INT")
    assert [r["item"] for r in V.rep_completeness(df).collect()] == ["c"]


def test_at_least_is_the_exact_tail(spark):
    d = spark.range(1).select(*[B.at_least(F.array(F.lit(.25), F.lit(.25), F.lit(.25)), h).alias(f"h{h}") for h in range(5)]).first()
    assert [round(x, 6) for x in d] == [1.0, 0.578125, 0.15625, 0.015625, 0.0]
    mixed = spark.range(1).select(B.at_least(F.array(F.lit(.2), F.lit(.5), F.lit(.9)), 2).alias("p")).first()["p"]
    want = sum(a * b * c for a, b, c, n in ((.2 if i else .8, .5, .9 if k else .1, i + j + k) for i, j, k in itertools.product((0, 1), repeat=3)) if n >= 2)
    assert abs(mixed - want) < 1e-12


def test_exhaustive_bootstrap_is_every_resample(spark):
    lifts = spark.createDataFrame([("a", .1), ("b", .2), ("c", .6)], "brief STRING, lift DOUBLE")
    got = sorted(r["mean"] for r in B.exhaustive_means(lifts, "brief", "lift").collect())
    want = sorted(round(sum(x) / 3, 12) for x in itertools.product((.1, .2, .6), repeat=3))
    assert got == pytest.approx(want)
    seven = B.exhaustive_means(spark.range(7).selectExpr("id AS brief", "0.1D AS lift"), "brief", "lift")
    assert seven.agg(F.count("*"), F.min("mean"), F.max("mean")).first()[:] == (7 ** 7, 0.1, 0.1)


def test_weights_draw_each_slot_once_and_repeat(spark):
    w = B.unit_weights(spark, 10, 6, 3)
    assert [r["s"] for r in w.groupBy("rep").agg(F.sum("w").alias("s")).orderBy("rep").collect()] == [10] * 6
    assert sorted(map(tuple, w.collect())) == sorted(map(tuple, B.unit_weights(spark, 10, 6, 3).repartition(3).collect()))


def test_resample_of_whole_units_by_brute_force(spark):
    r = random.Random(2)
    rows = [(f"r{r.randrange(5)}", *x, r.choice([None, x[0], x[1]])) for x in (r.sample("wxyz", 2) for _ in range(60))]
    sides = V.both_directions(vote_table(spark, rows), ["rater", "brief"])
    from assayer.operators.ordered import dense_index
    index = {x["rater"]: x["idx"] for x in dense_index(sides, "rater").collect()}
    weights = {}
    for x in B.unit_weights(spark, 5, 3, 11).collect():
        weights[(x["rep"], x["idx"])] = x["w"]
    got = {(x["rep"], x["item"]): x["value"] for x in B.resampled_values(sides, "rater", "brief", 3, 11).collect()}
    for rep in range(3):
        pw = {}
        for rater, a, b, win in rows:
            k = weights.get((rep, index[rater]), 0)
            for p, q in ((a, b), (b, a)):
                s = pw.setdefault((p, q), [0, 0])
                s[0] += k * (1 if win == p else 0.5 if win is None else 0)
                s[1] += k
        for item in "wxyz":
            opp = [s[0] / s[1] for (p, _), s in pw.items() if p == item and s[1]]
            if opp:
                assert got[(rep, item)] == pytest.approx(sum(opp) / len(opp))


REPLIES = [
    ('{"craft": 7, "message": 6.5, "warmth": 5}', None), ('```json\n{"craft": 7, "message": 6, "warmth": 5}\n```', None),
    ('{"craft": 7, "note": "a } \\" {", "message": 6, "warmth": 5}', None), ('{"craft": 7, "message": 6, "warmth": 5, "why": {"a": [1]}}', None),
    ('Sure. {"craft": 7, "message": 6, "warmth": 5}', "not one JSON object"), ('{"craft": 7, "message": 6, "warmth": 5} done', "not one JSON object"),
    ('{"craft": 7, "message": 6, "warmth": 5}{"craft": 1}', "not one JSON object"), ('{"craft": 7, "message": 6, "war', "not one JSON object"),
    ('{"craft": 7, "craft": 2, "message": 6, "warmth": 5}', "duplicate key"), ('{"craft": NaN, "message": 6, "warmth": 5}', "not one JSON object"),
    ('{"craft": true, "message": 6, "warmth": 5}', "not a number"), ('{"craft": "7", "message": 6, "warmth": 5}', "not a number"),
    ('{"craft": 7, "message": 6}', "missing axis"), ('{"craft": 70, "message": 6, "warmth": 5}', "out of range"), ("[1, 2]", "not one JSON object"), ("", "not one JSON object"),
]


def test_replies_are_read_strictly(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(REPLIES)], "i INT, text STRING")
    got = {r["i"]: (r["reason"], r["craft"]) for r in parse_replies(df, "text", V.AXES).collect()}
    for i, (text, want) in enumerate(REPLIES):
        reason, craft = got[i]
        assert (reason is None) == (want is None), text
        if want:
            assert craft is None and reason == want, text
        else:
            assert craft == 7.0


def test_coins_are_digested_together(monkeypatch):
    """The digests of many ids are those of hashlib, which is asked only for nulls and for texts of more than one block."""
    from hashlib import md5

    from assayer.operators import resampling
    asked, ids = [], ["1", "22", None, "", "x" * 60, "é5", *[str(10 ** 6 + i) for i in range(150)]]
    monkeypatch.setattr(resampling, "md5", lambda text: asked.append(text) or md5(text))
    words = resampling.coin_words(ids, 125, 7)
    for r, i in enumerate(ids):
        for b in (0, 9, 10, 99, 100, 124):
            digits = md5((f"7:{b}" if i is None else f"7:{b}:{i}").encode()).hexdigest()
            assert int(words[r, b]) == sum((x >= "8") << k for k, x in enumerate(digits))
    assert len(asked) == 2 * 125
