"""Doctored ledgers, races, labels, sources, sinks and streams."""
import json

import pytest
from pyspark.sql import functions as F

from assayer.functions import scalars as S
from assayer.functions import verdicts as D
from assayer.operators import labels, ledger, measures, races, setops, validate
from assayer.plans import replay
from assayer.sources import readers, sinks
from assayer.streaming import jobs

RUN = "run STRING, seq BIGINT, kind STRING, step STRING, pass BOOLEAN, trail ARRAY<STRING>"


def test_replay_of_doctored_runs(spark):
    rows = [("good", 1, "gate", "ship_gate", True, None), ("good", 2, "deliver", "deliver", None, None), ("good", 3, "close", "ledger", None, ["board", "render", "closer", "build", "ad_gates"]),
            ("bad", 1, "gate", "ship_gate", True, None), ("bad", 2, "gate", "ship_gate", False, None), ("bad", 3, "deliver", "deliver", None, None),
            ("bad", 4, "waiting", "eye", None, ["board", "closer", "build"]), ("bad", 5, "resumed", "eye", None, ["board"]), ("bad", 6, "redacted", "x", None, None),
            ("early", 1, "deliver", "deliver", None, None), ("early", 2, "gate", "ship_gate", True, None)]
    got = {r["run"]: r for r in replay.replay_runs(spark.createDataFrame(rows, RUN), ledger.edges(spark, cross_run=True)).collect()}
    assert (got["good"]["moves"], got["good"]["unmapped"], got["good"]["unproven_deliveries"], got["good"]["end"]) == (4, 0, 0, "close")
    assert (got["bad"]["moves"], got["bad"]["unmapped"], got["bad"]["unproven_deliveries"]) == (2, 1, 1)
    assert (got["bad"]["stops"], got["bad"]["reentries"], got["bad"]["notes"], got["bad"]["last_step"]) == (0, 1, 1, "eye")
    assert got["early"]["unproven_deliveries"] == 1


def test_budget_is_inclusive_and_an_unpriced_request_stops_the_run(spark):
    rows = [("a", 1, 100), ("a", 2, 100), ("a", 3, 1), ("a", 4, 0), ("b", 1, None), ("b", 2, 5)]
    df = spark.createDataFrame(rows, "run STRING, seq BIGINT, cents BIGINT")
    got = {(r["run"], r["seq"]): r["state"] for r in ledger.running_spend(df, 200).collect()}
    assert got == {("a", 1): "sent", ("a", 2): "sent", ("a", 3): "refused", ("a", 4): "not sent", ("b", 1): "refused", ("b", 2): "not sent"}


def test_versions_proven_delivered(spark):
    w = spark.createDataFrame([("x", "withdrawn for v3, not dev9", 1), ("x", "again, see v4", 2), ("y", "no version", 1)], "ad STRING, reason STRING, ord BIGINT")
    g = spark.createDataFrame([("x", 1, 1), ("x", 2, 2)], "ad STRING, version INT, ord BIGINT")
    assert sorted(map(tuple, ledger.delivered_versions(w, g).collect())) == [("x", 2), ("x", 3), ("x", 4), ("y", 1)]


def test_history_rows_are_named_or_left_to_look_at(spark):
    cols = "shoot STRING, file STRING, line BIGINT, day STRING, kind STRING, scene STRING, engine STRING, leg STRING, status STRING, url STRING, roll INT, attempt INT, why STRING, reason STRING, mouth STRING, supersedes STRING, gate STRING, ad STRING, withdrawn ARRAY<STRUCT<ad: STRING>>"
    base = dict.fromkeys([c.strip().split(" ")[0] for c in cols.replace("ARRAY<STRUCT<ad: STRING>>", "X").split(",")])

    def row(**kw):
        return base | {"shoot": "s", "file": "requests.jsonl", "day": "2026-08-02"} | kw

    rows = [row(line=1, scene="mug-a", engine="omni"), row(line=2, scene="mug-a2", engine="omni"), row(line=3, scene="mug-a3", engine="omni", why="the author wants it"),
            row(line=4, scene="mug-b", engine="omni", roll=2, why="looks odd"), row(line=5, scene="mug-bed"),
            row(line=1, file="landings.jsonl", kind="withdrawn", day="2026-08-01", reason="the closer slips", withdrawn=[("mug",)]),
            row(line=2, file="landings.jsonl", kind="gated master", mouth="REVIEW; eye approved", ad="mug"), row(line=3, file="landings.jsonl", kind="strange")]
    named = replay.classify_history(spark.createDataFrame([tuple(r[k] for k in base) for r in rows], cols))
    assert [tuple(r) for r in replay.unknown_rows(named).collect()] == [("s", "landings.jsonl", 3)]
    got = sorted((r["src"], r["dst"], r["line"]) for r in replay.replay_history(named).collect())
    assert got == sorted([("render", "render", 2), ("review", "render", 3), ("eye", "render", 4), ("deliver", "review", 1), ("review", "closer", 1), ("ad_gates", "eye", 2)])


def test_set_operations_keep_multiplicity(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, None)], "k INT, v STRING")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "k INT, v STRING")
    assert sorted(map(tuple, setops.golden_diff(a, b).collect())) == [(1, "x", "missing", 1), (2, "y", "missing", 1), (2, "z", "added", 1)]
    assert setops.only_grew(b, b.union(a)).count() == 0 and setops.only_grew(a, b).count() == 2


def test_append_is_idempotent_and_refuses_a_conflict(spark, tmp_path):
    target = str(tmp_path / "ledger")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "id STRING, v INT")
    assert sinks.append_idempotent(target, rows, "id") == 2
    assert sinks.append_idempotent(target, rows, "id") == 0
    with pytest.raises(sinks.AppendConflict):
        sinks.append_idempotent(target, spark.createDataFrame([("b", 3), ("c", 1)], "id STRING, v INT"), "id")
    with pytest.raises(sinks.AppendConflict):
        sinks.append_idempotent(target, spark.createDataFrame([("d", 3), ("d", 3)], "id STRING, v INT"), "id")
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [("a", 1), ("b", 2)]


def readings(spark, table):
    return spark.createDataFrame([("b", e, p, float(v) if v is not None else None) for e, row in table.items() for p, v in row.items()], "brief STRING, engine STRING, probe STRING, value DOUBLE")


def panel(spark):
    return spark.createDataFrame([("b", "hand", "up", True), ("b", "bg", "down", False), ("b", "eye", "down", False)], "brief STRING, probe STRING, direction STRING, is_gate BOOLEAN")


def test_races(spark):
    def score(table):
        r = races.race_score(readings(spark, table), panel(spark)).first()
        return None if r is None else (r["winner"], r["decided_by"], r["top_wins"], r["leaders"])

    assert score({"x": {"hand": 5, "bg": 1, "eye": 3}, "y": {"hand": 4, "bg": 2, "eye": 1}}) == ("x", "row_count", 2, 1)
    assert score({"x": {"hand": 5, "bg": 1, "eye": 3}, "y": {"hand": 4, "bg": 1, "eye": 1}}) == ("x", "gate", 2, 2)
    assert score({"x": {"hand": 5, "bg": 1, "eye": 1}, "y": {"hand": 5, "bg": 1, "eye": 1}}) == (None, "unresolved_gate_tie", 3, 2)
    assert score({"x": {"hand": 5, "bg": 1, "eye": None}, "y": {"hand": 4, "bg": 2, "eye": 1}}) is None
    assert score({"x": {"hand": 5, "bg": 1, "eye": float("nan")}, "y": {"hand": 4, "bg": 2, "eye": 1}}) is None
    assert score({"x": {"hand": 5, "bg": 1, "eye": 1}}) is None


def test_tallies(spark):
    def state(*votes):
        v = spark.createDataFrame([("i", s, float(n)) for n, s in enumerate(votes)], "item STRING, state STRING, t DOUBLE")
        return labels.unanimous_tally(v, ["item"]).first()["state"], labels.lenient_tally(v, ["item"]).first()["state"], v

    assert state("fail", "fail", "fail")[:2] == ("fail", "fail")
    assert state("fail", "fail", None)[:2] == ("split", "fail")
    assert state("fail", "fail", "ok")[:2] == ("split", "split")
    assert state("ok", "ok", None)[:2] == ("ok", "ok")
    assert state("ok", None, None)[:2] == (None, None)
    assert labels.pick_break(state("fail", "fail", "fail", "fail")[2], ["item"]).first()["t"] == 1.0
    assert labels.pick_break(state("ok", "fail", "fail")[2], ["item"]).first()["t"] == 1.0


def test_brackets(spark):
    e = spark.createDataFrame([("m", "pass", 1.0), ("m", "pass", 3.0), ("m", "reject", 5.0), ("m", "marginal", 4.0), ("n", "pass", 1.0)], "axis STRING, verdict STRING, measured DOUBLE")
    g = spark.createDataFrame([("in", "m", "ceiling", 4.0, 1.0, True), ("out", "m", "ceiling", 5.0, 1.0, True), ("scaled", "m", "ceiling", 0.4, 10.0, False), ("half", "n", "floor", 0.5, 1.0, True),
                               ("wrong way", "m", "floor", 4.0, 1.0, True)], "constant STRING, axis STRING, polarity STRING, value DOUBLE, scale DOUBLE, gating BOOLEAN")
    got = {r["constant"]: (r["status"], r["n_excluded"]) for r in labels.bracket(e, g, ["axis"]).collect()}
    assert got == {"in": ("DERIVED", 1), "out": ("REFUTED", 1), "scaled": ("DERIVED", 1), "half": ("AUTHORED", 0), "wrong way": ("REFUTED", 1)}


def test_missing_readings_stay_a_third_outcome(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.2,)], "v DOUBLE")
    got = df.select(D.sync_verdict(F.col("v"), F.lit(0.0)), D.covered_verdict(F.col("v"), F.lit(0.9)), D.loudness_verdict(F.col("v"), F.lit(-2.0)), D.level_class(F.col("v")), D.late_start(F.col("v"))).collect()
    assert [tuple(r)[:3] for r in got[:2]] == [("UNMEASURED", "UNMEASURED", "UNREADABLE")] * 2
    assert [r[3] for r in got] == [None, None, "dim"] and not any(r[4] for r in got)


def test_routing(spark):
    def step(name, **facts):
        v = F.from_json(F.lit(json.dumps(facts)), D.NEXT_STEP_FACTS)
        return spark.range(1).select(D.next_step(F.lit(name), v)).first()[0]

    assert step("board", **{"pass": True}) == "render" and step("board", **{"pass": False}) == "ledger"
    assert step("render", failed=True, attempts=1) == "render" and step("render", failed=True, attempts=2) == "ledger" and step("render") == "closer"
    assert step("render", unconfirmed=True) == "ledger" and step("render", dry=True) == "ledger"
    assert step("ad_gates", mouth="pass", lag_s=0.11) == "ship_gate" and step("ad_gates", mouth="pass", lag_s=-0.12) == "eye"
    assert step("ad_gates", mouth="review", caption="fail") == "ledger" and step("ad_gates", mouth="noface") == "ledger" and step("ad_gates", unseen_flags=True) == "eye"
    assert step("eye", **{"pass": True}) == "ship_gate" and step("eye", cause="scene", attempts=1) == "render" and step("eye", cause="scene", attempts=2) == "ledger"
    assert step("eye", cause="lag", attempts=2) == "build" and step("eye", cause="lag", attempts=3) == "ledger"
    assert step("ship_gate", cause="replay") == "eye" and step("ship_gate", cause="replay", override=True) == "ledger" and step("ship_gate", **{"pass": True}) == "deliver"
    assert step("review", back_to="build", attempts=3) == "build" and step("review", back_to="build", attempts=4) == "ledger" and step("deliver") == "review"


def test_money_and_days(spark):
    r = spark.range(1).select(S.cents(F.lit("0.125")), S.cents(F.lit("0.135")), S.day_of_iso(F.lit("2026-08")), S.day_of_iso(F.lit("2026-08-01T01:02:03Z")).cast("string"), S.ts_precision(F.lit("2026-08-01")),
                              S.clip_of_url(F.lit("http://h/x/mug-omni-1.mp4")), S.engine_of_clip(F.lit("mug-omni-1")), S.fingerprint(F.lit("id"))).first()
    assert tuple(r)[:7] == (12, 14, None, "2026-08-01", "date", "mug-omni-1", "omni") and r[7].startswith("sha256:") and len(r[7]) == 19


def test_waivers_and_identity(spark):
    lines = spark.createDataFrame([("abcdef012345:Ann:seen it",), ("abcdef012345: :seen",), ("short:Ann:why",), ("",), ("abcdef012345:Ann:a:b",)], "line STRING")
    got = [(r["held"], r["waived_by"]) for r in validate.read_waivers(lines).collect()]
    assert got == [(True, "Ann"), (False, None), (False, None), (True, "Ann")]
    p = spark.createDataFrame([({"voice": "raw", "x": "/tmp/y"},), ({"voice": "sha256:abc"},), ({"voice": ""},)], "payload MAP<STRING, STRING>")
    assert [(r["raw_id"], r["local_path"]) for r in validate.raw_identity(p, "payload").collect()] == [(True, True), (False, False), (False, False)]
    s = p.select(validate.scrub(F.col("payload")).alias("s")).first()["s"]
    assert s["x"] == "<tmp>/y" and s["voice"].startswith("sha256:")


def test_cast_and_consensus(spark):
    rows = [("s", 0, True, .5), ("s", 0, False, .1), ("s", 1, True, .4), ("s", 1, False, .2), ("t", 0, True, .5), ("t", 0, False, .1), ("u", 0, False, .9)]
    df = spark.createDataFrame(rows, "scene STRING, frame INT, main BOOLEAN, sim DOUBLE")
    assert {r["scene"]: r["verdict"] for r in measures.cast_verdict(df, ["scene"], "frame", "main", "sim").collect()} == {"s": "FAIL", "t": "PASS", "u": "NOFACE"}
    takes = spark.createDataFrame([("g", f"t{i}", x, 10.0) for i, x in enumerate((10.0, 10.1, 9.9, 20.0))] + [("lone", "t", 1.0, 1.0)], "g STRING, take STRING, x DOUBLE, y DOUBLE")
    dev = measures.consensus(takes, ["g"], "take", "x", "y")
    assert {r["take"]: r["class"] for r in dev.collect()} == {"t0": "consensus", "t1": "consensus", "t2": "consensus", "t3": "DRIFTED"}
    assert measures.survivor(dev, ["g"], "take").first()["survivors"] == 3


def test_readers(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"run":"a","seq":1,"kind":"gate"}\n\n{"run":"a","seq":2,"kin\n{"run":"a","seq":3,"kind":"close"}')
    good, bad = readers.split_damaged(readers.parse_lines(readers.numbered_lines(spark, str(tmp_path / "l.jsonl"))))
    assert sorted((r["line_no"], r["seq"]) for r in good.collect()) == [(1, 1), (4, 3)] and [r["line_no"] for r in bad.collect()] == [3]
    direct = readers.read_ledger(spark, str(tmp_path / "l.jsonl"))
    assert direct.count() == 3 and direct.select("seq", "_file").where("seq = 3").first()["_file"].endswith("l.jsonl")
    (tmp_path / "e.csv").write_text("# note\nprobe,item,verdict,measured,axis,pixels,note\np,i,pass,1.5,a,,\n,skip,pass,1,a,,\np,j,reject,many,a,,\n")
    ok, wrong = readers.read_exemplars(spark, str(tmp_path / "e.csv"))
    assert [(r["item"], r["measured"]) for r in ok.collect()] == [("i", 1.5)] and [r["item"] for r in wrong.collect()] == ["j"]
    (tmp_path / "p.json").write_text(json.dumps({"panels": {"up": {"gate": "hand", "rows": [{"probe": "hand", "label": "x", "direction": "up", "bar": None}, {"probe": "bg", "direction": "down", "bar": 5.5}]}},
                                                 "briefs": {"b": {"panel_type": "up", "row_overrides": {"bg": {"direction": "up", "bar": None}}}, "c": {"panel_type": "up", "row_overrides": {}}}}))
    rows, briefs, over = readers.read_panels(spark, str(tmp_path / "p.json"))
    got = {(r["brief"], r["probe"]): (r["direction"], r["bar"], r["is_gate"]) for r in races.resolve_panels(briefs, rows, over).collect()}
    assert got == {("b", "hand"): ("up", None, True), ("b", "bg"): ("up", None, False), ("c", "hand"): ("up", None, True), ("c", "bg"): ("down", 5.5, False)}
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "mug.hand_probe.txt").write_text("noise\nHAND gesture ratio 0.412  (x)\n")
    (tmp_path / "out" / "mug.bg_detail.txt").write_text("nothing here\n")
    read, unread = readers.read_readings_text(spark, str(tmp_path / "out"))
    assert [(r["item"], r["reading"]) for r in read.collect()] == [("mug", 0.412)] and unread.count() == 1
    (tmp_path / "v.csv").write_text("pair_id,rater,winner,study\np1,r1,omni,s1\np1,r2,,s2\n")
    assert [r["winner"] for r in readers.read_votes(spark, str(tmp_path / "v.csv"), studies=["s2"]).collect()] == [None]
    (tmp_path / "pairs.json").write_text(json.dumps([{"pair_id": "p1", "brief": "b", "shoot": "s", "a": {"engine": "omni", "url": "h/mug-omni-1.mp4"}, "b": {"engine": "wan3", "url": "h/mug-wan3-1.mp4"}}]))
    assert readers.read_pairs(spark, str(tmp_path / "pairs.json")).first()["clip_b"] == "mug-wan3-1"
    m = readers.content_manifest(spark, str(tmp_path / "v.csv"))
    pins = m.select("path", F.lit("0").alias("sha256"))
    assert readers.against_pins(m, pins).first()["state"] == "differs" and readers.against_pins(m, m).first()["state"] == "match"


def test_stream_functions_over_several_batches(spark, tmp_path):
    src = tmp_path / "src"
    schema = "run STRING, seq BIGINT, id STRING, ts TIMESTAMP, cents BIGINT"
    parts = [[("a", 1, "x", "2024-01-01 00:00:00", 100), ("b", 1, "y", "2024-01-01 05:00:00", None)], [("a", 2, "x2", "2024-01-01 01:00:00", 100), ("a", 3, "x", "2024-01-02 00:00:00", 1)], [("a", 4, "z", "2024-01-01 00:30:00", 1)]]
    budget, late, target = (str(tmp_path / n) for n in ("budget", "late", "target"))
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, schema.replace("TIMESTAMP", "STRING")).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(src))
        s = jobs.stream_ledger(spark, str(src), schema)
        for name, fn in (("b", jobs.budget_guard(budget, 200)), ("l", jobs.late_rows(late, "ts", 3600))):
            jobs.run_function(s, fn, str(tmp_path / f"check-{name}"))
        jobs.run_to_folder(jobs.append_once(s.select("id"), "id"), target, str(tmp_path / "check-t")).awaitTermination()
    got = {(r["run"], r["seq"]): r["state"] for r in spark.read.parquet(f"{budget}/decisions").collect()}
    assert got == {("a", 1): "sent", ("b", 1): "refused", ("a", 2): "sent", ("a", 3): "refused", ("a", 4): "not sent"}
    assert sorted(r["seq"] for r in spark.read.parquet(f"{late}/late").collect()) == [2, 4]
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == ["x", "x2", "y", "z"]


def test_moves_are_found_over_batches_and_only_open_rows_are_kept(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    schema = "run STRING, seq BIGINT, step STRING, ts TIMESTAMP"
    edges = spark.createDataFrame([("s0", "s1"), ("s1", "s2")], "src STRING, dst STRING")
    rows = [(r, i, f"s{i % 3}", f"2024-01-{1 + i // 20:02d} {i % 20:02d}:00:00") for r in ("a", "b") for i in range(1, 301)]
    # A late predecessor, a step that is not known, a row without a run, a gap that never closes, a successor after the horizon.
    late = [x for x in rows if x[:2] == ("a", 50)]
    rows = [x for x in rows if x[:2] not in {("a", 50), ("b", 70)}] + [("c", 1, None, "2024-01-01 00:00:00"), (None, 1, "s0", "2024-01-01 00:00:00")]
    parts = [[x for x in rows if x[3] < "2024-01-06"], [x for x in rows if x[3] >= "2024-01-06"] + late + [("c", 2, "s1", "2024-01-07 00:00:00")],
             [("b", 301, "s1", "2024-06-01 00:00:00"), ("d", 1, "s0", "2024-06-01 00:00:00")], [("d", 2, "s0", "2024-06-01 00:00:00"), ("c", 3, "s2", "2024-06-01 00:00:00")]]
    kept = []
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema.replace("TIMESTAMP", "STRING")).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
        s = jobs.stream_ledger(spark, src, schema)
        query = jobs.run_to_folder(s, out, check, transform=jobs.transition_monitor(out, edges))
        query.awaitTermination()
        kept.append(spark.read.parquet(jobs.batch_path(out, n)).where("open").count())
    there = {(r, i): step for r, i, step, _ in sum(parts, []) if r and not (r, i) in {("b", 301), ("c", 3)}}
    want = {(r, i, s, there[r, i + 1]) for (r, i), s in there.items() if (r, i + 1) in there and (s, there[r, i + 1]) not in {("s0", "s1"), ("s1", "s2")}}
    assert {tuple(x) for x in jobs.moves_of(spark, out).collect()} == want and ("a", 49, "s1", "s2") not in want and ("c", 1, None, "s1") in want
    # Two a run and two a gap, however many rows have come; no state store holds any.
    assert kept[0] <= 2 * 3 + 4 and kept[1] <= 2 * 3 + 2 and max(kept) < 12


def test_state_folders_start_at_the_newest_compaction():
    assert jobs.state_paths("o", 0) == [] and jobs.state_paths("o", 1) == ["o/batch=0"]
    assert jobs.state_paths("o", 16) == [f"o/batch={b}" for b in range(16)]
    assert jobs.state_paths("o", 19) == ["o/batch=16", "o/batch=17", "o/batch=18"]


def test_budget_state_survives_a_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 2)
    guard = jobs.budget_guard(str(tmp_path), 100)
    for b, rows in enumerate([[("a", 1, 60), ("b", 1, 10)], [("b", 2, 20)], [("b", 3, 20)], [("a", 2, 40), ("b", 4, 51)], [("a", 3, 1), ("b", 5, 1)]]):
        guard(spark.createDataFrame(rows, "run STRING, seq BIGINT, cents BIGINT"), b)
    got = {(r["run"], r["seq"]): r["state"] for r in spark.read.parquet(f"{tmp_path}/decisions").collect()}
    refused = {k for k, v in got.items() if v != "sent"}
    assert refused == {("b", 4), ("a", 3), ("b", 5)} and got["b", 5] == "not sent" and got["a", 3] == "refused"


def test_outputs_saved_as_records_need_no_file_each(spark, tmp_path):
    rows = [(f"i{i}", ("hand_probe", "bg_detail")[i % 2], f"noise\nHAND gesture ratio {i}.5  (x)\n") for i in range(2_000)]
    spark.createDataFrame(rows, "item STRING, probe STRING, value STRING").coalesce(2).write.json(str(tmp_path / "out"))
    read, unread = readers.read_readings_records(spark, str(tmp_path / "out"))
    assert {(r["item"], r["reading"]) for r in read.collect()} == {(f"i{i}", i + 0.5) for i in range(0, 2_000, 2)}
    assert {r["item"] for r in unread.collect()} == {f"i{i}" for i in range(1, 2_000, 2)}


def test_file_readings_write_no_file_an_item(spark, tmp_path):
    import duckdb

    import __spark_entry__ as entry
    duckdb.sql(f"COPY (SELECT i AS s_suppkey, i / 7.0 - 9 AS s_acctbal FROM range(500) r(i)) TO '{tmp_path}/supplier.parquet' (FORMAT parquet)")
    df = entry.queries()["file_readings"](spark, str(tmp_path))
    assert df.count() == 500 and len(df.inputFiles()) < 50


def test_conflicts_of_an_id_that_repeats_on_both_sides_cost_no_pairs(spark):
    """One id in 20,000 rows of either side: 400 million pairs if they met row by row."""
    from assayer.sources import sinks
    rows = spark.range(20_000).selectExpr("IF(id < 19990, 7, id) AS id", "id % 3 AS v")
    old = rows.unionByName(spark.sql("SELECT NULL AS id, 1 AS v")).unionByName(spark.sql("SELECT 5 AS id, 1 AS v"))
    new = rows.unionByName(spark.sql("SELECT NULL AS id, v FROM VALUES (1), (1) AS t(v)")).unionByName(spark.sql("SELECT 5 AS id, 2 AS v")).unionByName(spark.sql("SELECT 6 AS id, 2 AS v"))
    found = sinks.conflicts(old, new, "id")
    assert sorted((r["id"] or 0, r["reason"]) for r in found.collect()) == [
        (0, "proposed twice"), (5, "recorded with other content"), (7, "proposed twice"), (7, "recorded twice"), (7, "recorded with other content")]
    # Each side is grouped behind its shuffle: no task that reads rows holds the ids it reads, and no rows are joined ungrouped.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and plan.count("REPARTITION_BY_COL") == 2
    assert plan.index("HashAggregate") < plan.index("REPARTITION_BY_COL")


def test_a_rule_scan_holds_texts_by_bytes():
    import pyarrow as pa

    from assayer.operators.rule_index import _slices
    texts = ["x" * n for n in (900_000, 900_000, 10, 3_000_000, 5)] + [None, ""] + ["y" * 300_000] * 9
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    got = list(_slices(iter([batch, batch.slice(0, 0)])))
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(len(texts)))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(1).to_pylist()[:-1]) <= 1 << 20 for b in got) and len(got) > 4


def test_survivors_alone_are_ranked_and_a_row_without_a_deviation_is_behind_all(spark):
    rows = [("g", i, d) for i, d in enumerate([None, 0.01, 0.14, 0.15, 0.02, 0.9, 0.02, None])] + [("h", 1, None), ("h", 3, 0.4), ("h", 2, 0.4), ("h", 4, 0.8), ("i", 9, None), ("i", 8, None)]
    got = measures.survivor(spark.createDataFrame(rows, "g STRING, take INT, deviation DOUBLE"), ["g"], "take")
    assert sorted(map(tuple, got.collect())) == [("g", 8, 5, 6), ("h", 4, 0, 2), ("i", 2, 0, 8)]
