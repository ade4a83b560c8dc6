"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is planned and run to the end with a ``noop`` sink, so all rows are produced and none are collected.
"""
from __future__ import annotations

import json
import os
import sys
import time

from assayer.catalog import REGISTRY
from assayer.session import build_session

HEADLINE = [
    "policy_summary", "kill_hits", "axis_correlation", "pair_agreement", "bootstrap_cluster", "fair_coin_null", "label_stability",
    "bracket", "pick_break", "race_score", "replay_rows", "replay_history", "conformance", "running_spend", "last_before", "unlanded_by_key", "golden_diff",
    "normalise", "same_words", "regex_scan", "severity_rollup", "redact", "caption_timing", "pack_chunks", "words_under_cue",
    "lag_correlation", "repeat_scan", "mirror_scan", "onsets", "rest_fraction", "consensus", "coverage_p95", "cast_verdict",
    "stream_dedupe", "stream_transitions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "assayer-bench", int(cpus) if cpus.isdigit() else 8, os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        t0 = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name:26s} {times[name]:8.3f}", file=sys.stderr)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
