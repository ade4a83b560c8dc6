"""The leak scan as a SQL table function, for ad hoc use on a few texts. ``operators.leaks.regex_scan`` is the plan for a corpus."""
from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from assayer.functions.leak_rules import RULES, Rule


def register_scan(spark: SparkSession, name: str = "scan_text", rules: list[Rule] = RULES) -> None:
    """Register ``name(text)`` returning (line_no, severity, class, label)."""

    class Scan:
        def __init__(self):
            posix = [r.regex.replace("[[:space:]]", r"\s").replace("[:space:]", r"\s") for r in rules]
            self.rules = [(r, re.compile(p, re.ASCII | (re.IGNORECASE if r.any_case else 0))) for r, p in zip(rules, posix, strict=True)]

        def eval(self, text: str):
            for n, line in enumerate((text or "").split("\n"), 1):
                for r, pattern in self.rules:
                    if pattern.search(line):
                        yield n, r.severity, r.cls, r.label

    spark.udtf.register(name, udtf(Scan, returnType="line_no BIGINT, severity STRING, class STRING, label STRING"))
