"""Rule tables of any length over a corpus: literals that a rule's match must hold name the few rules worth trying on a line."""
from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from re import _constants as C
from re import _parser

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.leak_rules import Rule

#: Rules whose expressions take this many bytes are tried in one pass over the texts.
BLOCK_BYTES = 1 << 20


def python_regex(rule: Rule) -> str:
    return rule.regex.replace("[[:space:]]", r"\s").replace("[:space:]", r"\s")


def _needed(items) -> frozenset[str] | None:
    """Literals of which every match of a parsed sequence holds one; None if none can be told."""
    found: list[frozenset[str]] = []
    run: list[str] = []

    def close() -> None:
        if run:
            found.append(frozenset(["".join(run)]))
            run.clear()

    for op, arg in items:
        if op is C.LITERAL:
            run.append(chr(arg))
            continue
        if op is C.AT:
            continue
        close()
        inner: frozenset[str] | None = None
        if op is C.SUBPATTERN:
            inner = _needed(arg[3])
        elif op is C.ATOMIC_GROUP:
            inner = _needed(arg)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
            inner = _needed(arg[2])
        elif op is C.BRANCH:
            each = [_needed(b) for b in arg[1]]
            inner = frozenset().union(*each) if all(each) else None
        if inner:
            found.append(inner)
    close()
    # The longer the shortest of them, and the fewer they are, the fewer lines hold one.
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def required_literals(rule: Rule) -> frozenset[str] | None:
    """Literals of which a line has to hold one, up to case for a rule that ignores it, before the rule can match."""
    return _needed(_parser.parse(python_regex(rule), re.ASCII))


class RuleIndex:
    """One automaton over the required literals of all rules, case-folded; rules without any are tried on every line."""

    def __init__(self, rules: list[Rule]):
        self.rules, self.always, self.compiled = rules, [], {}
        by: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            need = required_literals(r)
            if not need:
                self.always.append(i)
            for word in {w.casefold() for w in need or ()}:
                by.setdefault(word, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for word, owners in by.items():
            self.automaton.add_word(word, owners)
        self.automaton.make_automaton()

    def candidates(self, text: str) -> set[tuple[int, int]]:
        """(line from 0, rule) pairs worth trying."""
        folded = text.casefold()
        ends = [m.start() for m in re.finditer("\n", folded)]
        out = {(n, i) for i in self.always for n in range(len(ends) + 1)}
        if len(self.automaton):
            for at, owners in self.automaton.iter(folded):
                line = bisect_left(ends, at)
                out.update((line, i) for i in owners)
        return out

    def matches(self, rule: int, line: str) -> bool:
        if rule not in self.compiled:
            r = self.rules[rule]
            self.compiled[rule] = re.compile(python_regex(r), re.ASCII | (re.IGNORECASE if r.any_case else 0))
        return self.compiled[rule].search(line) is not None

    def findings(self, text: str) -> list[tuple[int, int]]:
        """(line from 1, rule) of every line and rule that matches it."""
        lines = text.split("\n")
        return sorted((n + 1, i) for n, i in self.candidates(text) if self.matches(i, lines[n]))


def _slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches (key, text) in slices of about ``size`` bytes of text, so that what is held goes by bytes and not by rows."""
    for b in batches:
        if not b.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(lengths, dtype=np.int64) - lengths) // size
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist()
        for x, y in zip(starts, [*starts[1:], b.num_rows], strict=True):
            yield b.slice(x, y - x)


def rule_blocks(rules: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[Rule]]:
    """The rule table (severity, class, label, regex[, flags]) in blocks of about ``block_bytes``; rows without a regex are none.

    Blocks are dealt by a hash, so one of them at a time is on the driver, whatever the table's length.
    """
    kept = rules.where(F.coalesce(F.length("regex"), F.lit(0)) > 0)
    if "flags" not in kept.columns:
        kept = kept.withColumn("flags", F.lit(None).cast("string"))
    total = kept.agg(F.sum(F.octet_length("regex"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    at = F.pmod(F.xxhash64("severity", "class", "label", "regex"), F.lit(max(1, blocks)))
    for b in range(blocks):
        rows = kept.where(at == b).select("severity", "class", "label", "regex", "flags").collect()
        yield [Rule(r["severity"], r["class"], r["label"], r["regex"], "-i" in (r["flags"] or "")) for r in rows]


def scan_rule_table(docs: DataFrame, rules: DataFrame, text: str = "text", key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Findings (key, line_no, severity, class, label), one per line and row of a rule table of any length.

    A text is read once per block of rules. One automaton pass names the rules a line can match, and only these are tried. An
    expression that cannot be read is an error before anything is scanned. A null text has no lines.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, line_no bigint, severity string, class string, label string"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in rule_blocks(rules, block_bytes):
        for r in block:
            required_literals(r)
        shared = docs.sparkSession.sparkContext.broadcast(block)  # at most about ``block_bytes``

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = RuleIndex(shared.value)
            for b in _slices(batches):
                rows, found = [], []
                for i, t in enumerate(b.column(1).to_pylist()):
                    for hit in index.findings(t) if t is not None else ():
                        rows.append(i)
                        found.append(hit)
                told = [index.rules[r] for _, r in found]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array([n for n, _ in found], pa.int64()),
                                                  *[pa.array([getattr(r, c) for r in told], pa.string()) for c in ("severity", "cls", "label")]],
                                                 [key, "line_no", "severity", "class", "label"])

        out = out.unionByName(docs.select(key, text).mapInArrow(task, schema))
    return out
