"""URL filter: host and path rules first, then a weighted vocabulary of strict and soft terms."""
from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from assayer.llm.scan import scan

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
STRICT = ("adult", "casino", "escort", "hardcore", "hentai", "malware", "phishing", "porn", "poker", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "crack", "dating", "farm", "free", "jackpot", "loan", "loans", "pills", "prize",
        "sex", "slots", "track", "tracker", "win", "winner")
SOFT_HITS = 2

_LOWER = {c: c + 32 for c in range(65, 91)}


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    host, rest = rest[:end].translate(_LOWER), rest[end:]
    stop = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    return host, rest[:stop]


class UrlJudge:
    def __init__(self, rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS):
        self.rules = {}
        for rule, verdict in rules:
            host, _, path = rule.partition("/")
            self.rules.setdefault(host, []).append((f"/{path}", rule, verdict))
        self.soft_hits, self.terms = soft_hits, ahocorasick.Automaton()
        for weight, words in ((1, soft), (self.soft_hits, strict)):
            for w in words:
                self.terms.add_word(w, (w, weight))
        self.terms.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule whose host is the url's or a parent of it and whose path starts the url's."""
        best, name = None, host
        while name:
            for start, rule, verdict in self.rules.get(name, ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            name = name.partition(".")[2]
        return best

    def hits(self, url: str) -> dict[str, int]:
        """Terms found between characters that are no ASCII letters or digits, with their weights."""
        low, found = url.translate(_LOWER), {}
        inner = lambda i: 0 <= i < len(low) and low[i].isascii() and low[i].isalnum()
        for end, (word, weight) in self.terms.iter(low) if low else ():
            if not inner(end + 1) and not inner(end - len(word)):
                found[word] = weight
        return found

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, int]:
        host, path = parts(url)
        weight = sum(self.hits(url or "").values())
        if found := self.rule(host, path):
            return host, path, *found, weight
        return host, path, None, "block" if weight >= self.soft_hits else "allow", weight


def judge_urls(df: DataFrame, url_col: str = "url", id_col: str = "page_id", **how) -> DataFrame:
    """(id, host, path, rule, verdict, weight) per row of ``df``.

    Weight: a strict term counts as ``soft_hits``, each distinct soft term as 1; a url without a rule is blocked from
    ``soft_hits`` on. A null url has an empty host and path, no rule, and is allowed. Ids are passed through, null or
    repeated. Only the two named columns are read.
    """
    kind = dict(df.dtypes)[id_col]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = UrlJudge(**how)
        for b in batches:
            rows = list(zip(*map(judge.judge, b.column(1).to_pylist()), strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(r, pa.string()) for r in rows[:4]), pa.array(rows[4], pa.int32())],
                                             [id_col, "host", "path", "rule", "verdict", "weight"])

    return scan(df.select(id_col, url_col), task, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, weight int")
