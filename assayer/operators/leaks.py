"""Leak scanning: every rule over every line in one pass, suppressions, roll-ups and redaction."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.leak_rules import RULES, Rule
from assayer.operators.ordered import chunk_of, scan_in_order
from assayer.operators.spacing import spaced
from assayer.sources.sinks import severity_rank

# Fixed values.
INLINE_MARKER = "pii-allow"
PLATFORM_NAMES = ("runner", "root", "admin", "user", "ubuntu", "debian", "ec2-user", "jenkins", "ci", "build", "builder",
                  "github", "actions", "worker", "agent")
FILENAME_RULES = (
    Rule("BLOCKER", "CLASS2-VENDOR-ASSET-ID", "asset-id-in-filename", "[0-9a-f]{32}"),
    Rule("HIGH", "CLASS2-VENDOR-ASSET-ID", "uuid-in-filename", "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"),
    Rule("HIGH", "CLASS3-FIRST-PARTY", "stale-backup-file-in-tree", r"backup|\.bak$|\.keep$|~$|\.orig$"),
    Rule("BLOCKER", "CLASS1-CREDENTIALS", "secret-bearing-filename", r"^\.env$|^\.env\.|\.pem$|\.p12$|\.pfx$|\.key$|^id_rsa|^id_ed25519|\.plist$"),
)
ASCII_BORDER = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


_WORDS = r"\[[A-Za-z0-9_]+(?:-[A-Za-z0-9_]+)*\]"
_LEADING = re.compile(rf"(^|[|(])\\b(?=[A-Za-z0-9_]|{_WORDS})")
_TRAILING = re.compile(rf"((?<!\\)[A-Za-z0-9_]|{_WORDS}(?:\+|\{{[1-9][0-9]*(?:,[0-9]*)?\}})?)\\b(?=$|[|)])")


def java_regex(rule: Rule) -> str:
    """An extended regular expression as a Java one: POSIX classes spelled out, word borders over ASCII.

    A border next to something that can only be a word character needs a look to one side only.
    """
    p = rule.regex.replace("[[:space:]]", r"\s").replace("[:space:]", r"\s")
    p = _LEADING.sub(r"\1(?<![0-9A-Za-z_])", p)
    p = _TRAILING.sub(r"\1(?![0-9A-Za-z_])", p)
    p = p.replace(r"\b", ASCII_BORDER)
    return f"(?i){p}" if rule.any_case else p


def explode_lines(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per line, numbered from 1."""
    keep = keep or [c for c in docs.columns if c != text]
    return docs.select(*keep, F.posexplode(F.split(text, "\n", -1)).alias("__pos", "line")).select(
        *keep, (F.col("__pos") + 1).cast("bigint").alias("line_no"), "line")


def rules_from(df: DataFrame) -> list[Rule]:
    """A short rule table (severity, class, label, regex[, flags]) as rules of one plan; ``rule_index.scan_rule_table`` takes
    tables of any length."""
    out = []
    for r in df.collect():
        d = r.asDict()
        if d.get("regex"):
            out.append(Rule(d["severity"], d["class"], d["label"], d["regex"], "-i" in (d.get("flags") or "")))
    return out


def _guarded(c: Column, rule: Rule, mode: str = "") -> Column:
    hit = c.rlike(mode + java_regex(rule))
    if rule.any_case or not rule.guard:
        return hit
    near = c.contains(rule.guard[0])
    for g in rule.guard[1:]:
        near = near | c.contains(g)
    return near & hit


def regex_scan(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", key: str = "doc_id", keep_line: bool = False) -> DataFrame:
    """Findings (key, line_no, severity, class, label), one per line and rule.

    Two steps in one scan without a shuffle. The whole text is tried once per rule, in multi-line mode, which can only
    over-report; texts without any candidate, nearly all of a corpus, are dropped there. The lines of the others are
    then tried against their candidate rules alone.
    """
    # Outer generators and a late null test keep the optimizer from copying the rule array into a pushed-down filter,
    # which would run every rule twice.
    whole, line = F.col(text), F.col("line")
    maybe = [F.when(_guarded(whole, r, "(?m)"), F.lit(i)) for i, r in enumerate(rules)]
    tried = docs.select(key, text, F.array_compact(F.array(*maybe)).alias("__rules"))
    lines = tried.select(key, "__rules", F.posexplode_outer(F.when(F.size("__rules") > 0, F.split(text, "\n", -1))).alias("__pos", "line"))
    lines = lines.where("line IS NOT NULL").withColumn("line_no", (F.col("__pos") + 1).cast("bigint"))
    hits = [F.when(F.array_contains("__rules", i) & _guarded(line, r), F.struct(
        F.lit(r.severity).alias("severity"), F.lit(r.cls).alias("class"), F.lit(r.label).alias("label"))) for i, r in enumerate(rules)]
    cols = [key, "line_no"] + (["line"] if keep_line else [])
    return lines.select(*cols, F.inline_outer(F.array_compact(F.array(*hits)))).where("label IS NOT NULL")


def suppress(findings: DataFrame, allow: list[tuple[str, str]], path: str, line: str = "line", marker: str = INLINE_MARKER) -> DataFrame:
    """Adds ``suppressed``: the line carries the marker, or a (path part, label) entry of the allow list fits."""
    hit = F.coalesce(F.col(line).contains(marker), F.lit(False))
    for part, label in allow:
        hit = hit | (F.col(path).contains(part) & (F.col("label") == label))
    return findings.withColumn("suppressed", hit)


def glob_regex(glob: str) -> str:
    return "^" + "".join(".*" if ch == "*" else "." if ch == "?" else re.escape(ch) for ch in glob) + "$"


def dismiss(findings: DataFrame, ledger: list[tuple[str, str, str]], path: str, line: str = "line") -> DataFrame:
    """Adds ``dismissed_by``: the first human-reviewed entry (class, path glob, regex) that covers a finding, from 1."""
    out: Column = F.lit(None).cast("int")
    for i in range(len(ledger), 0, -1):
        cls, glob, regex = ledger[i - 1]
        fits = (F.col("class").rlike(glob_regex(cls))) & F.col(path).rlike(glob_regex(glob)) & F.col(line).rlike(regex)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return findings.withColumn("dismissed_by", out)


def severity_rollup(findings: DataFrame, by: tuple[str, ...] = ("severity", "class", "label")) -> DataFrame:
    """Counts at every level of ``by``, with how many were suppressed; ``level`` says how many columns are set."""
    g = findings.rollup(*by).agg(F.count(F.lit(1)).alias("findings"), F.sum(F.col("suppressed").cast("bigint")).alias("suppressed"),
                                 F.grouping_id().alias("__g"))
    n = len(by)
    level = F.lit(0)
    for i in range(n + 1):
        level = F.when(F.col("__g") == (1 << (n - i)) - 1, i).otherwise(level)
    return g.withColumn("level", level).drop("__g")


def scan_verdict(findings: DataFrame) -> DataFrame:
    """FAIL when a BLOCKER or HIGH is left, with the counts."""
    live = ~F.col("suppressed")
    return findings.agg(
        F.coalesce(F.sum((live & F.col("severity").isin("BLOCKER", "HIGH")).cast("bigint")), F.lit(0)).alias("failing"),
        F.coalesce(F.sum((live & ~F.col("severity").isin("BLOCKER", "HIGH")).cast("bigint")), F.lit(0)).alias("noted"),
        F.coalesce(F.sum(F.col("suppressed").cast("bigint")), F.lit(0)).alias("suppressed"),
    ).withColumn("verdict", F.when(F.col("failing") > 0, "FAIL").otherwise("PASS"))


def order_findings(findings: DataFrame, keys: list[str]) -> DataFrame:
    return findings.distinct().orderBy(severity_rank(), *keys)


def usable_names(names: list[str], owner: bool = False) -> list[str]:
    """Names safe to search for: no metacharacters; owner tokens are at least three long and no platform default."""
    ok = re.compile(r"[A-Za-z0-9._-]{3,}" if owner else r"[A-Za-z '-]+")
    keep = [x for x in names if x and not x.startswith("#") and ok.fullmatch(x)]
    return [x for x in keep if x.lower() not in PLATFORM_NAMES] if owner else keep


def name_rules(roster: list[str], owners: list[str], per_rule: int = 400) -> list[Rule]:
    """Roster and owner tokens as rules; a long list becomes several alternations under one label."""
    out = []
    for names, sev, cls, label, any_case in ((usable_names(roster), "BLOCKER", "CLASS4-THIRD-PARTY", "known-person-name", False),
                                             (usable_names(owners, True), "HIGH", "CLASS3-FIRST-PARTY", "owner-identity-token", True)):
        for i in range(0, len(names), per_rule):
            out.append(Rule(sev, cls, label, "|".join(n.replace(".", r"\.") for n in names[i:i + per_rule]), any_case))
    return out


def scan_names(docs: DataFrame, roster: list[str], owners: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Findings for names. A check without any usable name yields one SKIPPED row: skipped is not passed."""
    rules = name_rules(roster, owners)
    have = {r.label for r in rules}
    ktype = docs.schema[key].dataType.simpleString()
    skipped = [(lab,) for lab in ("known-person-name", "owner-identity-token") if lab not in have]
    out = None
    if rules:
        out = regex_scan(docs, rules, text, key).distinct()
    if skipped:
        s = docs.sparkSession.createDataFrame(skipped, "label STRING").select(
            F.lit(None).cast(ktype).alias(key), F.lit(None).cast("bigint").alias("line_no"), F.lit("SKIPPED").alias("severity"),
            F.lit("").alias("class"), "label")
        out = s if out is None else out.unionByName(s)
    return out


def scan_filenames(files: DataFrame, path: str, rules=FILENAME_RULES) -> DataFrame:
    """Findings on the last path element."""
    base = F.element_at(F.split(path, "/"), -1)
    hits = [F.when(base.rlike(r.regex), F.struct(F.lit(r.severity).alias("severity"), F.lit(r.cls).alias("class"), F.lit(r.label).alias("label"))) for r in rules]
    return files.select(*files.columns, F.inline(F.array_compact(F.array(*hits))))


def _context_kept(regex: str) -> str:
    """A first group that may match the line's start and a last one that may match its end only look at what they match."""
    if regex.startswith("(^|"):
        regex = "(?<=^|" + regex[3:]
    if regex.endswith("|$)"):
        at = regex.rindex("(")
        regex = f"{regex[:at]}(?={regex[at + 1:]}"
    return regex


def redact(text: Column, rules: list[Rule]) -> Column:
    """Matched spans of each line replaced by ``<label>``, rule by rule; line breaks and the context of a match stay.

    The text is tried once per rule, as in ``regex_scan``. Only lines that one of the rules found there matches are rewritten,
    and those by all rules in turn, since what one of them leaves may match another.
    """
    def rewritten(x: Column) -> Column:
        for r in rules:
            regex = java_regex(r).removeprefix("(?i)")
            x = F.regexp_replace(x, ("(?i)" if r.any_case else "") + _context_kept(regex), f"<{r.label}>")
        return x

    def line(x: Column, found: Column) -> Column:
        hit = F.lit(False)
        for i, r in enumerate(rules):
            hit = hit | (F.array_contains(found, i) & _guarded(x, r))
        return F.when(hit, rewritten(x)).otherwise(x)

    found = F.array_compact(F.array(*[F.when(_guarded(text, r, "(?m)"), F.lit(i)) for i, r in enumerate(rules)]))
    whole = lambda s: F.when(F.size(s["found"]) == 0, s["text"]).otherwise(
        F.array_join(F.transform(F.split(s["text"], "\n", -1), lambda x: line(x, s["found"])), "\n"))
    return F.transform(F.array(F.struct(text.alias("text"), found.alias("found"))), whole)[0]


def pack_chunks(docs: DataFrame, group: str, order: str, size: Column, max_size: int) -> DataFrame:
    """Pack whole documents in order: a pack closes once it holds ``max_size``. Adds ``pack_start``, the bytes of the
    group before the pack's first document.

    A pack starts at the first document at least ``max_size`` after the last start, counted in bytes before it, which
    is the greedy spacing rule, so a group is packed in parallel.
    """
    d = docs.withColumn("__size", size.cast("bigint"))
    at = scan_in_order(d, [group], [order], chunk_of(order), sums={"__end": F.col("__size")}).withColumn("__at", F.col("__end") - F.col("__size"))
    starts = spaced(at.select(group, "__at"), group, "__at", max_size, chunk_of("__at", max_size * 64))
    flagged = at.join(starts.withColumn("__start", F.col("__at")), [group, "__at"], "left")
    filled = scan_in_order(flagged, [group], [order], chunk_of(order), fill={"pack_start": F.col("__start")})
    return filled.drop("__end", "__at", "__start").withColumnRenamed("__size", "size")
