"""The queries of this subpackage and the SQL they must agree with."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import (bpe, chat, contamination, language, merkle, quality, resampling, sharding, simhash, substrings, token_files,
                         toxicity, urls)
from assayer.llm.scan import table

RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def op1_repeated_passages(spark: SparkSession, d: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, d, "documents"))


def op2_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return contamination.contamination_digest(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op3_shard(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_digest(table(spark, d, "documents"))


def op4_token_files(spark: SparkSession, d: str) -> DataFrame:
    return token_files.token_digest(table(spark, d, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op5_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urls.judge_urls(table(spark, d, "pages"))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_chat_format(spark: SparkSession, d: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.chat_digest(table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe))


def op8_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge_quality(table(spark, d, "documents")).drop("cleaned")


def op9_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, d, "documents"))


def op10_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_documents(table(spark, d, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=False)


def op11_merkle(spark: SparkSession, d: str) -> DataFrame:
    return merkle.merkle_digest(table(spark, d, "documents"))


def op12_language(spark: SparkSession, d: str) -> DataFrame:
    return language.language_digest(table(spark, d, "documents"))


def op13_resample(spark: SparkSession, d: str) -> DataFrame:
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_repeated_passages, op2_decontaminate, op3_shard, op4_token_files, op5_url_filter, op6_toxicity,
                                   op7_chat_format, op8_quality_rules, op9_simhash, op10_byte_bpe, op11_merkle, op12_language,
                                   op13_resample)}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT cast(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, least(len(w), {contamination.WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {contamination.WINDOW}) - 1], ' ') AS t
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {contamination.WINDOW} + 1, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dwin.n, item FROM dwin JOIN win ON dwin.t = win.t AND dwin.n = win.n),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit, cast(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""


def _op5() -> str:
    term = lambda words, weight: " + ".join(
        f"CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){w}($|[^a-z0-9])') THEN {weight} ELSE 0 END" for w in words)
    fits = lambda rule: (lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')")(*rule.split("/", 1))
    order = sorted(urls.RULES, key=lambda r: -len(r[0]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in order) + f" WHEN weight >= {urls.SOFT_HITS} THEN 'block' ELSE 'allow' END"
    return f"""
WITH a AS (SELECT page_id, coalesce(url, '') AS url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM pages),
b AS (SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM a),
c AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM b),
d AS (SELECT page_id, low, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM c),
e AS (SELECT page_id, host, path, {rule} AS rule, cast({term(urls.STRICT, urls.SOFT_HITS)} + {term(urls.SOFT, 1)} AS INTEGER) AS weight FROM d)
SELECT page_id, host, path, rule, {verdict} AS verdict, weight FROM e"""


_OP7 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, bool_or(contains(text, '### ') OR contains(text, '</turn>')) OVER (PARTITION BY conv_id) AS held FROM c),
f AS (SELECT *, CASE WHEN held THEN regexp_replace(text, '(\\*)(### |</turn>)', '\\\1\2', 'g') ELSE text END AS payload FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  cast(sum(length(payload) + 6 + 9 + CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 4 WHEN 'assistant' THEN 9 WHEN 'tool' THEN 4 END) AS BIGINT) AS formatted_chars,
  true AS identical
FROM f GROUP BY conv_id"""

_OP8 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {quality.WINDOW} - 1], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {quality.WINDOW} + 2)) AS i FROM w WHERE len(w) >= {quality.WINDOW})),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {quality.WINDOW})) AS p FROM twice) GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM t),
line2 AS (SELECT doc_id, x, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS c,
  NOT ((length(x) - length(regexp_replace(x, '[#*$%&<>!]', '', 'g')) - {quality.FREE_SIGNS}) * 100 > {quality.SIGNS_PCT} * length(x))
  AND length(x) - length(replace(x, '|', '')) < {quality.BARS} AND NOT regexp_matches(x, '{quality.BOILERPLATE}') AS passes
  FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
lines AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup, coalesce(sum(c) FILTER (WHERE passes), 0) AS left_chars FROM line2 GROUP BY doc_id),
m AS (SELECT w.doc_id, cast(len(w) AS BIGINT) AS n_words, cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, cast(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
  cast(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(left_chars, 0) AS left_chars
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words)
  AND 100 * left_chars >= {quality.MIN_KEPT_PCT} * word_chars AS kept FROM m"""

# Unsigned CRC-32 of the UTF-8 bytes of ``w``, by its table.
_CRC = """tab8 AS (SELECT i, 0 AS k, i AS v FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab8 WHERE k < 8),
tab AS (SELECT i, v FROM tab8 WHERE k = 8),
steps AS (SELECT w, hex(encode(w)) AS h, 0 AS k, cast(4294967295 AS BIGINT) AS v FROM vocab
  UNION ALL SELECT w, h, k + 1, xor(s.v >> 8, tab.v) FROM steps s JOIN tab ON tab.i = xor(s.v & 255, cast('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)) WHERE 2 * k < length(h)),
crc AS (SELECT w, xor(v, 4294967295) AS c FROM steps WHERE 2 * k = length(h))"""

_FIELD = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
_LEAF = lambda text: "sha256(" + " || ".join(_FIELD(c) for c in ("cast(doc_id AS VARCHAR)", "source", "lang", "cast(n_chars AS VARCHAR)", text)) + ")"
_OP11 = f"""
WITH RECURSIVE vocab AS (SELECT DISTINCT cast(doc_id AS VARCHAR) AS w FROM documents WHERE doc_id IS NOT NULL), {_CRC},
leaf AS (SELECT doc_id, coalesce('s' || source, '') AS g, {_LEAF("text")} AS d,
  CASE WHEN c % {merkle.TAMPERED} = 0 THEN {_LEAF("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claim
  FROM documents LEFT JOIN crc ON w = cast(doc_id AS VARCHAR)),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM leaf),
tree AS (SELECT 0 AS l, g, p, n, d FROM placed
  UNION ALL SELECT l + 1, g, p // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY p)) FROM tree WHERE n > 1 GROUP BY l, g, p // 16, n),
subs AS (SELECT g, l AS high, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (SELECT 0 AS l, p, n, subroot AS d FROM subs
  UNION ALL SELECT l + 1, p // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY p)) FROM top WHERE n > 1 GROUP BY l, p // 16, n),
whole AS (SELECT g, l, p, d FROM tree WHERE n > 1 UNION ALL SELECT NULL, l, p, d FROM top WHERE n > 1),
rootd AS (SELECT d AS root FROM top WHERE n = 1),
sib AS (SELECT a.g, a.l, a.p, coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS lefts, coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS rights
  FROM whole a JOIN whole b ON a.g IS NOT DISTINCT FROM b.g AND a.l = b.l AND a.p // 16 = b.p // 16 GROUP BY a.g, a.l, a.p),
climb AS (SELECT doc_id, placed.g, 0 AS l, CASE WHEN high = 0 THEN subs.p ELSE placed.p END AS p, high, subs.p AS q, subroot, d AS leaf, coalesce(claim, d) AS cur, '' AS proof
  FROM placed JOIN subs USING (g)
  UNION ALL SELECT doc_id, c.g, c.l + 1, CASE WHEN c.l + 1 = high THEN q ELSE c.p // 16 END, high, q, subroot, leaf, sha256(s.lefts || cur || s.rights), proof || s.lefts || s.rights
  FROM climb c JOIN sib s ON s.g IS NOT DISTINCT FROM CASE WHEN c.l < high THEN c.g END AND s.l = CASE WHEN c.l < high THEN c.l ELSE c.l - high END AND s.p = c.p)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM climb, rootd WHERE l = high + (SELECT max(l) FROM top)"""

_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP13 = f"""
WITH RECURSIVE dw AS (SELECT doc_id, {_WORDS} AS ws FROM documents), du AS (SELECT doc_id, unnest(ws) AS w FROM dw), dc AS (SELECT doc_id, w, count(*) AS k FROM du GROUP BY ALL),
bc AS (SELECT w, count(*) AS k FROM (SELECT unnest({_WORDS}) AS w FROM benchmark) GROUP BY w),
vocab AS (SELECT DISTINCT w FROM dc UNION SELECT w FROM bc), {_CRC},
b AS (SELECT w, c % {resampling.BUCKETS} AS b FROM crc),
s AS (SELECT b, sum(k) AS s FROM dc JOIN b USING (w) GROUP BY b), t AS (SELECT b, sum(k) AS t FROM bc JOIN b USING (w) GROUP BY b),
tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS sa, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS ta),
g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sa + {resampling.BUCKETS}) / ((s + 1)::DOUBLE * (ta + {resampling.BUCKETS}))))::BIGINT AS gain FROM s LEFT JOIN t USING (b), tot),
wt AS (SELECT doc_id, sum(k * gain) AS weight FROM dc JOIN b USING (w) JOIN g USING (b) GROUP BY doc_id),
sc AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM dw LEFT JOIN wt USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {resampling.MIN_WORDS} ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= {resampling.MIN_WORDS}) AS n FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {resampling.MIN_WORDS} AND place <= n * {resampling.PERCENT} // 100 THEN place END AS rank FROM r"""

SQL: dict[str, str] = {"op2_decontaminate": _OP2, "op5_url_filter": _op5(), "op7_chat_format": _OP7, "op8_quality_rules": _OP8, "op11_merkle": _OP11,
                       "op13_resample": _OP13}
