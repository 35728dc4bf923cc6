"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

import re

from keepwell.llm.chat import BODY, CLOSE, CONTROL, END, OPEN, RESERVED
from keepwell.llm.quality import CUTOFFS, MAX_REPEAT_PERCENT, MIN_WORDS, RULES

_WORD = r"[^\x20\x09-\x0D]+"

OP2 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

#: Levels are binomial tails at risk / rules, corrected over strata and rules; see quality.py.
OP6 = f"""
WITH w AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || lang, 'n') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
f AS MATERIALIZED (
  SELECT doc_id, stratum, len(ws) AS n_words, list_sum([0] || [length(x) FOR x IN ws]) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS n_capitals,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{_WORD}')] AS ls FROM w),
win AS (
  SELECT doc_id, i, ws[i:i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
m AS MATERIALIZED (
  SELECT f.doc_id, stratum, n_words, word_chars, n_symbols, n_capitals, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_words < {MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM f LEFT JOIN rep USING (doc_id)),
shares AS MATERIALIZED (
  {" UNION ALL ".join(f"SELECT doc_id, stratum, base_failed, '{r}' AS rule, {a}::DOUBLE / greatest({b}, 1) AS share FROM m"
                      for r, (a, b) in RULES.items())}),
marks AS (SELECT doc_id, min((quality = 1)::INT) = 1 AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
lab AS MATERIALIZED (SELECT stratum, rule, share, good FROM shares JOIN marks USING (doc_id) WHERE NOT base_failed),
grid AS (SELECT unnest({[i + 1 for i in range(len(CUTOFFS))]}) AS step, unnest({list(CUTOFFS)}) AS cutoff),
cnt AS (
  SELECT stratum, rule, step, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND share >= cutoff) AS k,
         count(*) FILTER (NOT good AND share >= cutoff) AS b
  FROM lab, grid GROUP BY ALL),
tail AS (
  SELECT *, CASE WHEN k >= n THEN 1.0 ELSE list_sum([
      exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({0.1 / len(RULES)}) + (n - j) * ln(1 - {0.1 / len(RULES)}))
      FOR j IN range(0, k + 1)]) END AS p FROM cnt),
ok AS (
  SELECT *, min((p <= 0.05 / ((SELECT count(DISTINCT stratum) FROM lab) * {len(RULES)}))::INT) OVER (
      PARTITION BY stratum, rule ORDER BY step DESC) = 1 AS passes FROM tail),
best AS (SELECT stratum, rule, max_by(cutoff, (b - k) * 100 + step) AS cutoff FROM ok WHERE passes AND b > k GROUP BY ALL),
out AS (SELECT DISTINCT doc_id FROM shares JOIN best USING (stratum, rule) WHERE share >= cutoff)
SELECT m.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND out.doc_id IS NULL AS kept
FROM m LEFT JOIN out ON m.doc_id = out.doc_id
"""

OP8 = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         substr(md5('mix:' || coalesce(doc_id::VARCHAR, text, '')), 1, 16) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
l AS (SELECT *, row_number() OVER o AS nth,
        ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5 - coalesce(sum(cap) OVER b, 0))
        / ((SELECT sum(weight) FROM r) - coalesce(sum(weight) OVER b, 0)) AS level
      FROM r WINDOW o AS (ORDER BY cap / weight, source NULLS LAST),
                    b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM l WHERE level <= cap / weight ORDER BY nth LIMIT 1)) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
        sum(size) OVER (PARTITION BY d.source, h) AS own
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + (rest > 0 AND (upto < rest OR (upto - own < rest AND upto - rest <= rest - (upto - own))))::INT))::BIGINT AS taken
FROM c
"""

#: Base32 of a SHA-1: eight times five hex digits make eight times four base32 digits.
OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, strlen(p.h)::BIGINT AS payload_bytes,
       array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31) + 1, 1) FOR s IN [15, 10, 5, 0]], '')
                        FOR v IN [('0x' || substr(x, 5 * i + 1, 5))::INT FOR i IN range(8)]], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS digest_ok
FROM p JOIN f ON p.h = f.h
"""

_SHOWN = "(length({x}) + len(regexp_extract_all({x}, '{p}')))"
_CONTROLS = "|".join(["\\\\", *map(re.escape, CONTROL)])
OP4 = f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r)) AS turns_sha256,
       coalesce(sum(length(x)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn, r) FILTER (r = 'assistant'), '')) AS loss_sha256,
       (sum({len("".join(RESERVED[i] for i in (OPEN, BODY, CLOSE)))} + {_SHOWN.format(x="r", p=_CONTROLS)} + {_SHOWN.format(x="x", p=_CONTROLS)})
        + {len(RESERVED[END])})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

def _field(x: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({x} AS VARCHAR))) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"


_LEAF = "sha256({})".format(" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")))
#: CRC-32 bit by bit (the polynomial is a fixed value), as DuckDB has no such function.
_CRC = """xor(list_reduce([4294967295] || [CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"""
_RUN = "PARTITION BY level, tree, i // 16 ORDER BY i ROWS BETWEEN"


def _climb(name: str, leaves: str) -> str:
    """``name`` (level, tree, i, n, digest): every node of the trees over ``leaves`` (tree, i, n, digest)."""
    return f"""{name} AS (SELECT 0 AS level, tree, i, n, digest FROM {leaves}
  UNION ALL SELECT level + 1, tree, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM {name}
  WHERE n > 1 GROUP BY level, tree, i // 16, n)"""


def _fold(name: str, start: str, nodes: str) -> str:
    """``name``: rows of ``start`` (tree, i, proof, node, ...) on their way up, step by step."""
    return f"""{name}_steps AS MATERIALIZED (SELECT level, tree, i,
    coalesce(string_agg(digest, '') OVER ({_RUN} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER ({_RUN} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {nodes} WHERE n > 1),
{name} AS (SELECT 0 AS level, row_id, tree, i, proof, node FROM {start}
  UNION ALL SELECT p.level + 1, row_id, p.tree, p.i // 16, proof || l || r, sha256(l || node || r)
  FROM {name} p JOIN {name}_steps s ON s.level = p.level AND s.tree = p.tree AND s.i = p.i),
{name}_end AS MATERIALIZED (SELECT row_id, tree, max_by(proof, level) AS proof, max_by(node, level) AS node FROM {name} GROUP BY row_id, tree)"""


OP11 = f"""
WITH RECURSIVE base AS MATERIALIZED (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, {_LEAF.format(text="text")} AS digest,
         CASE WHEN {_CRC} % 5 = 0 THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              END AS changed FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER () AS row_id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS i,
         count(*) OVER (PARTITION BY tree) AS n FROM base),
{_climb("inner_nodes", "leaves")},
subroots AS MATERIALIZED (
  SELECT tree AS source, 'top' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, digest
  FROM inner_nodes WHERE n = 1),
{_climb("top_nodes", "subroots")},
begun AS (SELECT row_id, tree, i, '' AS proof, coalesce(changed, digest) AS node FROM leaves),
{_fold("low", "begun", "inner_nodes")},
halfway AS (SELECT row_id, s.tree, s.i, proof, node FROM low_end JOIN subroots s ON s.source = low_end.tree),
{_fold("high", "halfway", "top_nodes")}
SELECT doc_id, leaves.digest AS leaf, subroots.digest AS subroot, root, sha256(proof) AS proof_sha256, node AS folded_root,
       node = root AS verified
FROM leaves JOIN subroots ON subroots.source = leaves.tree JOIN high_end USING (row_id),
     (SELECT digest AS root FROM top_nodes WHERE n = 1)
"""

ORACLE_SQL = {"op1_warc": OP1, "op4_chat_format": OP4, "op11_merkle_manifest": OP11,
              "op2_exact_dedup": OP2, "op6_quality_rules": OP6, "op8_mixing": OP8}
