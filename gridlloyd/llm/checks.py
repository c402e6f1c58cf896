"""DuckDB SQL giving the same rows as the registered corpus queries, where SQL can express them.

Tokenizers and XXH64 cannot be; those queries are tested against plain versions instead.
"""

from __future__ import annotations

from .quality import BOILERPLATE_PATTERN, NAVIGATION_PATTERN, SENTENCE_ENDS, SEPARATOR_PATTERN, SHORT_LINE

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_UPPER.lower()}')"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[ \\t\\n\\v\\f\\r]+'), lambda y: y <> '')"


OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS k FROM d WHERE len(ws) >= 3),
windows AS (SELECT doc_id, k, ws[k] || chr(1) || ws[k + 1] || chr(1) || ws[k + 2] AS three FROM places),
again AS (
  SELECT doc_id, count(DISTINCT k + s) AS n_repeat_words
  FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows), (SELECT unnest([0, 1, 2]) AS s)
  WHERE n >= 2 GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, len({_words("line")}) AS n, {_lower("line")} AS low,
    length(regexp_replace(line, '[ \\t\\n\\v\\f\\r]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
judged AS (
  SELECT doc_id, line, chars, regexp_matches(low, {_quoted(BOILERPLATE_PATTERN)})
    OR len(regexp_extract_all(low, {_quoted(SEPARATOR_PATTERN)})) >= 2
    OR n < {SHORT_LINE} AND (NOT contains({_quoted(SENTENCE_ENDS)}, right(rtrim(line, {_SPACES}), 1))
      OR regexp_matches(low, {_quoted(NAVIGATION_PATTERN)})) AS fails
  FROM lines WHERE n > 0),
by_doc AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost
  FROM judged GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN again USING (doc_id) LEFT JOIN by_doc USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost <= 30 * word_chars AS kept
FROM base
"""

OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, payload, sha1(payload) AS payload_digest FROM p),
g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS last FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last = page_id THEN NULL ELSE last END AS refers_to
FROM g
"""

OP7 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item,
  regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item, size, array_to_string(ws[k:k + size - 1], ' ') AS run
  FROM (SELECT item, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS k FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, k, size, array_to_string(ws[k:k + size - 1], ' ') AS run
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM d, sizes WHERE len(ws) >= size)),
hits AS (SELECT doc_id, k, size, item FROM dw JOIN iw USING (size, run)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM (SELECT DISTINCT doc_id, k, size FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, k, md5(t[k + 1:k + 200]) AS m
  FROM (SELECT doc_id, t, unnest(range(0, octet_length(t) - 199)) AS k FROM d WHERE octet_length(t) >= 200)),
r AS (SELECT doc_id, k FROM w JOIN (SELECT m FROM w GROUP BY m HAVING count(*) > 1) USING (m)),
-- Overlapping or touching windows make one removed run.
marked AS (SELECT doc_id, k, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) <= 200 THEN 0 ELSE 1 END AS fresh FROM r),
runs AS (SELECT doc_id, run, min(k) AS a, max(k) + 200 AS b
  FROM (SELECT doc_id, k, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM marked) GROUP BY doc_id, run),
spans AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
  FROM runs GROUP BY doc_id),
all_docs AS (SELECT doc_id, h, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  list_concat([0], coalesce(ends, [])) AS froms, list_concat(coalesce(starts, []), [length(h) // 2]) AS tos
  FROM d LEFT JOIN spans USING (doc_id))
SELECT doc_id, length(h) // 2 AS n_bytes, n_removed, n_spans,
  sha256(unhex(array_to_string(list_transform(range(1, len(froms) + 1),
    lambda i: substr(h, 2 * froms[i] + 1, 2 * (tos[i] - froms[i]))), ''))) AS kept_sha256
FROM all_docs
"""

OP10 = f"""
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) AS k, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT doc_id, k, line, {_lower(f"trim(line, {_SPACES})")} AS key FROM l),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT doc_id, k, line, first IS NOT NULL AND doc_id <> first AS gone FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_VECTORS = """list_transform(embedding, lambda y: floor(256 * y::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0"""

OP12 = f"""
WITH v AS (SELECT DISTINCT vec_id, {_VECTORS}),
scored AS (
  SELECT q.vec_id AS query_id, q.x AS qx, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id, qx ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

OP13 = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label, {_VECTORS}
    AND label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, a.x AS ax, c.vec_id, c.label, list_inner_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positive AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, own, ax ORDER BY score DESC, vec_id) AS slot
  FROM scored WHERE label = own QUALIFY slot <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.own, p.ax, p.slot ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND n.own = p.own AND n.ax = p.ax AND n.label <> p.own
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


def _insert(x: str, role: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + 3, 'a': {x}.a || 'I', 't': list_append({x}.t, '{role}:')}} END"


def _edit(x: str, cost: str, letter: str, line: str | None) -> str:
    text = f"list_append({x}.t, {line})" if line else f"{x}.t"
    return f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 't': {text}}} END"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


# The best (cost, audit, lines) of each of the four states, after inserting turns before a row.
_BEFORE_ROW = f"""SELECT conv_id, i, st, ss, {_least("su", _insert("st", "user"), _insert("ss", "user"), _insert("sa", "user"))} AS su,
  {_least("sa", _insert("su", "assistant"))} AS sa"""
_REROLED = "3 + cut"
_BEST = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"

OP11 = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
kinds AS (
  SELECT *, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, left(role, 1) AS r, rtrim(text, {_SPACES}) AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM placed),
rows_in AS (
  SELECT conv_id AS conv, i AS pos, r, fault IN ('b', 'd') AS gone, CASE fault WHEN 't' THEN 3 ELSE 0 END AS cut,
    role || ':' || text AS line, 'user:' || text AS as_user, 'assistant:' || text AS as_assistant FROM judged),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}}::{_BEST} AS st, NULL::{_BEST} AS ss, NULL::{_BEST} AS su,
    NULL::{_BEST} AS sa
  FROM (SELECT DISTINCT conv_id FROM placed)
  UNION ALL
  SELECT conv_id, i + 1, {_edit("st", "4", "D", None)},
    {_least(_edit("ss", "4", "D", None), f"CASE WHEN r = 's' AND NOT gone THEN {_edit('st', 'cut', 'K', 'line')} END")},
    {_least(_edit("su", "4", "D", None), *[
        f"CASE WHEN {keep} NOT gone THEN {_edit(x, cost, letter, line)} END" for x in ("st", "ss", "sa")
        for keep, cost, letter, line in (("r = 'u' AND", "cut", "K", "line"), ("", _REROLED, "R", "as_user"))])},
    {_least(_edit("sa", "4", "D", None), f"CASE WHEN r = 'a' AND NOT gone THEN {_edit('su', 'cut', 'K', 'line')} END",
            f"CASE WHEN NOT gone THEN {_edit('su', _REROLED, 'R', 'as_assistant')} END")}
  FROM ({_BEFORE_ROW} FROM ({_BEFORE_ROW} FROM walk)) JOIN rows_in ON conv IS NOT DISTINCT FROM conv_id AND pos = i + 1),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ends AS (
  SELECT walk.conv_id, gaps, blank, duplicate, truncated, illegal,
    {_least("st", "sa", _insert("su", "assistant"), _insert("(" + _insert("ss", "user") + ")", "assistant"))} AS best
  FROM walk JOIN counted ON counted.conv_id IS NOT DISTINCT FROM walk.conv_id AND walk.i = counted.n)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL = {
    "op4_line_first_quality": OP4, "op6_warc_revisits": OP6, "op7_decontaminate": OP7, "op8_suffix_dedup": OP8,
    "op10_line_dedup": OP10, "op11_conversation_repair": OP11,
    "op12_exact_top_k": OP12, "op13_hard_negatives": OP13,
}
