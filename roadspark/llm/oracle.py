"""SQL for DuckDB with the rows of those queries that SQL can express, written apart from them."""

from __future__ import annotations

from .chat import BUDGET, HISTORY, LEAST_SPAN, PART, TOKEN_BYTES
from .common import LETTERS
from .licenses import CONTAINED, PHRASES, SPAN, TEMPLATES

_LOW = f"translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_CONTROL = r"(\\*(?:\[/?(?:SYS|INST|ROLE)\]|\[(?:OUT|TEXT)\]|</?s>))"
_ESCAPED = rf"regexp_replace(text, '{_CONTROL}', '\\\1', 'g')"
OP1 = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    CASE role WHEN 'system' THEN '[SYS] ' || {_ESCAPED} || ' [/SYS]' WHEN 'user' THEN '[INST] ' || {_ESCAPED} || ' [/INST]'
      WHEN 'assistant' THEN '[OUT] ' || {_ESCAPED} || ' </s>'
      ELSE '[ROLE] ' || regexp_replace(role, '{_CONTROL}', '\\\1', 'g') || ' [TEXT] ' || {_ESCAPED} || ' [/ROLE]' END AS fmt
  FROM given),
counted AS (SELECT *, coalesce('c' || conv_id, 'null') AS k, CAST(ceil((strlen(fmt) + 1) / {TOKEN_BYTES}) AS BIGINT) AS tokens, n = 1 AND role = 'system' AS sys,
    (n - 1) // {PART} AS part FROM turns),
summed AS (SELECT *, {BUDGET} - max(CASE WHEN sys THEN tokens ELSE 0 END) OVER (PARTITION BY k) AS room,
    sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER (PARTITION BY k ORDER BY n) AS e,
    sum(CASE WHEN sys THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY n) AS m FROM counted),
placed AS (SELECT *, e - tokens AS b, CASE WHEN room - {HISTORY} >= {LEAST_SPAN} THEN room - {HISTORY} ELSE greatest(room, 1) END AS lim FROM summed),
plain AS (SELECT k, m, b, e, part, lim FROM placed WHERE NOT sys),
walk AS (SELECT k, m, part, b AS start FROM plain WHERE m = 1
  UNION ALL SELECT p.k, p.m, p.part, CASE WHEN p.e - w.start > p.lim OR p.part <> w.part THEN p.b ELSE w.start END
  FROM walk w JOIN plain p ON p.k = w.k AND p.m = w.m + 1),
spans AS (SELECT w.k, w.part, w.start, max(p.e) AS stop, min(p.m) = 1 AS head, min(p.room) AS room FROM walk w JOIN placed p ON p.k = w.k AND p.m = w.m AND NOT p.sys GROUP BY ALL),
pieces AS (
  SELECT w.k, w.start, p.fmt FROM walk w JOIN placed p ON p.k = w.k AND p.m = w.m AND NOT p.sys
  UNION ALL SELECT s.k, s.start, p.fmt FROM spans s JOIN placed p ON p.k = s.k AND NOT p.sys
    AND p.e <= s.start AND p.b >= s.start - greatest(0, least({HISTORY}, s.room - (s.stop - s.start)))
    AND (p.part = s.part OR (p.part = s.part - 1 AND (p.n - 1) % {PART} >= {PART - HISTORY}))
  UNION ALL SELECT p.k, coalesce(s.start, 0), p.fmt FROM placed p LEFT JOIN spans s ON s.k = p.k WHERE p.sys),
sizes AS (SELECT k, sum(c) AS formatted_chars, count(*) AS n_windows FROM (SELECT k, start, sum(length(fmt)) + count(*) - 1 AS c FROM pieces GROUP BY k, start) GROUP BY k),
texts AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '') AS loss FROM turns GROUP BY conv_id)
SELECT t.conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars, n_windows
FROM texts t JOIN sizes s ON s.k = coalesce('c' || t.conv_id, 'null')
"""

_RULES = [("www.example.com", "/en/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("com", "/", "allow")]


def _fits(host: str, path: str) -> str:
    return f"WHEN (host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"


OP3 = rf"""
WITH parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{LETTERS}', '{LETTERS.lower()}') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages)
SELECT page_id, host, path, CASE {" ".join(f"{_fits(h, p)} THEN '{h + p}'" for h, p, _ in _RULES)} END AS rule,
  CASE {" ".join(f"{_fits(h, p)} THEN '{v}'" for h, p, v in _RULES)} ELSE 'allow' END AS verdict FROM parts
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 13) AS m, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS words
  FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM windows),
places AS (SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS words FROM d, sizes, unnest(range(1, len(w) - m + 2)) AS r(i)),
found AS (SELECT p.doc_id, p.i, p.m, v.item, v.words FROM places p JOIN windows v ON v.m = p.m AND v.words = p.words),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, m)) AS r(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS names FROM found GROUP BY doc_id),
starts AS (SELECT item, words, i FROM (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark), unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS r(i),
  LATERAL (SELECT array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS words) WHERE len(w) > 0),
diagonals AS (SELECT f.doc_id, f.item, f.i, f.m, f.i - s.i AS diagonal, f.i - row_number() OVER (PARTITION BY f.doc_id, f.item, f.i - s.i ORDER BY f.i) AS run
  FROM found f JOIN starts s ON s.item = f.item AND s.words = f.words),
longest AS (SELECT doc_id, max(n) AS longest FROM (SELECT doc_id, max(i + m) - min(i) AS n FROM diagonals GROUP BY doc_id, item, diagonal, run) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(longest, 0) AS longest
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
"""


def _place_list(phrase: str) -> str:
    words = phrase.split()
    test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words, 1))
    return f"list_filter(range(0, greatest(len(w) - {len(words) - 1}, 0)), lambda i: {test})"


def _named(label: str, phrase: str) -> str:
    return f"CASE WHEN len({_place_list(phrase)}) > 0 THEN '{label}' END"


_ALL_PLACES = "flatten([" + ", ".join(_place_list(p) for p, _ in PHRASES) + "])"
_TEMPLATE_ROWS = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(TEMPLATES))
_WITH = rf"""
WITH d AS (SELECT doc_id, {_LOW} AS low, {_WORDS} AS w FROM documents),
templates AS (SELECT label, {SPAN} * len(string_split(text, ' ')) AS span, list_distinct(string_split(text, ' ')) AS t FROM (VALUES {_TEMPLATE_ROWS}) AS v(k, label, text)),
"""
_RUNS = f"blocks AS (SELECT doc_id, label, t, list_distinct(w[i : i + span - 1]) AS b FROM (SELECT doc_id, w, label, span, t FROM d, templates WHERE len(list_intersect(w, t)) >= ceil({CONTAINED} * len(t) - 1e-9)), unnest(range(1, greatest(len(w) - span, 0) + 2)) AS r(i)),"
_LINES = r"""
lines AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS b FROM d, unnest(string_split(low, chr(10))) AS r(line)),
blocks AS (SELECT doc_id, label, t, b FROM lines, templates),"""
_REST = rf"""
matched AS (SELECT doc_id, label, len(list_intersect(b, t)) / len(t) AS part FROM blocks WHERE len(list_intersect(b, t)) >= ceil({CONTAINED} * len(t) - 1e-9)),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(part) AS score FROM matched GROUP BY doc_id),
base AS (SELECT doc_id, len(w) AS n_words, {_ALL_PLACES} AS p, list_filter([{", ".join(_named(label, p) for p, label in PHRASES)}], lambda x: x IS NOT NULL) AS named FROM d)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base, CAST(list_min(p) AS BIGINT) AS first_word, CAST(list_max(p) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(named)), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(named, coalesce(labels, [])))), ',') AS labels,
  coalesce(score, 0.0) AS score
FROM base LEFT JOIN found USING (doc_id)
"""
OP6, OP6_LINES = _WITH + _RUNS + _REST, _WITH + _LINES + _REST

OP7 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS r(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT id, min(c) AS component_id FROM reach GROUP BY id) m ON m.id = d.doc_id
"""

OP11 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id WHERE p.k <= 5 AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

_TERMS = rf"regexp_extract_all(translate(text, '{LETTERS}', '{LETTERS.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12 = rf"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents WHERE text IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY item_id, term),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS documents, sum(n) AS total FROM d),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, c GROUP BY term, documents),
m AS (SELECT doc_id, 100 - 75 + ((75 * n * documents) // total) AS m FROM d, c),
s AS (SELECT q.item_id, f.doc_id, CAST(sum(q.times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN f ON f.term = q.term JOIN w ON w.term = q.term JOIN m ON m.doc_id = f.doc_id GROUP BY q.item_id, f.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
