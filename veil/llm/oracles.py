"""The same results in SQL, where SQL can express them.

Not here: op2, op7 (windows and spans by place), op4 (a trained model) and the pipeline; tests compare those with
brute force.
"""

from __future__ import annotations

from veil.llm.chat import DEFAULT
from veil.llm.mix import ROWS_PER_PIECE
from veil.llm.queries import RULES
from veil.llm.quality_rules import LEAST_KEPT_PERCENT, LEAST_WORDS, MOST_REPEATED_PERCENT, SEPARATORS
from veil.llm.url_filter import DAMPING, DISTRUST_OVER_TRUST, ROUNDS

ORACLES: dict[str, str] = {}

WORD = "[^\\x20\\x09-\\x0D]+"

# The line rules without the possessive quantifiers that this engine lacks.
_BOILERPLATE = (
    "(?i)(?:^\\s*(?:©|\\(c\\)) |\\b(?:all rights reserved|add to (?:cart|basket)|cookie (?:policy|settings)|click here"
    "|copyright (?:©|\\(c\\)|[12][0-9])|enable javascript|javascript is (?:disabled|required)|lorem ipsum|licensed under|privacy policy"
    "|read more\\.\\.\\.|subscribe to (?:our|the) newsletter|sign up for our newsletter|share (?:this )?on (?:facebook|twitter|whatsapp)"
    "|terms of (?:use|service)|uses cookies|we use cookies))"
)
_NAVIGATION = (
    "(?i)^\\s*((home|menu|login|log in|sign in|sign up|register|search|contact|about( us)?|next|previous|back|top|skip to content"
    "|share|print|faq|help|sitemap|rss)[\\s/,:>-]*)+$"
)

ORACLES["op1_quality_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i] || chr(0) || ws[i + 1] || chr(0) || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM t, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(list_aggregate(ws, 'string_agg', ''))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
  list_filter(ls, lambda x: NOT (
    (NOT regexp_matches(x, '[.!?…。]') AND regexp_matches(x, '^(?:[^ ]* ){{7}}[^ ]'))
    OR regexp_matches(x, '(?:![!]+(?:\\s|$)[^!]*){{3}}') OR len(regexp_extract_all(x, '[#*$%&|<>]')) * 10 > len(x)
    OR regexp_matches(x, '[{SEPARATORS}][^{SEPARATORS}]*[{SEPARATORS}]') OR regexp_matches(x, '{_NAVIGATION}') OR regexp_matches(x, '{_BOILERPLATE}')
  )) AS stay, ls FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
  coalesce(len(list_aggregate(stay, 'string_agg', '')), 0)::BIGINT AS kept_chars, coalesce(len(list_aggregate(ls, 'string_agg', '')), 0) AS chars FROM m)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * kept_chars >= {LEAST_KEPT_PERCENT} * chars AS kept, n_lines, (n_lines - len(stay))::BIGINT AS n_lines_removed, kept_chars
FROM b
"""

# The 64-bit hash that orders documents, of the number 0 and then a document's id, in whole numbers below 2 ** 64.
# The hash's five multipliers, the starting value.
_M = 1 << 64
_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
_START = 42


def _mixed(h: int) -> int:
    for shift, factor in ((33, _P2), (29, _P3), (32, 1)):
        h = (h ^ h >> shift) * factor % _M
    return h


def _hash_of_zero() -> int:
    h = _START + _P5 + 4
    return _mixed(((h << 23 | h >> 41) % _M * _P2 + _P3) % _M)


_big = lambda n: f"{n}::UHUGEINT"
_times = lambda x, n: f"({x} * {_big(n)}) % {_big(_M)}"
_turned = lambda x, n: f"({_times(x, 1 << n)} + {x} // {_big(1 << 64 - n)})"
_HASHED = f"""
h1 AS (SELECT *, {_times(f"((doc_id::HUGEINT + {_M}::HUGEINT) % {_M}::HUGEINT)::UHUGEINT", _P2)} AS a FROM d),
h2 AS (SELECT * REPLACE ({_times(_turned('a', 31), _P1)} AS a) FROM h1),
h3 AS (SELECT * REPLACE (xor({_big((_hash_of_zero() + _P5 + 8) % _M)}, a) AS a) FROM h2),
h4 AS (SELECT * REPLACE ((({_times(_turned('a', 27), _P1)}) + {_big(_P4)}) % {_big(_M)} AS a) FROM h3),
h5 AS (SELECT * REPLACE ({_times(f"xor(a, a // {_big(1 << 33)})", _P2)} AS a) FROM h4),
h6 AS (SELECT * REPLACE ({_times(f"xor(a, a // {_big(1 << 29)})", _P3)} AS a) FROM h5),
h AS (SELECT * REPLACE (xor(a, a // {_big(1 << 32)}) AS a) FROM h6)"""

ORACLES["op3_mix_sources"] = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents), {_HASHED},
s AS (SELECT source, count(*) AS rows, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size * 2.0::DOUBLE AS cap, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)),
t AS (SELECT source, rows, source_size, CASE WHEN o IS NULL THEN cap ELSE least(cap, o * weight) END AS target
  FROM (SELECT *, (SELECT arg_min(level, cap / weight) FROM l WHERE level * weight <= cap) AS o FROM l)),
k AS (SELECT h.*, t.rows, source_size, target, floor((a // 2048)::DOUBLE / 9007199254740992 * ceil(rows / {ROWS_PER_PIECE})) AS piece,
  CASE WHEN a >= {_big(1 << 63)} THEN a::HUGEINT - {_M}::HUGEINT ELSE a::HUGEINT END AS key FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY piece, key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
  CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END AS epochs FROM k)
SELECT doc_id, source, size, source_size, target, (epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - ahead)))::BIGINT AS taken FROM r
"""

ORACLES["op5_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

ORACLES["op6_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
  WHEN len(ws) > 0 THEN [list_aggregate(ws, 'string_agg', ' ')] ELSE [] END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
h AS (SELECT doc_id, string_agg(g, chr(0) ORDER BY g) AS h FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(r.b) FROM r WHERE r.a = d.doc_id) AS component_id,
  coalesce(min(d.doc_id) OVER (PARTITION BY coalesce(h.h, d.doc_id::VARCHAR)), d.doc_id) AS class_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN h ON d.doc_id = h.doc_id
"""

_part = lambda kind: "CASE role " + " ".join(f"WHEN '{r}' THEN {len(getattr(p, kind))}" for r, p in DEFAULT.parts.items())
_follows = " ".join(f"WHEN '{a}' THEN role IN ({', '.join(repr(r) for r in b)})" for a, b in DEFAULT.order.items())
_marks = "|".join(["\\\\", *("".join("\\" + c if c in "[]/<>|(){}.*+?" else c for c in m) for m in DEFAULT.controls)])
_learned = ", ".join(f"'{r}'" for r, p in DEFAULT.parts.items() if p.loss)

ORACLES["op9_chat_format"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, coalesce(lag(role) OVER w, 'start') AS prior, lead(role) OVER w IS NULL AS last FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
m AS (SELECT *, {_part('opening')} END AS opening, {_part('closing')} END AS closing,
  len(text) + len(regexp_extract_all(text, '{_marks}')) AS escaped,
  (NOT coalesce(CASE prior {_follows} ELSE false END, false))::INT + (last AND role NOT IN ({', '.join(repr(r) for r in DEFAULT.ends)}))::INT AS bad FROM o)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role IN ({_learned})), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role IN ({_learned})), '')) AS loss_sha256,
  sum(opening + escaped + closing)::BIGINT AS formatted_chars, sum(bad)::BIGINT AS n_violations
FROM m GROUP BY conv_id
"""


# CRC-32 of an ASCII text in SQL, by a table of 256 values made on the spot: the SQL engine has no such function.
_CRC_TABLE = (
    "crc AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]), "
    "lambda c, x: xor(c >> 1, (c & 1) * 3988292384))) AS t)"
)


def _crc32(text: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    )


# The edits of a conversation, from its first row on: a list has, for each state, the least cost and audit as one text.
_plus = lambda at, cost, letter: f"lpad((left(a[{at + 1}], 9)::INT + {cost})::VARCHAR, 9, '0') || substr(a[{at + 1}], 10) || '{letter}'"
_cost = lambda n: f"({n} + CASE e[2] WHEN '3' THEN 3 ELSE 0 END)"
_stays = lambda x, initial=None: f"CASE WHEN e[2] NOT IN ('1', '2'){f' AND e[1] = {initial!r}' if initial else ''} THEN {x} END"
_INSERT = f"[a[1], a[2], least(a[3], {_plus(0, 3, 'I')}, {_plus(1, 3, 'I')}, {_plus(3, 3, 'I')}), least(a[4], {_plus(2, 3, 'I')})]"
_to_user = ", ".join(_stays(_plus(s, _cost(3), "R")) + ", " + _stays(_plus(s, _cost(0), "K"), "u") for s in (0, 1, 3))
_ROW = (
    f"[{_plus(0, 4, 'D')}, least({_plus(1, 4, 'D')}, {_stays(_plus(0, _cost(0), 'K'), 's')}), least({_plus(2, 4, 'D')}, {_to_user}), "
    f"least({_plus(3, 4, 'D')}, {_stays(_plus(2, _cost(3), 'R'))}, {_stays(_plus(2, _cost(0), 'K'), 'a')})]"
)

# Links as edges, forwards for trust and backwards for distrust, and as many rounds as the operator runs.
_HOST = "lower(regexp_extract(regexp_extract({0}, '://(.*)$', 1, 's'), '^[^/?#]*', 0))"
_fits = " UNION ALL ".join(
    f"SELECT page_id, url, {len(r.name)} AS length, '{r.name}' AS rule, '{r.verdict}' AS verdict FROM p "
    f"WHERE (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in RULES
)
_rounds = "".join(
    f"""s{i + 1} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (
      SELECT s.kind, e.dst AS host, {DAMPING} * s.score * e.n / o.n AS score FROM s{i} s JOIN e ON e.kind = s.kind AND e.src = s.host JOIN o ON o.kind = e.kind AND o.src = e.src
      UNION ALL SELECT kind, host, {1 - DAMPING} * score FROM s0) GROUP BY ALL),
    """ for i in range(ROUNDS)
)
ORACLES["op8_url_filter"] = f"""
WITH p AS MATERIALIZED (SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN {_HOST.format('url')} ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(regexp_replace(regexp_extract(url, '://(.*)$', 1, 's'), '[?#].*$', '', 's'), '/.*$', 0, 's') ELSE '' END AS path FROM pages),
  f AS ({_fits}),
  fit AS MATERIALIZED (SELECT page_id, url, max_by(rule, length) AS rule, max_by(verdict, length) AS verdict FROM (SELECT DISTINCT * FROM f) GROUP BY page_id, url),
  a AS (SELECT host, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?((?:https?:)?//[^"''\\s>]+)', 1)) AS url FROM p),
  l AS (SELECT host AS src, {_HOST.format("CASE WHEN starts_with(url, '//') THEN 'http:' || url ELSE url END")} AS dst FROM a),
  h AS (SELECT DISTINCT host, string_split(host, '.') AS x FROM p WHERE host <> ''),
  c AS (SELECT DISTINCT array_to_string(x[i:], '.') AS src, array_to_string(x[i + 1:], '.') AS dst FROM (SELECT x, unnest(range(1, len(x))) AS i FROM h)),
  u AS (SELECT src, dst, sum(n) AS n FROM (SELECT src, dst, 1 AS n FROM l WHERE src <> '' AND dst <> '' AND src <> dst
    UNION ALL SELECT src, dst, 1 FROM c UNION ALL SELECT dst, src, 1 FROM c) GROUP BY ALL),
  e AS MATERIALIZED (SELECT 'allow' AS kind, src, dst, n FROM u UNION ALL SELECT 'block', dst, src, n FROM u),
  o AS MATERIALIZED (SELECT kind, src, sum(n) AS n FROM e GROUP BY ALL),
  s0 AS MATERIALIZED (SELECT verdict AS kind, host, count(*) / sum(count(*)) OVER (PARTITION BY verdict) AS score FROM p JOIN fit USING (page_id, url) WHERE host <> '' GROUP BY verdict, host),
  {_rounds}t AS (SELECT host, coalesce(sum(score) FILTER (kind = 'allow'), 0) AS trust, coalesce(sum(score) FILTER (kind = 'block'), 0) AS distrust FROM s{ROUNDS} GROUP BY host)
SELECT page_id, p.host, path, rule, coalesce(verdict, CASE WHEN coalesce(distrust, 0) > {DISTRUST_OVER_TRUST} * coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (page_id, url) LEFT JOIN t ON t.host = p.host
"""

ORACLES["op10_line_dedup"] = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, i) AS id, doc_id, i, regexp_extract_all(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
g AS (SELECT id, list_sort(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda j: array_to_string(ws[j:j + 4], ' '))
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g FROM l),
k AS MATERIALIZED (SELECT g, min(id) AS first, len(g) AS n FROM g WHERE len(g) > 0 GROUP BY g),
s AS MATERIALIZED (SELECT first, n, unnest(g) AS x FROM k),
p AS (SELECT a.first AS a, b.first AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.first < b.first GROUP BY 1, 2),
e AS (SELECT b AS first, min(a) AS earliest FROM p WHERE 100 * c >= 80 * (n + m - c) GROUP BY b),
gone AS (SELECT l.doc_id, l.i FROM g JOIN l USING (id) JOIN k USING (g) LEFT JOIN e ON e.first = k.first WHERE g.id > k.first OR e.earliest IS NOT NULL),
r AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  CASE WHEN gone IS NULL OR text IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ls[i]), chr(10)), '') END AS text
FROM d LEFT JOIN r USING (doc_id)
"""

ORACLES["op11_conversation_repair"] = f"""
WITH {_CRC_TABLE},
s AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations, crc),
d AS (SELECT conv_id, turn, role AS r, text AS x, copy, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM s, (SELECT unnest([0, 1]) AS copy) WHERE k <> 0 AND (copy = 0 OR k = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x, copy) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d),
f AS MATERIALIZED (SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
  CASE WHEN bare = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
  count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows,
  list_reduce(list_prepend(['000000000', NULL, NULL, NULL], flatten(list([['I'], ['I'], [initial, fault::VARCHAR]] ORDER BY i)) || [['I'], ['I']]),
    lambda a, e: CASE WHEN e[1] = 'I' THEN {_INSERT} ELSE {_ROW} END) AS least FROM f GROUP BY conv_id),
b AS MATERIALIZED (SELECT *, left(best, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM (SELECT *, least(least[1], least[4]) AS best FROM g)),
l AS (SELECT conv_id, p, substr(audit, p, 1) AS l, sum((substr(audit, p, 1) <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY p) AS i FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS p FROM b)),
e AS (SELECT l.conv_id, p, l, f.role, f.text, row_number() OVER w - first_value((l = 'K' AND initial = 's')::INT) OVER w AS n
  FROM l LEFT JOIN f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.i = f.i AND l <> 'I' WHERE l <> 'D' WINDOW w AS (PARTITION BY l.conv_id ORDER BY p)),
h AS (SELECT conv_id, count(*) AS n, sha256(string_agg(CASE WHEN l = 'K' THEN role WHEN n % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h FROM e GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h.h, sha256('')) AS repaired_sha256, coalesce(n_rows, 0) AS n_rows, coalesce(h.n, 0) AS n_repaired
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN h ON c.conv_id IS NOT DISTINCT FROM h.conv_id
"""

ORACLES["op12_exact_top_k"] = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER w <= 10
"""

ORACLES["op13_prefix_trie"] = f"""
WITH {_CRC_TABLE},
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) - 1 AS place
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM o), crc),
r AS (SELECT c.conv_id, place, role, text FROM c JOIN o ON o.conv_id = c.base AND place < h UNION ALL SELECT c.conv_id, place, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND place >= h),
s AS (SELECT c.conv_id, coalesce(p, []) AS p, coalesce(b, []) AS b FROM c LEFT JOIN
  (SELECT conv_id, list(md5(octet_length(encode(role)) || ':' || role || text) ORDER BY place) AS p, list(octet_length(encode(text)) ORDER BY place) AS b FROM r GROUP BY conv_id) x ON c.conv_id = x.conv_id),
q AS (SELECT conv_id, len(p) AS n, d, array_to_string(p[1:d], '') AS k, coalesce(b[d], 0) AS b FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM s)),
n AS MATERIALIZED (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(b) AS b, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends FROM q GROUP BY d, k),
m AS (SELECT n.*, coalesce(x.n, 0) AS n_children FROM n LEFT JOIN (SELECT left(k, 32 * (d - 1)::INT) AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY 1) x ON n.k = x.k),
t AS (SELECT left(k, 32 * u::INT) AS k, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * b) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM m) GROUP BY 1)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN t ON m.k = t.k LEFT JOIN n u ON m.d > 0 AND u.k = left(m.k, 32 * (m.d - 1)::INT)
"""
