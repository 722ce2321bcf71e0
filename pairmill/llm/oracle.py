"""SQL that must give the same rows as the queries of this package."""

from __future__ import annotations

from pairmill.llm import chat_format, decontaminate, host_rules, spelling, substring_dedup

ORACLE: dict[str, str] = {}

UPPER = "".join(map(chr, range(0x41, 0x5B)))


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


_HOST = "coalesce(" + _lower("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)") + ", '')"
_PATH = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"

ORACLE["op2_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, {_HOST} AS host, {_PATH} AS path, contains(url, '://') AS has,
    array_to_string(list_sort(list_filter(
      string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[a-z]+|ref|gclid|fbclid)='))), '&') AS asked
  FROM pages),
keyed AS (
  SELECT *, CASE WHEN has THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END END AS key FROM parts),
listed AS (
  SELECT DISTINCT key FROM keyed WHERE key IS NOT NULL AND sha256(host)[1] IN ('0', '1')),
ruled AS (
  SELECT k.*, l.key IS NOT NULL AS in_list, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM keyed k LEFT JOIN listed l ON k.key = l.key)
SELECT page_id, host, path, rule, in_list AS listed, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN in_list THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def _escaped_length(text: str) -> str:
    """Code points of an escaped text: one more for each backslash and control string."""
    marks = ["\\", *chat_format.CONTROL]
    return f"length({text})" + "".join(
        f" + (length({text}) - length(replace({text}, '{m.strip()}', ''))) // {len(m.strip())}" for m in marks
    )


_MARKS = len(chat_format.TURN) + len(chat_format.BODY) + len(chat_format.END)

ORACLE["op5_chat_format"] = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
gathered AS (
  SELECT conv_id, count(*) AS n_turns, list(role ORDER BY turn, role, text) AS roles,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS all_text,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    list(text ORDER BY turn, role, text)[2] AS second,
    CAST(sum({_escaped_length("role")} + {_escaped_length("text")} + {_MARKS}) AS BIGINT) AS formatted_chars
  FROM said GROUP BY conv_id)
SELECT conv_id, CASE
    WHEN roles = ['user', 'assistant'] THEN 'prompt'
    WHEN roles = ['system', 'user', 'assistant'] AND second <> '' THEN 'instruction'
    WHEN len(list_filter(roles, lambda r: r NOT IN ('user', 'assistant'))) = 0 THEN 'shared'
    ELSE 'messages' END AS layout,
  n_turns, sha256(all_text) AS turns_sha256,
  length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM gathered
"""

_LOW, _HIGH = host_rules.PRIOR_WEIGHT

ORACLE["op8_host_rules"] = f"""
WITH split AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
numbered AS (SELECT row_number() OVER () AS id, * FROM split),
places AS (
  SELECT id, unnest(range(1, len(w) - 1)) AS i, w FROM numbered WHERE len(w) >= 3),
keyed AS (SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM places),
again AS (SELECT id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY id, k) > 1),
gaps AS (SELECT id, lead(i) OVER (PARTITION BY id ORDER BY i) - i AS gap FROM again),
repeated AS (SELECT id, sum(least(coalesce(gap, 3), 3)) AS n FROM gaps GROUP BY id),
counts AS (
  SELECT doc_id, host, len(w) AS n_words,
    length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM numbered LEFT JOIN repeated USING (id)),
judged AS (
  SELECT *, n_words < {host_rules.MIN_WORDS}
    OR 100 * n_repeat_words > {host_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts),
hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (base_failed
    OR 100 * n_symbols > {host_rules.MAX_SYMBOLS_PER_100_WORDS} * n_words
    OR 100 * n_dup_lines > {host_rules.MAX_DUP_LINE_PERCENT} * n_lines) AS f
  FROM judged GROUP BY host),
moments AS (
  SELECT avg(f / n) AS m, var_pop(f / n) - avg(f / n) * (1 - avg(f / n)) * avg(1 / n) AS v FROM hosts),
prior AS (
  SELECT m, CASE WHEN v > 0 THEN least({_HIGH}, greatest({_LOW}, m * (1 - m) / v - 1)) ELSE {_HIGH} END AS s
  FROM moments),
rates AS (SELECT host, round((f + m * s) / (n + s), 9) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_rate <= {host_rules.MAX_HOST_RATE} AS kept, host_rate
FROM judged JOIN rates USING (host)
"""

# One step of a bitwise crc32, over the bits of the bytes, lowest first.
_CRC_STEP = "xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
# Near words by what is left when a letter goes: a replaced letter leaves the same rest at
# the same place, an inserted one leaves the other word.
ORACLE["op11_spelling_variants"] = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
    unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (
  SELECT doc, {_lower("run")} AS run, count(*) AS n FROM runs
  WHERE length(run) >= {spelling.LEAST_LETTERS} GROUP BY ALL),
hexed AS (SELECT doc, run, n, hex(encode(doc || ':' || run)) AS x FROM counted),
bits AS (
  SELECT run, n, flatten(list_transform(range(length(x) // 2), lambda i:
    list_transform(range(8), lambda k: (
      (16 * (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1) >> k) & 1))) AS b
  FROM hexed),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda c, b: {_CRC_STEP}), 4294967295) AS h FROM bits),
slipped AS (
  SELECT CASE WHEN h % {spelling.SLIP} = 0
    THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= {spelling.LEAST_LETTERS}
  GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
rests AS (
  SELECT DISTINCT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM rests a JOIN rests b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT r.word, r.n, w.word, w.n FROM rests r JOIN words w ON r.rest = w.word
  UNION SELECT w.word, w.n, r.word, r.n FROM rests r JOIN words w ON r.rest = w.word),
near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most,
    min_by(other, struct_pack(x := -other_n, y := encode(other))) AS best
  FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN most >= {spelling.TIMES} * w.n THEN best END AS form,
    CASE WHEN most >= {spelling.TIMES} * w.n THEN most END AS form_n
  FROM words w LEFT JOIN near USING (word)),
steps AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.at = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.at FROM steps s JOIN forms f ON s.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.at, f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f LEFT JOIN ends e ON f.word = e.word
"""

_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# SHA-1 as base 32: five bits at a time from the two halves of its 160 bits' hex digits.
ORACLE["op12_warc_index"] = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS x FROM pages),
digests AS (
  SELECT page_id, body, octet_length(encode(body)) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substring('{_SIGNS}', 1 + CAST(
      (CAST('0x' || substring(x, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)), '')
      AS payload_digest
  FROM payloads),
firsts AS (SELECT body, min(page_id) AS least FROM digests GROUP BY body)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM digests JOIN firsts USING (body)
"""

_SPACED = "[^\\x20\\x09-\\x0D]+"
_LETTERS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LAST = 2**63 - 1
_K, _NUM, _DEN = 3, 90, 100

# Every pair of documents that share a shingle is counted; the components are followed link by link.
ORACLE["op9_ngram_jaccard_join"] = f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS id, coalesce(doc_id, {_LAST}) AS doc,
    regexp_extract_all({_lower("coalesce(text, '')")}, '{_SPACED}') AS w FROM documents),
grams AS (
  SELECT DISTINCT id, doc, gram FROM (
    SELECT id, doc, unnest(CASE WHEN len(w) >= {_K}
      THEN list_transform(range(1, len(w) - {_K - 2}), lambda i: array_to_string(w[i:i + {_K - 1}], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
    FROM split)),
sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
met AS (
  SELECT a.id AS x, b.id AS y, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.id < b.id
  GROUP BY ALL),
linked AS (
  SELECT x, y FROM met JOIN sizes a ON a.id = x JOIN sizes b ON b.id = y
  WHERE {_DEN} * shared >= {_NUM} * (a.n + b.n - shared)),
edges AS (
  SELECT DISTINCT a.doc AS a, b.doc AS b FROM (
    SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked) l
  JOIN split a ON a.id = l.x JOIN split b ON b.id = l.y),
reach AS (
  SELECT DISTINCT doc AS node, doc AS met FROM split
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.met = e.a),
least AS (SELECT node, min(met) AS component FROM reach GROUP BY node)
SELECT nullif(s.doc, {_LAST}) AS doc_id, coalesce(n, 0) AS n_shingles,
  nullif(component, {_LAST}) AS component_id
FROM split s JOIN least ON s.doc = least.node LEFT JOIN sizes ON sizes.id = s.id
"""

_WINDOW = substring_dedup.WINDOW

ORACLE["op10_substring_dedup"] = f"""
WITH split AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w
  FROM documents),
places AS (
  SELECT id, coalesce(doc_id, {_LAST}) AS doc, i, array_to_string(w[i:i + {_WINDOW - 1}], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - {_WINDOW - 2})) AS i FROM split)),
least AS (SELECT k, min(doc) AS doc FROM places GROUP BY k),
hits AS (SELECT p.id, p.i FROM places p JOIN least l ON p.k = l.k AND l.doc < p.doc),
gone AS (SELECT DISTINCT id, i + t AS i FROM hits, range({_WINDOW}) r(t)),
words AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
kept AS (
  SELECT id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS body
  FROM words ANTI JOIN gone USING (id, i) GROUP BY id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (id)
"""

_ITEM = decontaminate.WINDOW

# A longest match is a row of windows one after the other in both texts.
ORACLE["op6_decontamination"] = f"""
WITH split AS (
  SELECT row_number() OVER () AS id, doc_id,
    regexp_extract_all({_lower("coalesce(text, '')")}, '{_LETTERS}') AS w FROM documents),
items AS (
  SELECT row_number() OVER () AS item_row, coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all({_lower("coalesce(text, '')")}, '{_LETTERS}') AS v FROM benchmark),
asked AS (
  SELECT item_row, item, size, j, array_to_string(v[j:j + size - 1], ' ') AS k FROM (
    SELECT *, least(len(v), {_ITEM}) AS size, unnest(range(1, len(v) - least(len(v), {_ITEM}) + 2)) AS j
    FROM items WHERE len(v) > 0)),
places AS (
  SELECT id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k FROM (
    SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM split JOIN (SELECT DISTINCT size FROM asked) s ON len(w) >= size)),
met AS (SELECT p.id, p.i, a.item_row, a.item, a.j, p.size FROM places p JOIN asked a ON p.k = a.k AND p.size = a.size),
hit AS (
  SELECT id, count(DISTINCT i + t) AS n_hit FROM (SELECT id, i, unnest(range(size)) AS t FROM met) GROUP BY id),
found AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS listed
  FROM (SELECT DISTINCT id, item FROM met) GROUP BY id),
islands AS (
  SELECT id, i, size, item_row, i - j AS diagonal,
    i - row_number() OVER (PARTITION BY id, item_row, i - j ORDER BY i) AS island FROM met),
runs AS (
  SELECT id, count(*) + any_value(size) - 1 AS n, min(i) - 1 AS spot
  FROM islands GROUP BY id, item_row, diagonal, island),
longest AS (SELECT id, max(n) AS n, min_by(spot, struct_pack(x := -n, y := spot)) AS spot FROM runs GROUP BY id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
  coalesce(n, 0) AS longest_match, coalesce(spot, -1) AS longest_at
FROM split LEFT JOIN hit USING (id) LEFT JOIN found USING (id) LEFT JOIN longest USING (id)
"""
