"""DuckDB SQL that returns the rows of a registered query."""

# no form: the spans that the guess cost adds come from a dynamic program
SECRETS = None

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS k, coalesce(text, '') AS text FROM documents),
raw AS (SELECT doc_id, k, text, string_split(text, chr(10)) AS parts FROM d),
l AS (
  SELECT doc_id, k, text, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line FROM raw
),
keys AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
common AS (
  SELECT key, max(k) AS last FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT k) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE c.key IS NOT NULL AND k.k <> c.last) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL OR k.k = c.last), '')) AS kept_sha256
FROM keys k LEFT JOIN common c USING (key)
GROUP BY doc_id, k.k, text
"""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
o AS (SELECT html, max(page_id) AS owner FROM p GROUP BY html),
bits AS (
  SELECT page_id, html, owner, unhex(sha1(html)) AS raw, sha1(html) AS hex FROM p JOIN o USING (html)
),
groups AS (
  SELECT page_id, html, owner,
    list_transform(range(0, 4), lambda g: ('0x' || substr(hex, (g * 10 + 1)::BIGINT, 10))::UBIGINT) AS fives FROM bits
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((fives[(i // 8 + 1)::BIGINT] >> ((7 - i % 8) * 5)::UBIGINT) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < owner THEN owner END AS refers_to
FROM groups
"""

WORD = r"[^\x20\x09-\x0D]+"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_KEY = "coalesce(doc_id, 9223372036854775807) AS k"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_KEY}, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (
  SELECT k, i, array_to_string(w[i:i + 49], ' ') AS s
  FROM (SELECT k, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
firsts AS (SELECT s, min(k) AS f FROM win GROUP BY s),
bad AS (
  SELECT DISTINCT k, unnest(range(i, i + 50)) AS pos FROM win JOIN firsts USING (s) WHERE f < k
),
parts AS (SELECT doc_id, k, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
kept AS (
  SELECT p.k, count(*) FILTER (WHERE b.pos IS NOT NULL) AS n_removed,
    string_agg(word, ' ' ORDER BY p.pos) FILTER (WHERE b.pos IS NULL) AS rest
  FROM parts p LEFT JOIN bad b ON p.k = b.k AND p.pos = b.pos GROUP BY p.k
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (k)
"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM common JOIN sizes m ON m.doc_id = x JOIN sizes n ON n.doc_id = y WHERE 100 * c >= 80 * (m.n + n.n - c)
),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT a, y FROM reach JOIN sides ON b = x
)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN sizes ON doc_id = a GROUP BY a
"""

CONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
b AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM b),
win AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
),
hits AS (SELECT doc_id, i, win.size, item FROM win JOIN b ON win.s = b.s AND win.size = b.size),
words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id
),
names AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""

QUALITY = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
),
lines AS (
  SELECT doc_id, host, t, line, regexp_extract_all({LOWERED.format("line")}, '{WORD}') AS lw
  FROM (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
),
filled AS (SELECT doc_id, host, t, line, len(lw) AS n, array_to_string(lw, ' ') AS norm FROM lines WHERE len(lw) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM filled GROUP BY doc_id),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
),
again AS (SELECT doc_id, s FROM win GROUP BY ALL HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS pos FROM win JOIN again USING (doc_id, s)) GROUP BY doc_id
),
holders AS (SELECT host, norm, count(DISTINCT t) AS held FROM filled GROUP BY ALL),
hosts AS (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host),
lost AS (
  SELECT doc_id, sum(n)::BIGINT AS boilerplate_words
  FROM filled JOIN holders USING (host, norm) JOIN hosts USING (host) WHERE held > 20 AND held > texts * 0.1 GROUP BY doc_id
),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(boilerplate_words, 0)::BIGINT AS boilerplate_words
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND boilerplate_words <= 0.8 * n_words AS kept
FROM counts
"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a string's UTF-8 bytes, bit by bit."""
    step = "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    return f"""xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(strlen({text})), lambda i: {byte})),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})))"""


PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    length(coalesce(text, '')) AS chars, turn
  FROM conversations WHERE conv_id IS NOT NULL
),
n AS (SELECT conv_id, k, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i FROM t),
c AS (
  SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM t)
),
used AS (
  SELECT c.conv_id, h, base, count(n.i) AS used FROM c LEFT JOIN n ON n.conv_id = base AND n.i <= h GROUP BY ALL
),
r AS (
  SELECT used.conv_id, n.i AS pos, k, chars FROM used JOIN n ON n.conv_id = base AND n.i <= used
  UNION ALL
  SELECT conv_id, n.i - h + used, k, chars FROM used JOIN n USING (conv_id) WHERE n.i > h
),
p AS (
  SELECT conv_id, pos AS depth, string_agg(k, '') OVER w AS way, chars, pos = max(pos) OVER (PARTITION BY conv_id) AS last
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL
  SELECT conv_id, 0, '', 0, conv_id NOT IN (SELECT conv_id FROM r) FROM c
),
m AS (
  SELECT depth, way, count(*) AS n_convs, min(conv_id) AS conv_id, max(chars) AS chars,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ids
  FROM p GROUP BY ALL
),
kids AS (SELECT depth - 1 AS depth, left(way, 32 * (depth - 1)) AS way, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY ALL),
f AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN kids USING (depth, way)),
sums AS (
  SELECT p.depth, p.way, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * f.chars) AS saved_tokens
  FROM f JOIN p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY ALL
)
SELECT f.conv_id, f.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, sha256(f.ids) AS ends_sha256
FROM f JOIN sums USING (depth, way) LEFT JOIN m up ON up.depth = f.depth - 1 AND up.way = left(f.way, 32 * up.depth)
"""

SPELLING = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, run, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h, n FROM (
    SELECT doc_id, run, count(*) AS n FROM (
      SELECT doc_id, unnest(regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents
    ) WHERE length(run) >= 7 GROUP BY ALL
  )
),
v AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM r
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
less AS (
  SELECT word, i, left(word, i::INT - 1) || substr(word, i::INT + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
),
near AS (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, cut FROM less WHERE cut IN (SELECT word FROM v)
  UNION SELECT cut, word FROM less WHERE cut IN (SELECT word FROM v)
),
best AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS form_n, arg_min(b, (-n, b)) AS form FROM near JOIN v ON v.word = b GROUP BY a
),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * v.n THEN form END AS form,
    CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN best USING (word)
),
ways(word, goal, on_to) AS (
  SELECT word, word, form FROM f UNION ALL SELECT ways.word, f.word, f.form FROM ways JOIN f ON f.word = on_to
)
SELECT f.word, f.form, goal AS root, n, n_near, form_n FROM f JOIN ways ON ways.word = f.word AND on_to IS NULL
"""

NEAR_VECTORS = """
WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
u AS (
  SELECT vec_id, label, v, list_inner_product(v, v) AS s FROM e
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / sqrt(a.s * b.s) >= 0.93
),
reach(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT a, y FROM reach JOIN links ON b = x),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(b) AS component_id, a = min(b) AS kept
FROM reach LEFT JOIN n ON x = a GROUP BY a
"""
