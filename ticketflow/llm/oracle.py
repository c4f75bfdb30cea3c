"""DuckDB SQL of the registered queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = r"[^\x20\x09-\x0D]+"

OP1 = f"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), []) AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lens WHERE len(ws) >= n)),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (gram, n)),
pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP2 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TOKEN}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws
      ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (sh) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.r)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles,
  coalesce(min(r), d.doc_id) AS component_id, d.doc_id = coalesce(min(r), d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id
"""

# The bisected exponent of a repetition limit has a closed form.
OP3 = f"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h,
    coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) AS n_tokens FROM documents),
src AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY 1),
st AS (SELECT CAST(sum(tokens) AS DOUBLE) AS total, CAST(max(tokens) AS DOUBLE) AS most, min(tokens) AS least FROM src WHERE tokens > 0),
ex AS (SELECT total, CASE WHEN most = least THEN 1.0 ELSE greatest(0.0, 1 - ln(4.0) / ln(most / least)) END AS a FROM st),
raw AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN power(tokens / total, a) END AS raw FROM src, ex),
budget AS (
  SELECT source, tokens, CAST(floor(round(coalesce(raw, 0) * max(tokens / raw) OVER (), 6)) AS BIGINT) AS budget FROM raw),
plan AS (
  SELECT source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS whole,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM budget),
whole_passes AS (
  SELECT doc_id, d.source, n_tokens, h, unnest(range(0, whole)) AS epoch
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
drawn AS (
  SELECT doc_id, source, n_tokens, epoch, md5(concat_ws('|', '17', epoch, coalesce(CAST(doc_id AS VARCHAR), ''), h)) AS place
  FROM whole_passes),
last_pass AS (
  SELECT doc_id, d.source, n_tokens, whole AS epoch, rest,
    md5(concat_ws('|', '17', whole, coalesce(CAST(doc_id AS VARCHAR), ''), h)) AS place
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source WHERE rest > 0),
filled AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY place, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled FROM last_pass)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(epoch AS BIGINT) AS epoch, place FROM drawn
UNION ALL SELECT doc_id, source, CAST(n_tokens AS BIGINT), CAST(epoch AS BIGINT), place FROM filled WHERE filled < rest
"""

OP5 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS last_id FROM p WHERE payload_bytes >= 1000
  GROUP BY 1, 2 HAVING count(*) > 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN last_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last_id <> page_id THEN last_id END AS refers_to
FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
"""

# Sums run from left to right, as in the operator.
OP6 = """
WITH v AS (
  SELECT vec_id, e, list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b) AS sq
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda a, b: a + b) / (sqrt(q.sq) * sqrt(c.sq)) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""

_ESC = r"replace(replace(replace({0}, '\', '\\'), '<', '\l'), '#', '\h')"
OP7 = rf"""
WITH c AS (
  SELECT conv_id, turn, role AS r, coalesce(role, '') AS role, text AS t, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn role=>' || chr(10) || {_ESC.format('text')} || chr(10) || '</turn>' || chr(10))
    + length(replace(replace({_ESC.format('role')}, '>', '\g'), chr(10), '\n'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

# crc32 by its table, which follows from the polynomial; v holds the words v.w to hash.
_CRC32 = """
crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
crcs AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, octet_length(encode(w))),
      lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc FROM v, crc_table)"""

OP13 = f"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), []) AS ws FROM documents),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}')) AS w FROM benchmark),
v AS (SELECT w FROM dw UNION SELECT w FROM bw),{_CRC32},
sb AS (SELECT crc % 10000 AS b, count(*) AS n FROM dw JOIN crcs USING (w) GROUP BY 1),
tb AS (SELECT crc % 10000 AS b, count(*) AS n FROM bw JOIN crcs USING (w) GROUP BY 1),
tot AS (SELECT (SELECT coalesce(sum(n), 0) FROM sb) AS s, (SELECT coalesce(sum(n), 0) FROM tb) AS t),
g AS (
  SELECT range AS b, floor(1000 * ln((coalesce(tb.n, 0) + 1)::DOUBLE * (tot.s + 10000)::DOUBLE
    / ((coalesce(sb.n, 0) + 1)::DOUBLE * (tot.t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) LEFT JOIN sb ON sb.b = range LEFT JOIN tb ON tb.b = range, tot),
gw AS (SELECT w, gain FROM crcs JOIN g ON g.b = crc % 10000),
wt AS (SELECT doc_id, sum(gain) AS weight FROM dw JOIN gw USING (w) GROUP BY 1),
s AS (
  SELECT d.doc_id, len(ws) AS n, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || d.doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS score
  FROM d LEFT JOIN wt USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM s WHERE n >= 20)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN place <= able * 10 // 100 THEN CAST(place AS BIGINT) END AS rank
FROM s LEFT JOIN r USING (doc_id)
"""

# Equal stretches of six words at distance q, in neighbouring places, make a stretch of period q.
OP11 = f"""
WITH v AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS w FROM documents),{_CRC32},
d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '{TOKEN}'), []) AS ws, crc // 10 AS g, crc % 10 AS m
  FROM documents JOIN crcs ON w = CAST(doc_id AS VARCHAR)),
x AS (
  SELECT doc_id, len(ws) AS n, CASE WHEN m <> 0 OR len(ws) = 0 THEN ws ELSE list_transform(range(0, len(ws)),
    lambda i: ws[1 + CASE WHEN i < g % len(ws) THEN i
      ELSE g % len(ws) + (i - g % len(ws)) % (1 + (len(ws) - g % len(ws)) // (3 + g % 8)) END]) END AS ws FROM d),
grams AS (
  SELECT doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(0, n - 5)) AS i FROM x WHERE n >= 12)),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
runs AS (
  SELECT * FROM stretches r WHERE NOT EXISTS (
    SELECT 1 FROM stretches o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.l >= r.s + r.l)),
per_doc AS (
  SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'l': l, 'q': q}}, (-l, s, q)) AS best,
    string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines, list({{'a': s + q, 'b': s + l}}) AS gone
  FROM runs GROUP BY 1)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
  CAST(best.q AS BIGINT) AS period, CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(array_to_string(list_transform(list_filter(range(0, n),
    lambda i: len(list_filter(coalesce(gone, []), lambda r: i >= r.a AND i < r.b)) = 0), lambda i: ws[i + 1]), ' ')) AS collapsed_sha256
FROM x LEFT JOIN per_doc USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1,
    "op2_near_duplicates": OP2,
    "op3_mixing": OP3,
    "op5_warc": OP5,
    "op6_nearest": OP6,
    "op7_chat": OP7,
    "op11_periodic_runs": OP11,
    "op13_resampling": OP13,
}
