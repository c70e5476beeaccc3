"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import quality_rules as q

WORD = r"'[^\x20\x09-\x0D]+'"

CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS v FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
    FROM range(256) t(i)))"""


def crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes, beside ``crc_table``."""
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::UBIGINT)),
    lambda c, b: xor(c >> 8, v[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT"""


CRC = f"""{CRC_TABLE},
texts AS MATERIALIZED (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
crcs AS MATERIALIZED (SELECT text, {crc32("text")} AS text_crc32 FROM texts, crc_table)"""

SHARDING = f"""WITH {CRC},
d AS (
  SELECT doc_id, source, octet_length(encode(coalesce(d.text, ''))) + 16 AS size, text_crc32, md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32) AS k,
    (('0x' || substr(md5('42' || coalesce('/' || source, '')), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE AS u
  FROM documents d JOIN crcs ON crcs.text = coalesce(d.text, '')),
f AS (SELECT *, ((row_number() OVER (PARTITION BY source ORDER BY k, doc_id, text_crc32, size))::DOUBLE - u) / (count(*) OVER (PARTITION BY source))::DOUBLE AS f FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY f, source NULLS FIRST, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos, count(*) OVER () AS n FROM f)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (pos * 40 // n)::INTEGER AS shard, pos - ((pos * 40 // n) * n + 39) // 40 AS slot, NULL::INTEGER AS grown_shard FROM p"""

TOP_K = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""

QUALITY = f"""WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
windows AS (SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) t(k) GROUP BY 1),
m AS (
  SELECT d.doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(str_split(text, chr(10)), lambda x: regexp_matches(x, {WORD})) AS lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id),
r AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {int(100 * q.MAX_REPEAT)} * n_words AS base_failed,
    n_symbols > {q.MAX_SYMBOLS_PER_WORD} * n_words OR len(lines) - len(list_distinct(lines)) > {q.MAX_DUP_LINES} * len(lines)
      OR word_chars / greatest(n_words, 1) < {q.MEAN_WORD_CHARS[0]} OR word_chars / greatest(n_words, 1) > {q.MEAN_WORD_CHARS[1]} AS soft_failed
  FROM m),
hosts AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed OR soft_failed)::DOUBLE AS k FROM r GROUP BY 1),
corpus AS (SELECT sum(k) / sum(n) AS mean, sum(n) AS docs, count(*) AS hosts, sum(k * k / n) AS kkn, sum(n * n) AS nn FROM hosts),
spread AS (SELECT mean, mean * (1 - mean) AS within, docs - nn / docs AS free, kkn - docs * mean * mean - (hosts - 1) * mean * (1 - mean) AS over FROM corpus),
prior AS (SELECT mean, greatest(1.0, least(10000.0, CASE WHEN free > 0 AND over / free > 0 THEN within / (over / free) - 1 ELSE 10000.0 END)) AS strength FROM spread),
verdicts AS (SELECT source, (k + mean * strength) / (n + strength) AS rate, mean FROM hosts, prior),
missed AS (
  SELECT *, word_chars / greatest(n_words, 1)::DOUBLE AS mean_chars, CASE WHEN soft_failed THEN greatest(
      n_symbols / ({q.MAX_SYMBOLS_PER_WORD}::DOUBLE * greatest(n_words, 1)), n_dup_lines / ({q.MAX_DUP_LINES}::DOUBLE * greatest(len(lines), 1)),
      {q.MEAN_WORD_CHARS[0]}::DOUBLE / greatest(mean_chars, 0.01::DOUBLE), mean_chars / {q.MEAN_WORD_CHARS[1]}::DOUBLE, 1::DOUBLE) ELSE 1::DOUBLE END AS miss
  FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (soft_failed AND (rate >= {q.POOR_RATE} AND rate >= {q.POOR_TIMES} * mean OR rate * pow(miss, {q.MISS_POWER}) >= 1 - rate)) AS kept
FROM missed m JOIN verdicts v ON v.source IS NOT DISTINCT FROM m.source"""

WARC = """WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest"""

CHAT_WINDOWS = r"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(k)),
s AS (SELECT conv_id, arg_min(text, (turn IS NOT NULL, turn, text)) AS system_text, arg_min(coalesce(turn, -1), (turn IS NOT NULL, turn, text)) AS system_turn FROM c WHERE role = 'system' GROUP BY 1),
escaped AS (
  SELECT c.*, (octet_length(encode(text)) + 3) // 4 + 4 AS tokens, coalesce(role = 'system' AND text = system_text AND coalesce(turn, -1) = system_turn, false) AS is_system,
    CASE role WHEN 'user' THEN '[INST] ' WHEN 'assistant' THEN '[/INST] ' WHEN 'system' THEN '[SYS] ' ELSE '[ROLE] ' || regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|SYS\]|/?ROLE\])', '\1\\\2\3', 'g') || '[/ROLE] ' END
      || regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|SYS\]|/?ROLE\])', '\1\\\2\3', 'g') || '</s>' AS shown,
    CASE WHEN system_text IS NULL THEN 0 ELSE length('[SYS] ' || regexp_replace(system_text, '([<\[])(\\*)(/?s>|/?INST\]|SYS\]|/?ROLE\])', '\1\\\2\3', 'g') || '</s>') END AS system_chars,
    greatest(4, 2048 - 256 - CASE WHEN system_text IS NULL THEN 0 ELSE (octet_length(encode(system_text)) + 3) // 4 + 4 END) AS room
  FROM c LEFT JOIN s ON s.conv_id = c.conv_id),
t AS (SELECT *, sum(tokens) OVER w - tokens AS began FROM escaped WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, tokens > room // 4 AS alone, began // (room - room // 4) AS stretch FROM t),
f AS (SELECT *, coalesce(alone OR lag(alone) OVER w OR stretch <> lag(stretch) OVER w, true) AS first FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY began)),
k AS (SELECT *, sum(first::INTEGER) OVER (PARTITION BY conv_id ORDER BY began) AS k FROM f),
past AS (
  SELECT a.conv_id, a.k, sum(length(p.shown)) AS chars, bool_or(p.is_system) AS has_system FROM k a JOIN k p ON p.conv_id = a.conv_id AND p.began < a.began AND p.began >= a.began - 256
  WHERE a.first GROUP BY 1, 2),
spans AS (SELECT conv_id, k, sum(length(shown)) AS chars, bool_or(is_system) AS has_system, max(system_chars) AS system_chars FROM k GROUP BY 1, 2),
formatted AS (
  SELECT a.conv_id, sum(3 + a.chars + coalesce(p.chars, 0) + CASE WHEN a.has_system OR coalesce(p.has_system, false) THEN 0 ELSE system_chars END)::BIGINT AS formatted_chars
  FROM spans a LEFT JOIN past p ON p.conv_id = a.conv_id AND p.k = a.k GROUP BY 1)
SELECT c.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM c JOIN formatted f ON f.conv_id = c.conv_id GROUP BY 1"""

PREFIX_TRIE = f"""WITH {CRC_TABLE},
t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations),
c AS (SELECT c, c - c % 100 AS base, {crc32("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM conversations), crc_table),
turns AS (
  SELECT c.c, 0 AS own, t.i, role, text FROM c JOIN t ON t.c = c.base AND t.i <= h
  UNION ALL SELECT c.c, 1, t.i, role, text FROM c JOIN t ON t.c = c.c AND t.i > h),
paths AS MATERIALIZED (
  SELECT c, list(sha256(role || chr(0) || text) ORDER BY own, i) AS p, list(length(text) ORDER BY own, i) AS chars FROM turns GROUP BY 1
  UNION ALL SELECT c, [], [] FROM c WHERE c NOT IN (SELECT c FROM turns)),
steps AS (SELECT c, len(p) AS n, chars, p, unnest(range(0, len(p) + 1)) AS d FROM paths),
members AS MATERIALIZED (SELECT c, d, d = n AS ended, sha256(array_to_string(p[:d], '')) AS k, sha256(array_to_string(p[:d - 1], '')) AS up, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars FROM steps),
nodes AS MATERIALIZED (
  SELECT k, d, min(CASE WHEN d > 0 THEN up END) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
  FROM members GROUP BY k, d),
children AS (SELECT up AS k, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY 1),
ways AS (SELECT DISTINCT a.k AS top, b.k AS k FROM members a JOIN members b ON a.c = b.c AND a.d <= b.d),
sums AS (
  SELECT top AS k, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (ch.n IS NULL) AS n_leaves
  FROM ways w JOIN nodes n ON n.k = w.k LEFT JOIN children ch ON ch.k = w.k GROUP BY 1)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.k = n.k LEFT JOIN children ch ON ch.k = n.k LEFT JOIN nodes p ON p.k = n.up"""

SPELLING = f"""WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
  WHERE length(w) >= 7 GROUP BY ALL),
slips AS (SELECT w, c, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM runs, crc_table),
words AS (SELECT CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, c FROM slips),
v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
wild AS (SELECT word, n, i, word[:i - 1] || '*' || word[i + 1:] AS k FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
cut AS (SELECT DISTINCT word, n, replace(k, '*', '') AS k FROM wild),
near AS (
  SELECT a.word, b.word AS other, b.n FROM wild a JOIN wild b ON a.k = b.k AND a.word <> b.word
  UNION ALL SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = cut.k
  UNION ALL SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = cut.k),
best AS (SELECT word, count(*) AS n_near, max(n) AS n FROM near GROUP BY 1),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n,
    (SELECT min(other) FROM near WHERE near.word = v.word AND near.n = b.n AND b.n >= 10 * v.n) AS form
  FROM v LEFT JOIN best b ON b.word = v.word),
way AS (SELECT word, form AS root FROM forms WHERE form IS NOT NULL UNION ALL SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.root WHERE f.form IS NOT NULL),
roots AS (SELECT w.word, w.root FROM way w JOIN forms f ON f.word = w.root WHERE f.form IS NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM forms f LEFT JOIN roots r ON r.word = f.word"""

ORACLES: dict[str, str] = {
    "op1_sharding": SHARDING,
    "op4_exact_top_k": TOP_K,
    "op5_quality_rules": QUALITY,
    "op10_warc": WARC,
    "op11_chat_windows": CHAT_WINDOWS,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_spelling_variants": SPELLING,
}
