"""The queries that SQL can express, written for DuckDB on the given tables."""

from __future__ import annotations

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Replacements in a text, then also in a role.
_ESCAPED = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')"
_ROLE = f"replace(replace({_ESCAPED}, '|', '&bar;'), chr(10), '&nl;')"

OP1 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, {_ESCAPED.format('text')}) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, {_ESCAPED.format('text')}), '') AS learned,
         sum(length('<|' || {_ROLE.format('role')} || '|>' || chr(10) || {_ESCAPED.format('text')} || '<|end|>' || chr(10))) AS chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(chars AS BIGINT) AS formatted_chars
FROM s
"""

OP2 = f"""
WITH r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                       ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {AZ}) AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT p.page_id, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY ALL
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '')
         AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS verified
FROM d
"""

OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

OP5 = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
x AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM s),
k AS (SELECT doc_id, line, pos, translate(trim(line, {BLANK}), {AZ}) AS key FROM x),
hit AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.doc_id, k.line, k.pos, hit.keeper IS NOT NULL AND k.doc_id <> hit.keeper AS gone FROM k LEFT JOIN hit USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

OP6 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP9 = """
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS words FROM benchmark),
z AS (SELECT item_id, words, least(5, len(words)) AS width FROM i WHERE len(words) > 0),
si AS (SELECT DISTINCT item_id, width, unnest(list_transform(range(1, len(words) - width + 2), lambda k: array_to_string(words[k:k + width - 1], ' '))) AS shingle FROM z),
ni AS (SELECT item_id, count(*) AS n_item FROM si GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS words FROM documents),
q AS (SELECT doc_id, words, width FROM d JOIN (SELECT DISTINCT width FROM z) ON len(words) >= width),
sd AS (SELECT DISTINCT doc_id, width, unnest(list_transform(range(1, len(words) - width + 2), lambda k: array_to_string(words[k:k + width - 1], ' '))) AS shingle FROM q),
m AS (SELECT sd.doc_id, si.item_id, count(*) AS n_shared FROM sd JOIN si ON si.shingle = sd.shingle AND si.width = sd.width GROUP BY ALL)
SELECT m.doc_id, m.item_id, m.n_shared, ni.n_item, m.n_shared / ni.n_item AS containment
FROM m JOIN ni USING (item_id) WHERE m.n_shared >= 0.8 * ni.n_item
"""

def _crc(number: str) -> str:
    """CRC-32 of a number's decimal text, bit by bit."""
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    step = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END"
    bits = f"list_reduce(list_transform(range(8), lambda z: CAST(z AS BIGINT)), lambda x, k: {step}, xor(crc, c))"
    return f"xor(list_reduce({digits}, lambda crc, c: {bits}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


OP11 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP12 = f"""
WITH o AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words, {_crc('doc_id')} AS h FROM documents),
z AS (SELECT *, len(words) AS n, h // 10 AS g FROM o),
y AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM z),
x AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM y),
t AS MATERIALIZED (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % p + 1] END) ELSE words END AS words FROM x),
g6 AS (SELECT doc_id, unnest(range(n - 5)) AS pos, unnest(list_transform(range(n - 5), lambda i: array_to_string(words[i + 1:i + 6], ' '))) AS gram FROM t WHERE n >= 12),
e AS (SELECT l.doc_id, l.pos, r.pos - l.pos AS q FROM g6 l JOIN g6 r ON l.doc_id = r.doc_id AND l.gram = r.gram AND l.pos < r.pos),
i AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, q ORDER BY pos) AS island FROM e),
s AS (SELECT doc_id, q, min(pos) AS start, count(*) + 5 + q AS length FROM i GROUP BY doc_id, q, island HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
r AS MATERIALIZED (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.doc_id = s.doc_id AND b.q < s.q AND b.start <= s.start AND b.start + b.length >= s.start + s.length)),
d AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS pos FROM r),
u AS (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS pos FROM t),
c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM u ANTI JOIN d USING (doc_id, pos) GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines,
             arg_min(struct_pack(start := start, length := length, q := q), [-length, start, q]) AS top FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.q AS period, 1000 * top.length // top.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN a USING (doc_id) LEFT JOIN c USING (doc_id)
"""

#: rule, count and base, scale, cutoffs from lenient to strict, rejecting comparison.
_RULES = [("n_symbols", "n_words", 1000, "[1000, 700, 500, 350, 250, 180, 130, 90, 60, 40, 25]", ">"),
          ("n_dup_lines", "n_lines", 100, "[90, 80, 70, 60, 50, 40, 30, 20, 10]", ">"),
          ("n_repeat_words", "n_words", 100, "[45, 40, 35, 30, 25, 20, 15, 10, 5]", ">"),
          ("word_chars", "n_words", 10, "[200, 150, 120, 100, 90, 80, 75, 70, 65]", ">"),
          ("word_chars", "n_words", 10, "[10, 15, 20, 25, 30, 33, 36, 39]", "<")]
_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, lang, base_failed, {i} AS rule, len(list_filter({cutoffs}, lambda c: NOT ({scale} * {count} {sign} c * {base}))) AS place, len({cutoffs}) AS places FROM b"
    for i, (count, base, scale, cutoffs, sign) in enumerate(_RULES))

OP13 = f"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS rows FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) AS win,
             unnest(range(1, len(words) - 1)) AS pos FROM w WHERE len(words) >= 3),
t AS (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM g JOIN (SELECT doc_id, win FROM g GROUP BY ALL HAVING count(*) > 1) USING (doc_id, win)),
r AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM t GROUP BY doc_id),
f AS (SELECT doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
             len(rows) AS n_lines, len(rows) - len(list_distinct(rows)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
p AS ({_PLACES}),
y AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) AND {_crc('doc_id')} % 5 <> 0 GROUP BY doc_id),
h AS (SELECT lang, rule, place, any_value(places) AS places, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE good = 0) AS bad
      FROM p JOIN y USING (doc_id) WHERE NOT base_failed GROUP BY lang, rule, place),
c AS (SELECT *, CAST(sum(good) OVER a AS BIGINT) AS n_good, CAST(sum(bad) OVER a AS BIGINT) AS n_bad,
             CAST(sum(good) OVER o AS BIGINT) AS k_good, CAST(sum(bad) OVER o AS BIGINT) AS k_bad
      FROM h WINDOW a AS (PARTITION BY lang, rule), o AS (PARTITION BY lang, rule ORDER BY place)),
d AS (SELECT *, k_bad * n_good - k_good * n_bad AS gain FROM c WHERE place < places AND
      list_sum(list_transform(range(k_good + 1), lambda i: exp(lgamma(n_good + 1.0) - lgamma(i + 1.0) - lgamma(n_good - i + 1.0) + i * ln(0.004) + (n_good - i) * ln(0.996))))
        <= 0.05 / (5 * (SELECT count(*) FROM (SELECT DISTINCT lang FROM h)))),
e AS (SELECT lang, rule, max(place) AS cutoff FROM (SELECT *, row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, place) AS nth FROM d WHERE gain > 0)
      WHERE nth = 1 GROUP BY ALL),
x AS (SELECT DISTINCT doc_id FROM p JOIN e ON p.rule = e.rule AND p.lang IS NOT DISTINCT FROM e.lang AND p.place <= e.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM x) AS kept FROM b
"""

SQL = {"op1_chat_formatting": OP1, "op2_url_filters": OP2, "op3_warc": OP3, "op4_embedding_near_dedup": OP4, "op5_line_dedup": OP5,
       "op6_minhash_near_dedup": OP6, "op9_decontamination": OP9, "op11_hard_negatives": OP11, "op12_periodic_runs": OP12, "op13_quality_rules": OP13}
