"""DuckDB SQL for the queries of this subpackage that SQL can express."""

# [^\x20\x09-\x0D]+ words of a text.
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

# CRC-32 of an ASCII string, bit by bit.
_CRC = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT), "
        "lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], "
        "lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)")

_ESCAPED = r"""regexp_replace(replace({0}, '\', '\\'), '\[(/?INST\])|<(</?SYS>>|/?s>|\|)', 'x\1\2y', 'g')"""

OP1 = rf"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESCAPED.format('text')}) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 4
      ELSE 16 + length(role) + length(role) - length(replace(replace(role, '\', ''), '|', '')) END)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""

# Katz backoff of order 2 with Good-Turing discounts of counts up to 5.
_DISCOUNT = """{0} AS (
  SELECT r::BIGINT AS r, CASE WHEN tail < 1 AND d > 0 AND d < 1 THEN d ELSE (r - 0.5) / r END AS d FROM (
    SELECT r, tail, ((r + 1) * n_next / (r * n) - tail) / (1 - tail) AS d FROM (
      SELECT r, tail, (SELECT count(*) FROM {1} WHERE c = r)::DOUBLE AS n, (SELECT count(*) FROM {1} WHERE c = r + 1)::DOUBLE AS n_next
      FROM range(1, 6) x(r), (SELECT 6.0 * count(*) FILTER (c = 6) / nullif(count(*) FILTER (c = 1), 0) AS tail FROM {1}))))"""

OP4 = f"""WITH t AS (
  SELECT doc_id, {_CRC.format('doc_id::VARCHAR')} % 10 = 0 AS held_out,
    {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} || [chr(10)] AS w FROM documents),
e AS (SELECT doc_id, held_out, unnest(w) AS w, unnest([chr(10) || chr(10)] || w[:-2]) AS h FROM t),
c1 AS (SELECT w, count(*) AS c FROM e WHERE NOT held_out GROUP BY w),
c2 AS (SELECT h, w, count(*) AS c FROM e WHERE NOT held_out GROUP BY h, w),
{_DISCOUNT.format('d1', 'c1')},
{_DISCOUNT.format('d2', 'c2')},
s AS (SELECT sum(c)::BIGINT AS n, count(*) AS v, sum(CASE WHEN c < 6 THEN (1 - d) * c ELSE 0 END) AS lost FROM c1 LEFT JOIN d1 ON c = r),
p1 AS (SELECT w, c, CASE WHEN c < 6 THEN d ELSE 1 END * c / (n + CASE WHEN lost < 1e-9 THEN 1 ELSE 0 END) AS p
       FROM c1 LEFT JOIN d1 ON c = r, s),
unknown AS (SELECT CASE WHEN lost < 1e-9 THEN 1.0 / (n + 1) ELSE lost / n END AS p FROM s),
k AS (SELECT h, c2.w, c2.c, CASE WHEN c2.c < 6 THEN d ELSE 1 END * c2.c AS dc, p1.p FROM c2 LEFT JOIN d2 ON c2.c = r JOIN p1 ON c2.w = p1.w),
b AS (SELECT h, bottom, (1 - mass / bottom) / (1 - lower) AS alpha FROM (
  SELECT h, sum(c) + CASE WHEN sum(c) - sum(dc) < 1e-9 * sum(c) THEN 1 ELSE 0 END AS bottom, sum(dc) AS mass, sum(p) AS lower FROM k GROUP BY h))
SELECT doc_id, held_out, count(*) AS n_tokens, count(p1.w) AS n_known, max(n) AS train_tokens,
  round(sum(log10((coalesce(p1.c, 0) + 0.1) / (n + 0.1 * (v + 1)))), 6) AS base_score,
  round(sum(log10(CASE WHEN k.dc IS NOT NULL THEN k.dc / b.bottom ELSE coalesce(alpha, 1) * coalesce(p1.p, unknown.p) END)), 6) AS score
FROM e LEFT JOIN p1 ON e.w = p1.w LEFT JOIN k ON e.h = k.h AND e.w = k.w LEFT JOIN b ON e.h = b.h, s, unknown
GROUP BY doc_id, held_out"""

OP5 = rf"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS.format('text')} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
again AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
r AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        100 * n_symbols > 10 * word_chars AS symbols_failed, 20 * n_dup_lines > n_words AS lines_failed FROM r),
u AS (SELECT source, unnest([{{'rule': 1, 'failed': base_failed}}, {{'rule': 2, 'failed': symbols_failed}}, {{'rule': 3, 'failed': lines_failed}}], recursive := true) FROM f),
h AS (SELECT source, rule, count(*)::DOUBLE AS docs, sum(failed::INT)::DOUBLE AS fails FROM u GROUP BY source, rule),
m AS (SELECT rule, sum(docs) AS n, sum(fails) / sum(docs) AS m, count(*) AS k, sum(docs * docs) AS n2, sum(fails * fails / docs) AS ff FROM h GROUP BY rule),
v AS (SELECT rule, n, m, CASE WHEN n - n2 / n > 0 THEN (ff - n * m * m - (k - 1) * m * (1 - m)) / (n - n2 / n) ELSE 0 END AS var FROM m),
s AS (SELECT rule, m, CASE WHEN var > 1e-12 THEN least(greatest(m * (1 - m) / var - 1, 1), greatest(n, 1)) ELSE greatest(n, 1) END AS s FROM v),
rates AS (SELECT source, rule, (fails + m * s) / (docs + s) AS rate FROM h JOIN s USING (rule)),
verdict AS (SELECT source, max(rate) FILTER (rule = 1) AS host_rate, max(rate) FILTER (rule = 2) AS symbol_rate,
              max(rate) FILTER (rule = 3) AS line_rate, max(rate) AS worst FROM rates GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND worst < 0.5 AS kept,
  round(host_rate, 6) AS host_rate, round(symbol_rate, 6) AS symbol_rate, round(line_rate, 6) AS line_rate
FROM f JOIN verdict ON f.source IS NOT DISTINCT FROM verdict.source"""

OP7 = f"""WITH d AS (SELECT doc_id, source, len({_WORDS.format('text')})::BIGINT AS size,
    ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 15))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER q AS place, 3.0 * source_size / weight AS ratio,
        (sum(source_size) OVER () - coalesce(sum(3.0 * source_size) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM s WINDOW q AS (ORDER BY 3.0 * source_size / weight, source COLLATE "C" NULLS LAST)),
l AS (SELECT arg_min(level, place) AS level FROM o WHERE ratio >= level),
t AS (SELECT source, source_size, least(3.0 * source_size, coalesce(l.level * weight, 3.0 * source_size))::DOUBLE AS target FROM o, l),
k AS (SELECT source, key, sum(size) AS key_size FROM d GROUP BY source, key),
b AS (SELECT source, key, key_size, sum(key_size) OVER (PARTITION BY source ORDER BY key) - key_size AS before FROM k),
c AS (SELECT b.source, key, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END AS epochs,
        before + key_size / 2.0 AS middle FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  (size * (epochs + CASE WHEN target - epochs * source_size > 0 AND middle <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.key = c.key"""

OP10 = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
m AS (SELECT *, CASE WHEN octet_length(b) >= 1000 THEN max(page_id) OVER (PARTITION BY b) END AS r FROM p)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest,
  CASE WHEN r IS NOT NULL AND page_id IS DISTINCT FROM r THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM r THEN r END AS refers_to
FROM m"""

# Integer vectors: floor(256 x); doubles hold their inner products exactly.
_VECTORS = """v AS (SELECT *, list_transform(embedding, lambda x: floor(256 * x::DOUBLE))::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

OP11 = f"""WITH {_VECTORS}
SELECT * FROM (SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.v, r.v)::BIGINT AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, r.v) DESC, r.vec_id)::INT AS rank
  FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id) WHERE rank <= 5"""

OP12 = r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t, row_number() OVER () AS r FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
p AS (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d),
tf AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM p GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, n_docs),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
x AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // l))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), s GROUP BY item_id, r, doc_id)
SELECT * FROM (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM x WHERE score > 0) WHERE rank <= 50"""

OP13 = f"""WITH {_VECTORS},
l AS (SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM v WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
      FROM l a JOIN l r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT * FROM (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score) WHERE rank <= 3"""
