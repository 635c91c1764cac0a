"""DuckDB SQL for the operators that SQL can express."""

WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION_CTE = f"""
d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM {{docs}}),
i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 13) AS l, w, unnest(range(0, len(w) - least(len(w), 13) + 1)) AS p FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(w[p + 1:p + l], ' ') AS g FROM iw),
dw AS (SELECT rid, l, p, array_to_string(w[p + 1:p + l], ' ') AS g
       FROM (SELECT rid, w, l, unnest(range(0, len(w) - l + 1)) AS p FROM d, (SELECT DISTINCT l FROM win) WHERE len(w) >= l)),
h AS (SELECT dw.rid, dw.p, dw.l, win.item_id FROM dw JOIN win USING (l, g)),
hit AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + l)) AS q FROM h) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item_id) AS n, sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s
       FROM h GROUP BY rid)"""

DECONTAMINATION = f"""
WITH {DECONTAMINATION_CTE.format(docs="documents")}
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       coalesce(it.s, sha256('')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""

_BLANK = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"

LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, source, p, ls[p] AS raw, trim(ls[p], {_BLANK}) AS line
      FROM (SELECT rid, doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS p FROM d)),
b AS (SELECT line, arg_min(rid, (doc_id, p)) AS rid, arg_min(p, (doc_id, p)) AS p FROM l WHERE line <> ''
      GROUP BY line HAVING count(DISTINCT source) >= 5),
k AS (SELECT l.*, b.line IS NULL OR (b.rid = l.rid AND b.p = l.p) AS stays FROM l LEFT JOIN b USING (line)),
t AS (SELECT rid, count(*) AS n, count(*) FILTER (NOT stays) AS gone,
             coalesce(string_agg(raw, chr(10) ORDER BY p) FILTER (stays), '') AS text FROM k GROUP BY rid)
SELECT d.doc_id, coalesce(t.n, 0)::BIGINT AS n_lines, coalesce(t.gone, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN length(coalesce(t.text, '')) END::BIGINT AS n_chars,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(t.text, '')) END AS text_md5
FROM d LEFT JOIN t USING (rid)
"""

SNAPSHOTS = """
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT conv_id, turn, count(*) AS n, string_agg(turn || chr(1) || role || chr(1) || text, chr(2) ORDER BY role, text) AS s
      FROM t GROUP BY ALL),
p AS (SELECT conv_id, turn, turn = max(turn) OVER (PARTITION BY conv_id) AS last, sum(n) OVER w AS n,
             string_agg(s, chr(2)) OVER w AS s FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
whole AS (SELECT s, min(conv_id) AS conv_id, any_value(n) AS n, count(*) AS copies FROM p WHERE last GROUP BY s),
keep AS (SELECT * FROM whole WHERE s NOT IN (SELECT s FROM p WHERE NOT last))
SELECT k.conv_id, (t.turn // 1000)::BIGINT AS part, any_value(k.n)::BIGINT AS n_turns, any_value(k.copies)::BIGINT AS n_copies,
       md5(string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY t.turn, role, text)) AS text_md5
FROM keep k JOIN t USING (conv_id) GROUP BY k.conv_id, part
"""

HARD_NEGATIVES = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid AS a, a.vec_id AS anchor_id, v.rid, v.vec_id AS id, a.label = v.label AS same,
             list_inner_product(a.q, v.q)::BIGINT AS score
      FROM v AS a JOIN v ON a.rid <> v.rid WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, rid) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.a, p.rid ORDER BY s.score DESC, s.id, s.rid))::INTEGER AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

#: Unsigned CRC-32 of the ASCII text {}, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i::INT, 1))::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_value(0, 0, 0, 0, 0, 0, 0, 0)::UBIGINT[]),
                             lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"""

PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id::BIGINT AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, name[:32]) AS pos, name, bytes
      FROM (SELECT c, turn, sha256(length(role)::VARCHAR || ':' || role || text) AS name, strlen(text) AS bytes FROM t)),
m AS (SELECT c, max(pos) AS n, c - c % 5 AS base, ({CRC32.format("c::VARCHAR")} % 9)::BIGINT AS h FROM o GROUP BY c),
k AS (SELECT m.c, m.base, m.h, least(m.h, coalesce(b.n, 0)) AS shared FROM m LEFT JOIN m AS b ON b.c = m.base),
r AS (SELECT o.c, pos - h + shared AS d, name, bytes FROM o JOIN k ON k.c = o.c WHERE pos > h
      UNION ALL SELECT k.c, pos, name, bytes FROM k JOIN o ON o.c = k.base WHERE pos <= shared),
p AS (SELECT c, d, bytes, string_agg(name, '') OVER (PARTITION BY c ORDER BY d) AS path, max(d) OVER (PARTITION BY c) AS last FROM r
      UNION ALL SELECT c, 0, 0, '', coalesce((SELECT max(d) FROM r WHERE r.c = k.c), 0) FROM k),
n AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = last), '')) AS ends FROM p GROUP BY path, d),
g AS (SELECT left(path, 64 * (d - 1)) AS up, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
l AS (SELECT n.*, coalesce(g.n_children, 0) AS n_children FROM n LEFT JOIN g ON g.up = n.path),
s AS (SELECT left(path, 64 * a) AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM l) GROUP BY 1)
SELECT l.conv_id, l.d::BIGINT AS depth, u.conv_id AS parent_conv_id, l.n_convs::BIGINT AS n_convs, l.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, l.ends AS ends_sha256
FROM l JOIN s ON s.path = l.path LEFT JOIN n AS u ON l.d > 0 AND u.path = left(l.path, 64 * (l.d - 1))
"""
