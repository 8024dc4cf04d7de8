"""The numbered queries as SQL for DuckDB, where SQL can express them."""

LLM_SQL = {
    "op10_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, CAST(i AS BIGINT) AS i, string_split(text, chr(10)) AS l, string_split(text, chr(10))[i] AS line
    FROM (SELECT doc_id, text, unnest(range(1, CAST(len(string_split(text, chr(10))) AS BIGINT) + 1)) AS i FROM documents)
),
wins AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY l[i], l[i + 1], l[i + 2] ORDER BY doc_id, i) AS nth
    FROM lines WHERE i + 2 <= len(l)
),
gone AS (SELECT DISTINCT doc_id, i + s AS i FROM wins, (SELECT unnest(range(3)) AS s) WHERE nth > 1),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text
    FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
       CAST(len(string_split(d.text, chr(10))) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
""",
    "op5_substring_dedup": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, i, w, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, CAST(len(w) AS BIGINT) + 1)) AS i FROM docs)),
wins AS (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS owner
    FROM (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM words WHERE i + 12 <= len(w))
),
gone AS (SELECT DISTINCT doc_id, i + s AS i FROM wins, (SELECT unnest(range(13)) AS s) WHERE owner < doc_id),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
""",
    "op1_topk": """
WITH v AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, CAST(len(q.v) AS BIGINT) + 1)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM pairs)
SELECT query_id, CAST(nth AS INT) AS rank, vec_id, score FROM ranked WHERE nth <= 10
""",
    "op8_quotation_links": r"""
WITH RECURSIVE m AS (
    SELECT *, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM conversations
),
keys AS (
    SELECT DISTINCT conv_id, turn, norm FROM m WHERE norm <> ''
    UNION
    SELECT conv_id, turn, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) FROM (
        SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM m)
),
links AS (
    SELECT c.conv_id, c.turn, c.role, c.text, p.turn IS NOT NULL AS quotes, pp.turn IS NOT NULL AS twice,
           (SELECT min(k.turn) FROM keys k WHERE k.conv_id = c.conv_id AND k.norm = p.norm AND k.norm <> '') AS up
    FROM m c LEFT JOIN m p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
             LEFT JOIN m pp ON pp.conv_id = c.conv_id AND pp.turn = c.turn - 2
),
paths AS (
    SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM links WHERE up IS NULL
    UNION ALL
    SELECT l.conv_id, l.turn, p.root_turn, p.depth + 1 FROM links l JOIN paths p ON p.conv_id = l.conv_id AND p.turn = l.up
)
SELECT conv_id, turn, role, trim(text) AS own_text, CAST(quotes AS INT) + CAST(twice AS INT) AS n_quoted,
       CASE WHEN twice THEN 2 WHEN quotes THEN 1 ELSE 0 END AS quote_depth,
       CASE WHEN up IS NOT NULL THEN conv_id END AS parent_conv_id, up AS parent_turn, root_turn, depth
FROM links JOIN paths USING (conv_id, turn)
""",
    "op9_mixing": r"""
WITH docs AS (
    SELECT doc_id, lang, source, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
           'd' || CAST(ascii(substr(md5(source), 1, 1)) % 4 AS VARCHAR) AS domain FROM documents
),
w AS (
    SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens, CAST(2 * sum(n_tokens) AS HUGEINT) AS cap,
           CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END AS wd,
           CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS wl
    FROM docs GROUP BY ALL
),
d0 AS (SELECT domain, wd AS w, CAST(sum(cap) AS HUGEINT) AS cap, (SELECT CAST(sum(tokens) AS HUGEINT) * 3 // 4 FROM w) AS b FROM w GROUP BY ALL),
d1 AS (SELECT *, CAST(sum(cap) OVER r - cap AS HUGEINT) AS bef, sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl
       FROM d0 WINDOW r AS (ORDER BY CAST(cap AS DOUBLE) / w, domain ROWS UNBOUNDED PRECEDING)),
d2 AS (SELECT *, cap * wl <= (b - bef) * w AS f FROM d1),
d3 AS (SELECT domain, CASE WHEN f THEN cap ELSE CAST((b - sum(CASE WHEN f THEN cap ELSE 0 END) OVER ()) * w AS HUGEINT) // CAST(sum(CASE WHEN f THEN 0 ELSE w END) OVER () AS HUGEINT) END AS b FROM d2),
l0 AS (SELECT w.domain, w.lang, w.wl AS w, CAST(sum(cap) AS HUGEINT) AS cap, b FROM w JOIN d3 USING (domain) GROUP BY w.domain, w.lang, w.wl, b),
l1 AS (SELECT *, CAST(sum(cap) OVER r - cap AS HUGEINT) AS bef, sum(w) OVER (PARTITION BY domain ORDER BY CAST(cap AS DOUBLE) / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl
       FROM l0 WINDOW r AS (PARTITION BY domain ORDER BY CAST(cap AS DOUBLE) / w, lang ROWS UNBOUNDED PRECEDING)),
l2 AS (SELECT *, cap * wl <= (b - bef) * w AS f FROM l1),
l3 AS (SELECT domain, lang, CASE WHEN f THEN cap ELSE CAST((b - sum(CASE WHEN f THEN cap ELSE 0 END) OVER p) * w AS HUGEINT) // CAST(sum(CASE WHEN f THEN 0 ELSE w END) OVER p AS HUGEINT) END AS b
       FROM l2 WINDOW p AS (PARTITION BY domain)),
s0 AS (SELECT w.domain, w.lang, w.source, 1 AS w, cap, tokens, b FROM w JOIN l3 USING (domain, lang)),
s1 AS (SELECT *, CAST(sum(cap) OVER r - cap AS HUGEINT) AS bef, sum(w) OVER (PARTITION BY domain, lang ORDER BY CAST(cap AS DOUBLE) / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl
       FROM s0 WINDOW r AS (PARTITION BY domain, lang ORDER BY CAST(cap AS DOUBLE) / w, source ROWS UNBOUNDED PRECEDING)),
s2 AS (SELECT *, cap * wl <= (b - bef) * w AS f FROM s1),
s3 AS (SELECT domain, lang, source, tokens, CASE WHEN f THEN cap ELSE CAST((b - sum(CASE WHEN f THEN cap ELSE 0 END) OVER p) * w AS HUGEINT) // CAST(sum(CASE WHEN f THEN 0 ELSE w END) OVER p AS HUGEINT) END AS b
       FROM s2 WINDOW p AS (PARTITION BY domain, lang)),
plan AS (SELECT *, b // tokens AS whole, b % tokens AS rest FROM s3 WHERE tokens > 0),
ranked AS (
    SELECT d.*, whole, rest, sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
           ORDER BY md5('42:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR))) AS sofar
    FROM docs d JOIN plan USING (domain, lang, source)
),
taken AS (SELECT *, whole + CASE WHEN sofar <= rest AND rest > 0 THEN 1 ELSE 0 END AS n FROM ranked)
SELECT doc_id, CAST(e AS INT) AS epoch, domain, lang, source, n_tokens
FROM (SELECT *, unnest(range(CAST(n AS BIGINT))) AS e FROM taken WHERE n > 0)
""",
    "op12_prefix_trie": """
WITH own AS (
    SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, '')) AS w,
           list_reduce([ascii(x) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')], lambda crc, b:
               list_reduce(range(8), lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, CAST(b AS BIGINT))),
               4294967295::BIGINT) AS crc
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
built AS (
    SELECT o.c, coalesce(p.w[1:(xor(o.crc, 4294967295) % 6)], []) || o.w[(xor(o.crc, 4294967295) % 6) + 1:] AS w
    FROM own o LEFT JOIN own p ON p.c = o.c - o.c % 100
),
prefixes AS (SELECT c, d, w[1:d] AS k, len(w) AS n FROM (SELECT *, unnest(range(0, CAST(len(w) AS BIGINT) + 1)) AS d FROM built)),
nodes AS (
    SELECT d, k, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
    FROM prefixes GROUP BY d, k
),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
own_sums AS (
    SELECT x.d, x.k, CASE WHEN y.n IS NULL THEN 1 ELSE 0 END AS leaf,
           CASE WHEN x.d > 0 THEN (n_convs - 1) * length(x.k[x.d].t) ELSE 0 END AS saved
    FROM nodes x LEFT JOIN kids y ON y.k = x.k
),
subtree AS (
    SELECT a AS d, k[1:a] AS k, sum(leaf) AS n_leaves, sum(saved) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own_sums) GROUP BY 1, 2
)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(x.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(y.n, 0) AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       x.ends_sha256
FROM nodes x JOIN subtree s ON s.d = x.d AND s.k = x.k LEFT JOIN kids y ON y.k = x.k
     LEFT JOIN nodes p ON x.d > 0 AND p.d = x.d - 1 AND p.k = x.k[1:x.d - 1]
""",
    "op3_jaccard_join": r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, CAST(len(w) AS BIGINT) - 3)]
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM docs)
),
sets AS MATERIALIZED (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS s FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS MATERIALIZED (
    SELECT x, y FROM pairs JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
),
ends AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT x, y FROM ends UNION SELECT r.x, b.y FROM reached r JOIN ends b ON b.x = r.y),
least_of AS (SELECT x, min(y) AS y FROM reached GROUP BY x),
classes AS (SELECT s, min(doc_id) AS class_id FROM sets GROUP BY s)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
       coalesce(class_id, d.doc_id) AS class_id
FROM documents d LEFT JOIN sets USING (doc_id) LEFT JOIN least_of ON x = d.doc_id LEFT JOIN classes USING (s)
""",
}
