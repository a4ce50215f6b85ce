"""DuckDB SQL for those queries of this package that SQL can express; the others are tested against brute force."""

from __future__ import annotations

NEAR_DUPLICATES = r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                               lambda x: x <> '') AS w
    FROM documents
), shingles AS (
    SELECT doc_id, w, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM tokens
), items AS (
    SELECT doc_id, unnest(s) AS g FROM shingles
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM common JOIN shingles p ON p.doc_id = x JOIN shingles q ON q.doc_id = y WHERE 100 * c >= 75 * (len(p.s) + len(q.s) - c)
), sides AS (
    SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
    SELECT doc_id AS node, doc_id AS root FROM documents
    UNION
    SELECT b.y, r.root FROM reach r JOIN sides b ON b.x = r.node
), lowest AS (
    SELECT node, min(root) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM shingles JOIN lowest ON node = doc_id
"""

SUBSTRINGS = r"""
WITH tokens AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM tokens WHERE len(w) >= 20
), runs AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS nth FROM starts
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM runs WHERE nth > 1
), lists AS (
    SELECT doc_id, list(k) AS ks, count(*) AS n FROM gone GROUP BY 1
), kept AS (
    SELECT t.doc_id, w, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN w ELSE [w[k] for k in range(1, len(w) + 1) if NOT list_contains(ks, k)] END AS rest
    FROM tokens t LEFT JOIN lists l ON l.doc_id = t.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(rest, ' '), '')) AS kept_sha256 FROM kept
"""

URLS = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), sites AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(h, p, v) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
    SELECT page_id, host, path, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS nth
    FROM sites JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
), words(pattern) AS (
    VALUES ('casino'), ('cheap[^a-z0-9]pills'), ('free[^a-z0-9]bets'), ('adult'), ('ads[^a-z0-9]track'), ('spam[^a-z0-9]farm')
), bad AS (
    SELECT DISTINCT page_id FROM sites JOIN words ON regexp_matches(host, '(^|[^a-z0-9])' || pattern || '($|[^a-z0-9])')
)
SELECT s.page_id, s.host, s.path, b.rule, CASE WHEN b.rule IS NOT NULL THEN b.v WHEN x.page_id IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM sites s LEFT JOIN best b ON b.page_id = s.page_id AND nth = 1 LEFT JOIN bad x ON x.page_id = s.page_id
"""

# crc32 of a text: the table of byte steps, then one step a byte
CRC_STEPS = """steps AS (
    SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
)"""


def crc(text: str) -> str:
    raw = f"list_transform(range(1, length(hex(encode({text}))), 2), lambda i: CAST('0x' || hex(encode({text}))[i:i + 1] AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {raw}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


TRIE = rf"""
WITH {CRC_STEPS}, own AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1
), plan AS (
    SELECT c.conv_id, c.turns, b.turns AS base, {crc('CAST(c.conv_id AS VARCHAR)')} % 9 AS h
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5 CROSS JOIN steps
), rebuilt AS (
    SELECT conv_id, list_concat(CASE WHEN base IS NULL THEN [] ELSE base[1:h] END, turns[h + 1:]) AS x FROM plan
), prefixes AS (
    SELECT conv_id, d, x[1:d] AS p, d = len(x) AS ended FROM (SELECT conv_id, x, unnest(range(0, len(x) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT d, p, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends,
           CASE WHEN d > 0 THEN strlen(p[d].t) ELSE 0 END AS bytes
    FROM prefixes GROUP BY d, p
), children AS (
    SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2
), full_nodes AS (
    SELECT n.*, coalesce(c.n, 0) AS kids FROM nodes n LEFT JOIN children c ON c.d = n.d AND c.p = n.p
), above AS (
    SELECT e, p[1:e] AS q, (n - 1) * bytes AS saved, kids FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM full_nodes)
), sums AS (
    SELECT e, q, sum(saved) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves FROM above GROUP BY 1, 2
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, n.kids AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN sums s ON s.e = n.d AND s.q = n.p LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""

SPELLING = rf"""
WITH RECURSIVE {CRC_STEPS}, runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), few AS (
    SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY 1, 2
), hashed AS (
    SELECT run, c, {crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM few CROSS JOIN steps
), read_words AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, c FROM hashed
), vocabulary AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n FROM read_words WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5
), cuts AS (
    SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS k FROM vocabulary)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocabulary b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocabulary b ON a.rest = b.word
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS nth, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
), formed AS (
    SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * v.n THEN r.near END AS form, CASE WHEN r.near_n >= 5 * v.n THEN r.near_n END AS form_n
    FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND nth = 1
), chain AS (
    SELECT word, word AS at, form FROM formed
    UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.form
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""

ORACLES = {"op3_near_duplicates": NEAR_DUPLICATES, "op5_substring_dedup": SUBSTRINGS, "op9_url_filter": URLS, "op11_prefix_trie": TRIE, "op13_spelling": SPELLING}
