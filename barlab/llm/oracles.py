"""DuckDB SQL of the corpus queries that SQL can express on whole tables.

Trained models, the nearest-neighbour search, tokenising, tag paths, and the
scored graph of contexts have none; tests/llm compares those with brute force,
exact round trips or held-out accuracy.
"""

from __future__ import annotations

from . import licences

_SPACED = r"""
    SELECT doc_id, list_filter(
        regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> ''
    ) AS ws FROM documents"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_DUP = rf"""
WITH RECURSIVE words AS ({_SPACED.format(text=_LOWERED)}),
sets AS (
    SELECT doc_id, list_distinct(
        CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END
    ) AS items FROM words
),
held AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM held x JOIN held y ON x.item = y.item AND x.doc_id < y.doc_id
        AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 80
    GROUP BY ALL HAVING 100 * count(*) >= 80 * (min(x.n) + min(y.n) - count(*))
),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
    SELECT doc_id, doc_id AS low FROM sets
    UNION
    SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.doc_id
),
lowest AS (SELECT doc_id, min(low) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(items)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN lowest USING (doc_id)"""

_REPEATS = rf"""
WITH words AS ({_SPACED.format(text="coalesce(text, '')")}),
windows AS (
    SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS said
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM words)
),
firsts AS (SELECT said, min(doc_id) AS first FROM windows GROUP BY said),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS place
    FROM windows JOIN firsts USING (said) WHERE first < doc_id
),
placed AS (
    SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM words
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS rest, count(*) AS n
    FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

_SPLIT = rf"""list_filter(
    regexp_split_to_array({_LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

_LEAKS = f"""
WITH words AS (SELECT doc_id, {_SPLIT} AS ws FROM documents),
items AS (
    SELECT item_id, ws, least(len(ws), 10) AS width
    FROM (SELECT item_id, {_SPLIT} AS ws FROM benchmark) WHERE len(ws) > 0
),
grams AS (
    SELECT DISTINCT item_id, width, array_to_string(ws[p:p + width - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS p FROM items)
),
windows AS (
    SELECT doc_id, width, p, array_to_string(ws[p:p + width - 1], ' ') AS gram
    FROM (
        SELECT doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS p
        FROM words CROSS JOIN (SELECT DISTINCT width FROM items)
    )
),
found AS (SELECT doc_id, p, width, item_id FROM windows JOIN grams USING (width, gram)),
places AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(p, p + width)) AS place FROM found) GROUP BY doc_id
),
owners AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(places.n, 0)::BIGINT AS n_hit,
       coalesce(owners.n, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(places.n, 0) > 0 AS contaminated
FROM words LEFT JOIN places USING (doc_id) LEFT JOIN owners USING (doc_id)"""

_AUDIT = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS said FROM documents
),
firsts AS (SELECT said, min(doc_id) AS first FROM texts GROUP BY said),
marks AS (
    SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good,
           max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
    FROM labels GROUP BY doc_id
),
worded AS (
    SELECT *, list_filter(
        regexp_split_to_array(said, '[\x20\x09-\x0D]+'), lambda x: x <> ''
    ) AS ws FROM texts
),
judged AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, map {
        'A': len(ws) < 100,
        'B': 100 * len(list_distinct(ws)) < 80 * len(ws),
        'C': 100 * (length(said) - length(translate(said, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))
             > 10 * length(said),
        'D': regexp_matches(said, '[#$%&*|]'),
        'E': coalesce(first < worded.doc_id, false)
    } AS failed
    FROM worded JOIN firsts USING (said) LEFT JOIN marks USING (doc_id)
),
counted AS (
    SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM judged GROUP BY part, failed
),
orders AS (
    SELECT '' AS filter_order
    UNION ALL
    SELECT filter_order || letter
    FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter)
    WHERE NOT contains(filter_order, letter)
),
steps AS (
    SELECT filter_order, step, filter_order[step] AS letter
    FROM orders, (SELECT unnest(range(1, 6))::INT AS step) WHERE length(filter_order) = 5
),
ranked AS (
    SELECT c.part, s.filter_order, s.step, s.letter, c.n, c.good, c.toxic,
           c.failed[s.letter] AS fails,
           len(list_filter(range(1, s.step), lambda i: c.failed[s.filter_order[i]])) > 0 AS gone,
           len(list_filter(map_values(c.failed), lambda f: f)) = 1 AS alone
    FROM counted c, steps s
),
totals AS (
    SELECT part, filter_order, step, letter,
           sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN alone AND fails THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM ranked GROUP BY ALL
)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM totals"""

_TRIE = r"""
WITH RECURSIVE bits AS (
    SELECT i, i AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
    FROM bits WHERE k < 8
),
crcs AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
said AS (
    SELECT conv_id, list(
        {'role': coalesce(role, ''), 'text': coalesce(text, '')}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
    ) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
taken AS (
    SELECT conv_id, turns, conv_id - conv_id % 5 AS lender, xor(list_reduce(
        list_prepend(4294967295, list_transform(
            string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])
    ), 4294967295) % 9 AS h
    FROM said, crcs
),
whole AS (
    SELECT x.conv_id, coalesce(y.turns[1:x.h::INT], []) || x.turns[x.h::INT + 1:] AS turns
    FROM taken x LEFT JOIN said y ON y.conv_id = x.lender
),
members AS (
    SELECT conv_id, d::BIGINT AS depth, turns[1:d] AS path, len(turns) = d AS ended,
           CASE WHEN d = 0 THEN 0 ELSE strlen(turns[d].text) END AS bytes
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM whole)
),
nodes AS (
    SELECT min(conv_id) AS conv_id, depth, path, count(*) AS n_convs,
           (count(*) - 1) * min(bytes) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                           FILTER (WHERE ended), '')) AS ends_sha256
    FROM members GROUP BY depth, path
),
linked AS (
    SELECT x.*, y.conv_id AS parent_conv_id
    FROM nodes x LEFT JOIN nodes y
        ON y.depth = x.depth - 1 AND y.path = x.path[1:x.depth::INT - 1]
),
below AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children
    FROM linked WHERE depth > 0 GROUP BY ALL
),
tree AS (
    SELECT linked.*, coalesce(n_children, 0) AS n_children
    FROM linked LEFT JOIN below USING (conv_id, depth)
),
climb AS (
    SELECT conv_id, depth, parent_conv_id, (n_children = 0)::BIGINT AS leaf, saved FROM tree
    UNION ALL
    SELECT t.conv_id, t.depth, t.parent_conv_id, c.leaf, c.saved
    FROM climb c JOIN tree t ON t.conv_id = c.parent_conv_id AND t.depth = c.depth - 1
),
sums AS (
    SELECT conv_id, depth, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM climb GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM tree JOIN sums USING (conv_id, depth)"""

_WORDS = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"

# The cosine of every line with every template, without the bound that spares most lines.
_LICENCES = rf"""
WITH templates(template, licence, said) AS (
    VALUES {", ".join(f"({n}, '{name}', '{said}')" for n, (name, said) in enumerate(licences.TEMPLATES))}
),
tokens AS (SELECT template, licence, unnest({_WORDS.format("said")}) AS term FROM templates),
vocabulary AS (SELECT DISTINCT term FROM tokens),
files AS (
    SELECT doc_id, concat_ws('/', source, lang, coalesce(doc_id::VARCHAR, '') || '.txt') AS path, text
    FROM documents
),
held AS (
    SELECT term, count(*) AS n
    FROM (SELECT unnest(list_distinct({_WORDS.format("text")})) AS term FROM files)
    WHERE term IN (FROM vocabulary) GROUP BY term
),
weights AS (
    SELECT term, 1 + ln((1 + (SELECT count(*) FROM files)) / (1 + coalesce(n, 0))) AS idf
    FROM vocabulary LEFT JOIN held USING (term)
),
raw AS (
    SELECT template, licence, term, (1 + ln(count(*))) * min(idf) AS value
    FROM tokens JOIN weights USING (term) GROUP BY ALL
),
vectors AS (
    SELECT template, licence, term,
           value / sqrt(sum(value * value) OVER (PARTITION BY template)) AS value
    FROM raw
),
units AS (
    SELECT row_number() OVER () AS unit, path, text, len({_WORDS.format("text")}) AS file_words
    FROM (SELECT DISTINCT path, text FROM files WHERE text IS NOT NULL)
),
lines AS (
    SELECT unit, line, {_WORDS.format("said")} AS ws FROM (
        SELECT unit, unnest(range(len(ls))) AS line, unnest(ls) AS said
        FROM (SELECT unit, regexp_split_to_array(text, '[\n\r]+') AS ls FROM units)
    )
),
terms AS (
    SELECT unit, line, line_words, term, (1 + ln(count(*))) * min(idf) AS own
    FROM (SELECT unit, line, len(ws) AS line_words, unnest(ws) AS term FROM lines)
    JOIN weights USING (term) GROUP BY unit, line, line_words, term
),
norms AS (SELECT unit, line, sqrt(sum(own * own)) AS norm FROM terms GROUP BY unit, line),
scored AS (
    SELECT unit, line, line_words, licence, round(sum(own * value) / min(norm), 9) AS score
    FROM terms JOIN norms USING (unit, line) JOIN vectors USING (term)
    GROUP BY unit, line, line_words, template, licence
),
best AS (
    SELECT unit, line, line_words, max(score) AS score,
           min_by(licence, (-score, licence)) AS licence
    FROM scored WHERE score >= {licences.LEAST} GROUP BY unit, line, line_words
),
own AS (
    SELECT path, text, licence, score, 2 * said >= file_words AS mostly FROM (
        SELECT unit, min_by(licence, (-score, licence)) AS licence, max(score) AS score,
               sum(line_words) AS said
        FROM best GROUP BY unit
    ) JOIN units USING (unit)
),
covering AS (
    SELECT regexp_replace(path, '/?[^/]*$', '') AS covered,
           min_by((path, licence, score), (-score, path)) AS source
    FROM own
    WHERE mostly OR lower(regexp_replace(regexp_extract(path, '[^/]*$'), '\..*$', ''))
        IN ({", ".join(f"'{name}'" for name in licences.LICENCE_FILES)})
    GROUP BY ALL
),
directories AS (
    SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS directory FROM files
),
parted AS (
    SELECT directory, list_filter(string_split(directory, '/'), lambda x: x <> '') AS parts
    FROM directories
),
above AS (
    SELECT directory, depth, CASE WHEN depth = len(parts) THEN directory ELSE
        CASE WHEN starts_with(directory, '/') AND depth > 0 THEN '/' ELSE '' END
        || array_to_string(parts[1:depth], '/') END AS covered
    FROM (SELECT *, unnest(range(len(parts) + 1)) AS depth FROM parted)
),
nearest AS (
    SELECT directory, max_by(source, depth) AS source FROM above JOIN covering USING (covered)
    GROUP BY directory
)
SELECT f.doc_id, f.path, coalesce(o.licence, n.source[2]) AS licence,
       CASE WHEN o.licence IS NOT NULL THEN 'header'
            WHEN n.source IS NOT NULL THEN 'inherited' END AS origin,
       coalesce(o.score, n.source[3]) AS score,
       CASE WHEN o.licence IS NULL THEN n.source[1] END AS licence_file
FROM files f
LEFT JOIN own o ON o.path = f.path AND o.text = f.text
LEFT JOIN nearest n ON n.directory = regexp_replace(f.path, '/?[^/]*$', '')"""

ORACLES: dict[str, str] = {
    "op3_near_dup": _NEAR_DUP,
    "op7_licences": _LICENCES,
    "op8_substring_dedup": _REPEATS,
    "op10_decontaminate": _LEAKS,
    "op12_filter_audit": _AUDIT,
    "op13_prefix_trie": _TRIE,
}
