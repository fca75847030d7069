"""Results of the operators in SQL, where SQL can say them."""

from __future__ import annotations

#: Unsigned crc32 of `doc_id` as decimal text, bit by bit. Fixed value: the reversed polynomial.
CRC32_OF_ID = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, none: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(name: str, start: str) -> str:
    """Common table expressions for the nodes of all levels and the siblings of each."""
    return f"""
{name}_nodes AS (
    SELECT key, 0 AS level, pos, total, node FROM {start}
    UNION ALL
    SELECT key, level + 1, pos // 8, (max(total) + 7) // 8, sha256(string_agg(node, '' ORDER BY pos))
    FROM {name}_nodes WHERE total > 1 GROUP BY key, level, pos // 8),
{name}_siblings AS (
    SELECT key, level, pos,
        coalesce(string_agg(node, '') OVER (
            run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lower,
        coalesce(string_agg(node, '') OVER (
            run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS upper
    FROM {name}_nodes WHERE total > 1
    WINDOW run AS (PARTITION BY key, level, pos // 8 ORDER BY pos))"""


def _climb(name: str, start: str) -> str:
    return f"""
{name}_paths AS (
    SELECT rid, key, 0 AS level, pos, node AS folded, proof FROM {start}
    UNION ALL
    SELECT rid, key, level + 1, pos // 8, sha256(lower || folded || upper), proof || lower || upper
    FROM {name}_paths JOIN {name}_siblings USING (key, level, pos)),
{name}_ends AS (
    SELECT rid, key, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof
    FROM {name}_paths GROUP BY rid, key)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE
numbered AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM documents),
leaves AS MATERIALIZED (
    SELECT rid, doc_id, coalesce('=' || lang, '-') AS key, {_leaf("text")} AS leaf,
        CASE WHEN coalesce({CRC32_OF_ID} % 3 = 0, false) THEN {_leaf(_LOWER)} END AS changed
    FROM numbered),
placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
        count(*) OVER (PARTITION BY key) AS total, leaf AS node
    FROM leaves),
{_tree("leaf", "placed")},
subroots AS (SELECT key AS name, node FROM leaf_nodes WHERE total = 1),
ordered AS MATERIALIZED (
    SELECT 0 AS key, name, node, row_number() OVER (ORDER BY name) - 1 AS pos, count(*) OVER () AS total
    FROM subroots),
{_tree("group", "ordered")},
{_climb("leaf", "(SELECT rid, key, pos, coalesce(changed, leaf) AS node, '' AS proof FROM placed)")},
halfway AS (
    SELECT rid, 0 AS key, pos, folded AS node, proof
    FROM leaf_ends JOIN ordered ON leaf_ends.key = ordered.name),
{_climb("group", "halfway")}
SELECT doc_id, leaf, ordered.node AS subroot, top.node AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = top.node AS verified
FROM placed JOIN ordered ON placed.key = ordered.name JOIN group_ends USING (rid)
CROSS JOIN (SELECT node FROM group_nodes WHERE total = 1) AS top
"""

PHRASE_MINING = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL),
words AS MATERIALIZED (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
    UNION ALL
    SELECT lang, 3, unnest(list_transform(
        range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
f AS MATERIALIZED (
    SELECT lang, size, phrase, count(*) AS a, string_split(phrase, ' ') AS p FROM grams
    GROUP BY lang, size, phrase HAVING count(*) >= 10),
cuts AS (
    SELECT c.lang, c.size, c.phrase, c.a, k, x.a AS l, y.a AS r,
        (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
    FROM f AS c CROSS JOIN (VALUES (1), (2)) AS v(k)
    JOIN f AS x ON x.lang = c.lang AND x.size = k AND x.phrase = array_to_string(c.p[1:k], ' ')
    JOIN f AS y ON y.lang = c.lang AND y.size = c.size - k AND y.phrase = array_to_string(c.p[k + 1:], ' ')
    WHERE k < c.size),
worst AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS phrase, a AS longer FROM f WHERE size = 3),
kept AS (
    SELECT * FROM worst WHERE NOT EXISTS (
        SELECT 1 FROM inside WHERE inside.lang = worst.lang AND inside.phrase = worst.phrase
            AND 100 * inside.longer >= 50 * worst.a)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""



def linked_components(words: int, percent: int, columns: str) -> str:
    """Components of documents whose sets of shingles have the given similarity; `columns` of d."""
    return f"""
WITH RECURSIVE
numbered AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
words AS (
    SELECT rid, doc_id, list_filter(
        string_split_regex(coalesce({_LOWER}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM numbered),
sets AS MATERIALIZED (
    SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(
            range(1, len(w) - {words} + 2), lambda i: array_to_string(w[i:i + {words} - 1], ' '))) END AS s
    FROM words),
distinct_sets AS MATERIALIZED (
    SELECT min(rid) AS v, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
shingles AS MATERIALIZED (SELECT v, n, unnest(s) AS x FROM distinct_sets),
links AS MATERIALIZED (
    SELECT a.v AS a, b.v AS b FROM shingles AS a JOIN shingles AS b
    ON a.x = b.x AND a.v <> b.v AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
    GROUP BY a.v, b.v, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reached AS (
    SELECT v, v AS other FROM distinct_sets
    UNION
    SELECT reached.v, links.b FROM reached JOIN links ON reached.other = links.a),
roots AS (SELECT v, min(other) AS root FROM reached GROUP BY v),
members AS (
    SELECT doc_id, rid, len(sets.s) AS n_shingles, roots.root
    FROM sets LEFT JOIN distinct_sets ON list_sort(sets.s) = distinct_sets.s LEFT JOIN roots USING (v)),
d AS (
    SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, CASE WHEN root IS NULL THEN doc_id
        ELSE min(doc_id) OVER (PARTITION BY root) END AS component_id
    FROM members)
SELECT {columns} FROM d
"""


ORACLE = {
    "op2_jaccard_join": linked_components(3, 90, "doc_id, n_shingles, component_id"),
    "op11_bottom_k_dedup": linked_components(
        5, 85, "doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept"
    ),
    "op12_misra_gries_phrases": PHRASE_MINING,
    "op13_merkle_manifest": MERKLE_MANIFEST,
}
