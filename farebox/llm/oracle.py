"""DuckDB SQL for the operators that SQL can express on the whole table.

Words hold no space, so a run of words joined by one space stands for exactly that run.
"""

from __future__ import annotations

_WORDS = "list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

SUBSTRING_DEDUP = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words FROM documents
), starts AS (
    SELECT row_id, unnest(generate_series(1, len(words) - 34)) AS place, words FROM docs WHERE len(words) >= 35
), windows AS (
    SELECT row_id, place, md5(array_to_string(words[place:place + 34], ' ')) AS run FROM starts
), marked AS (
    SELECT row_id, place, CAST(count(*) OVER (PARTITION BY run) > 1 AS INTEGER) AS again FROM windows
), positions AS (
    SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs
), covered AS (
    SELECT p.row_id, p.word, p.place,
           coalesce(max(m.again) OVER (PARTITION BY p.row_id ORDER BY p.place ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
    FROM positions p LEFT JOIN marked m ON p.row_id = m.row_id AND p.place = m.place
), results AS (
    SELECT row_id, sum(gone) AS removed, string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0) AS kept
    FROM covered GROUP BY row_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(r.removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(r.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN results r ON d.row_id = r.row_id"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, {_WORDS.format(text=_LOWER)} AS words FROM documents
), sets AS (
    SELECT row_id, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(words) - 3), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
    FROM docs
), tokens AS (
    SELECT row_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.row_id AS x, b.row_id AS y FROM tokens a JOIN tokens b ON a.shingle = b.shingle AND a.row_id <> b.row_id
    GROUP BY a.row_id, b.row_id, a.size, b.size HAVING 100 * count(*) >= 85 * (a.size + b.size - count(*))
), reach(x, y) AS (
    SELECT row_id, row_id FROM sets
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, m.component_id
FROM sets s JOIN (SELECT r.x, min(t.doc_id) AS component_id FROM reach r JOIN sets t ON r.y = t.row_id GROUP BY r.x) m
  ON s.row_id = m.x"""

_TERMS = "regexp_extract_all({text}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(text=_LOWER)

RANKED_SEARCH = f"""
WITH docs AS (
    SELECT * FROM (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS terms FROM documents) WHERE len(terms) > 0
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs
), counts AS (
    SELECT row_id, doc_id, term, 50 + (50 * n * (SELECT n_docs FROM totals)) // (SELECT n_terms FROM totals) AS m, count(*) AS tf
    FROM (SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY row_id, doc_id, n, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * (SELECT n_docs FROM totals) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts GROUP BY term
), asked AS (
    SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark
), parts AS (
    SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM asked
), scores AS (
    SELECT p.item, p.item_id, c.row_id, c.doc_id,
           CAST(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * c.m))) AS BIGINT) AS score
    FROM parts p JOIN weights w ON p.term = w.term JOIN counts c ON p.term = c.term
    GROUP BY p.item, p.item_id, c.row_id, c.doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32, bit by bit, over the digits of the id.
_CRC = """xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                      lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))))"""
_RUN = "OVER (PARTITION BY tree, level, place // 8 ORDER BY place ROWS BETWEEN "

MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS row_id, doc_id, lang, {_LEAF.format(text="text")} AS leaf,
           CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_LEAF.format(text=_FOLDED)} END AS tampered FROM documents
), placed AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS members,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), grown(tree, level, place, hash, members) AS (
    SELECT tree, 0, place, leaf, members FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 8, sha256(string_agg(hash, '' ORDER BY place)), any_value((members + 7) // 8)
    FROM grown WHERE members > 1 GROUP BY tree, level, place // 8
), subroots AS (
    SELECT tree, hash FROM grown WHERE members = 1
), topped(tree, level, place, hash, members) AS (
    SELECT -1, 0, tree, hash, (SELECT count(*) FROM subroots) FROM subroots
    UNION ALL
    SELECT -1, level + 1, place // 8, sha256(string_agg(hash, '' ORDER BY place)), any_value((members + 7) // 8)
    FROM topped WHERE members > 1 GROUP BY level, place // 8
), steps AS (
    SELECT CAST(tree AS BIGINT) AS tree, level, place, (members <= 8 AND tree >= 0) AS leaves_tree,
           coalesce(string_agg(hash, '') {_RUN} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
           coalesce(string_agg(hash, '') {_RUN} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
    FROM (SELECT * FROM grown UNION ALL SELECT * FROM topped) WHERE members > 1
), climb(row_id, n, tree, level, place, hash, proof) AS (
    SELECT row_id, 0, CAST(CASE WHEN members > 1 THEN tree ELSE -1 END AS BIGINT), 0,
           CASE WHEN members > 1 THEN place ELSE tree END, coalesce(tampered, leaf), '' FROM placed
    UNION ALL
    SELECT c.row_id, c.n + 1, CASE WHEN s.leaves_tree THEN -1 ELSE s.tree END, CASE WHEN s.leaves_tree THEN 0 ELSE s.level + 1 END,
           CASE WHEN s.leaves_tree THEN s.tree ELSE s.place // 8 END,
           sha256(s.lefts || c.hash || s.rights), c.proof || s.lefts || s.rights
    FROM climb c JOIN steps s ON c.tree = s.tree AND c.level = s.level AND c.place = s.place
), ends AS (
    SELECT row_id, arg_max(hash, n) AS hash, arg_max(proof, n) AS proof FROM climb GROUP BY row_id
), roots AS (
    SELECT hash FROM topped WHERE members = 1
)
SELECT p.doc_id, p.leaf, s.hash AS subroot, (SELECT hash FROM roots) AS root, sha256(e.proof) AS proof_sha256,
       e.hash AS folded_root, e.hash = (SELECT hash FROM roots) AS verified
FROM placed p JOIN subroots s ON p.tree = s.tree JOIN ends e ON p.row_id = e.row_id"""
