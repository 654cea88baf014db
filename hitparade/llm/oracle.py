"""SQL for the queries that SQL can express."""

from hitparade.llm.line_dedup import PASSAGE
from hitparade.llm.quality import STOP_WORDS

SPACE = r"\x20\x09-\x0D"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '[^{SPACE}]+')"


_STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)

QUALITY = f"""
WITH cut AS (
  SELECT doc_id, text, {_words("text")} AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^{SPACE}]')) AS lines,
    {_words("regexp_replace(lower(text), '[.,;:!?]', '', 'g')")} AS plain
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
), places AS (
  SELECT doc_id, p, array_to_string(words[p : p + 7], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM cut)
), covered AS (
  SELECT doc_id, count(DISTINCT p + o) AS n FROM (
    SELECT doc_id, p, unnest(range(8)) AS o FROM (
      SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS times FROM places) WHERE times > 1)
  GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words) AS n_words,
    CAST(length(regexp_replace(text, '[{SPACE}]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_marks, len(lines) AS n_lines,
    len(list_filter(plain, lambda w: w IN ({_STOPS}))) AS n_stops
  FROM cut LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * word_chars < 200 * n_words OR 100 * word_chars > 1500 * n_words
    OR 100 * n_symbols > 10 * n_words OR 100 * n_marks > 50 * n_words OR 100 * n_stops < 4 * n_words
    OR 100 * n_dup_lines > 40 * n_lines) AS kept
FROM judged
"""

_RANKED = f"""units AS (
  SELECT *, {_words(LOWER.format("line"))} AS words FROM lines
), ranked AS (
  SELECT doc_id, unit, start, CAST(start + length(line) AS INTEGER) AS "end", CAST(len(words) AS INTEGER) AS n_words,
    first_value(doc_id) OVER same AS kept_doc_id, first_value(start) OVER same AS kept_start,
    row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS place
  FROM units WHERE len(words) >= 1
  WINDOW same AS (PARTITION BY array_to_string(words, ' ') ORDER BY doc_id NULLS FIRST, start)
), again AS (
  SELECT * FROM ranked WHERE (doc_id, start) IS DISTINCT FROM (kept_doc_id, kept_start)
)"""

LINES_ALL = f"""
WITH lines AS (
  SELECT doc_id, CAST(unit - 1 AS INTEGER) AS unit, line,
    CAST(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY unit) - length(line) - 1 AS INTEGER) AS start
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS unit
    FROM documents WHERE text IS NOT NULL)
), {_RANKED}
SELECT * EXCLUDE (place) FROM again
"""

#: Cuts are marked by a character that texts don't have; the line break after one is no part of a unit.
SENTENCES = f"""
WITH cut AS (
  SELECT doc_id, string_split(replace(regexp_replace(text, '([.!?])([\\x20\\x09\\x0B-\\x0D])', '\\1' || chr(57344) || '\\2', 'g'), chr(10), chr(57344) || chr(10)), chr(57344)) AS parts
  FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, CAST(unit - 1 AS INTEGER) AS unit, ltrim(part, chr(10)) AS line,
    CAST(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY unit) - length(ltrim(part, chr(10))) AS INTEGER) AS start
  FROM (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS unit FROM cut)
), {_RANKED}, runs AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM again
)
SELECT * EXCLUDE (place, run) FROM runs QUALIFY sum(n_words) OVER (PARTITION BY doc_id, run) >= {PASSAGE}
"""

LEAKS = f"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, size, array_to_string(words[p : p + size - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS p FROM (
    SELECT *, least(10, len(words)) AS size FROM item_words WHERE len(words) > 0))
), document_words AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words FROM documents
), places AS (
  SELECT doc_id, size, p, array_to_string(words[p : p + size - 1], ' ') AS k
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p
    FROM document_words, (SELECT DISTINCT size FROM windows))
), found AS (
  SELECT doc_id, size, p, item FROM places JOIN windows USING (size, k)
), hits AS (
  SELECT doc_id, count(DISTINCT p + o) AS n FROM (SELECT doc_id, p, unnest(range(size)) AS o FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found)
  GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM document_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, coalesce({_words(LOWER.format("text"))}, []) AS words FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda p: array_to_string(words[p : p + 3], ' ')) END) AS shingles FROM cut
), each AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM each AS x JOIN each AS y USING (shingle) WHERE x.doc_id <> y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), smallest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN smallest USING (doc_id)
"""

_CRC = (
    "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), "
    "lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"
)


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over leaves (key, n, pos, node), and the nodes on either side of each in its run."""
    side = "coalesce(string_agg(node, '') OVER (PARTITION BY key, level, pos >> 3 ORDER BY pos ROWS BETWEEN {}), '')"
    return f"""{name}(level, key, n, pos, node) AS (
  SELECT 0, key, n, pos, node FROM {leaves}
  UNION ALL SELECT any_value(level) + 1, key, (any_value(n) + 7) // 8, pos >> 3, sha256(string_agg(node, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY key, pos >> 3
), {name}_sides AS (
  SELECT level, key, pos, {side.format("UNBOUNDED PRECEDING AND 1 PRECEDING")} AS l,
    {side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")} AS r
  FROM {name} WHERE n > 1
)"""


def _fold(name: str, starts: str, tree: str) -> str:
    """What the rows of starts (id, key, pos, node, proof) add up to on their way up."""
    return f"""{name}(id, level, key, pos, node, proof) AS (
  SELECT id, 0, key, pos, node, proof FROM {starts}
  UNION ALL SELECT id, f.level + 1, f.key, f.pos >> 3, sha256(l || node || r), proof || l || r
  FROM {name} AS f JOIN {tree}_sides AS s ON s.key = f.key AND s.level = f.level AND s.pos = f.pos
), {name}_end AS (
  SELECT id, arg_max(key, level) AS key, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM {name} GROUP BY id
)"""


MERKLE = f"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n
  FROM (SELECT row_number() OVER () AS id, doc_id, {_leaf("text")} AS node, coalesce('=' || lang, '-') AS key,
    CASE WHEN xor({_CRC}, 4294967295) % 3 = 0 THEN {_leaf(LOWER.format("text"))} END AS tampered FROM documents)
), {_tree("nodes", "docs")}, subroots AS (
  SELECT key AS own, '' AS key, node, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), {_tree("tops", "subroots")}, starts AS (
  SELECT 2 * id AS id, key, pos, node, '' AS proof FROM docs
  UNION ALL SELECT 2 * id + 1, key, pos, coalesce(tampered, node), '' FROM docs
), {_fold("up", "starts", "nodes")}, again AS (
  SELECT id, '' AS key, s.pos, u.node, u.proof FROM up_end AS u JOIN subroots AS s ON u.key = s.own
), {_fold("over", "again", "tops")}
SELECT doc_id, d.node AS leaf, s.node AS subroot, a.node AS root, sha256(a.proof) AS proof_sha256, b.node AS folded_root,
  a.node = b.node AS verified
FROM docs AS d JOIN subroots AS s ON d.key = s.own JOIN over_end AS a ON a.id = 2 * d.id JOIN over_end AS b ON b.id = 2 * d.id + 1
"""

NEGATIVES = """
WITH vectors AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors AS a JOIN vectors AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, id AS negative_id, positive_score,
  score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 10
"""

ORACLE = {
    "op4_decontamination": LEAKS,
    "op7_quality_rules": QUALITY,
    "op9_line_dedup": SENTENCES,
    "op9_line_dedup_all": LINES_ALL,
    "op10_near_dedup": NEAR,
    "op11_merkle_manifest": MERKLE,
    "op12_hard_negatives": NEGATIVES,
}
