"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from mailgauge.llm.lines import MIN_CHARS, MIN_DOCS
from mailgauge.llm.urls import RULES, SOFT_HITS, SOFT_TERMS, STRICT_TERMS
from mailgauge.llm.vector_dedup import MIN_COSINE

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower_ascii(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rules(value: str) -> str:
    cases = []
    for rule in sorted(RULES, key=lambda r: -len(r.text)):
        fits = f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"
        cases.append(f"WHEN {fits} THEN '{rule.text if value == 'text' else rule.verdict}'")
    return f"CASE {' '.join(cases)} END"


def _hits(terms) -> str:
    bounded = [f"CAST(regexp_matches(lowered, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INTEGER)" for t in sorted(set(terms))]
    return f"coalesce({' + '.join(bounded)}, 0)"


OP6 = f"""
WITH parts AS (
  SELECT page_id, {_lower_ascii("url")} AS lowered,
         coalesce({_lower_ascii("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")}, '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
counted AS (
  SELECT *, {_rules("text")} AS rule, {_rules("verdict")} AS ruled,
         {_hits(STRICT_TERMS)} AS strict_hits, {_hits(SOFT_TERMS)} AS soft_hits
  FROM parts)
SELECT page_id, host, path, rule, strict_hits, soft_hits,
       coalesce(ruled, CASE WHEN strict_hits > 0 OR soft_hits >= {SOFT_HITS} THEN 'block' ELSE 'allow' END) AS verdict
FROM counted
"""

OP9 = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, doc_id, generate_subscripts(lines, 1) AS place, unnest(lines) AS line FROM rows),
keyed AS (
  SELECT *, trim({_lower_ascii("line")}, {_BLANKS}) AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT r) >= {MIN_DOCS})
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY r
"""

OP12 = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {MIN_COSINE}),
reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
components AS (SELECT a, min(b) AS least FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN components c ON vec_id = c.a LEFT JOIN counts n ON vec_id = n.a
"""

# crc32 of ASCII text, bit by bit: a byte is mixed in, then shifted out in eight steps (marked -1).
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split({0}, '')])),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                        ELSE xor(crc >> 1, CASE WHEN crc % 2 = 1 THEN 3988292384 ELSE 0 END) END))"""


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    written = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END" for v in values]
    return f"sha256({' || '.join(written)})"


def _tree(name: str, leaves: str) -> str:
    """Nodes of a tree, and what stands to the left and right of each in its run."""
    run = "PARTITION BY grp, level, rank // 8 ORDER BY rank ROWS BETWEEN"
    return f"""
{name} AS (
  SELECT grp, 0 AS level, rank, hash, count(*) OVER (PARTITION BY grp) AS size FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, rank // 8, sha256(string_agg(hash, '' ORDER BY rank)), any_value((size + 7) // 8)
  FROM {name} WHERE size > 1 GROUP BY grp, level, rank // 8),
{name}_steps AS (
  SELECT grp, level, rank,
         coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lhs,
         coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rhs
  FROM {name} WHERE size > 1)"""


OP13 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('+' || lang, '') AS grp, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf(_lower_ascii("text"))} END AS altered
  FROM documents),
placed AS (
  SELECT *, leaf AS hash, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM docs),
{_tree("nodes", "placed")},
subroots AS (
  SELECT grp AS name, 0 AS grp, row_number() OVER (ORDER BY grp) - 1 AS rank, hash, level AS height
  FROM nodes WHERE size = 1),
{_tree("tops", "subroots")},
root AS (SELECT hash AS root FROM tops WHERE size = 1),
steps AS (
  SELECT p.grp, p.rank, s.level, lhs, rhs FROM placed p JOIN nodes_steps s ON p.grp = s.grp AND p.rank >> (3 * s.level) = s.rank
  UNION ALL
  SELECT p.grp, p.rank, u.height + s.level, lhs, rhs
  FROM placed p JOIN subroots u ON p.grp = u.name JOIN tops_steps s ON u.rank >> (3 * s.level) = s.rank),
proofs AS (
  SELECT grp, rank, sha256(string_agg(lhs || rhs, '' ORDER BY level)) AS proof, count(*) AS height FROM steps GROUP BY grp, rank),
folds AS (
  SELECT grp, rank, 0 AS level, coalesce(altered, leaf) AS hash FROM placed
  UNION ALL
  SELECT f.grp, f.rank, f.level + 1, sha256(s.lhs || f.hash || s.rhs)
  FROM folds f JOIN steps s ON f.grp = s.grp AND f.rank = s.rank AND f.level = s.level)
SELECT doc_id, leaf, u.hash AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256,
       f.hash AS folded_root, f.hash = root AS verified
FROM placed p JOIN subroots u ON p.grp = u.name CROSS JOIN root
LEFT JOIN proofs q ON p.grp = q.grp AND p.rank = q.rank
JOIN folds f ON p.grp = f.grp AND p.rank = f.rank AND f.level = coalesce(q.height, 0)
"""

ORACLES: dict[str, str] = {
    "op6_url_filter": OP6,
    "op9_line_dedup": OP9,
    "op12_embedding_near_dedup": OP12,
    "op13_merkle_manifest": OP13,
}
