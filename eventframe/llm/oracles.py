"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

COVER_TREE = """
WITH RECURSIVE live AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM live a JOIN live b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), comp AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

CHOSEN_PATH = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach(node, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
class AS (SELECT node, min(other) AS class_id FROM reach GROUP BY node), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT c.node AS doc_id, c.class_id, coalesce(d.n, 0)::BIGINT AS n_links FROM class c LEFT JOIN degree d ON d.a = c.node
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
    source_size::DOUBLE * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM src
), level AS (
  SELECT *, cap / w AS ratio, (budget - coalesce(sum(cap) OVER prev, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER prev, 0)) AS lam
  FROM weighed WINDOW prev AS (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), edge AS (SELECT ratio AS ratio0, r AS r0, lam AS lam0 FROM level WHERE ratio >= lam ORDER BY ratio, r LIMIT 1),
target AS (
  SELECT source, source_size, CASE WHEN ratio0 IS NOT NULL AND (ratio > ratio0 OR (ratio = ratio0 AND r >= r0)) THEN w * lam0 ELSE cap END AS target
  FROM level LEFT JOIN edge ON true
), docs AS (SELECT s.doc_id, s.source, s.size, t.source_size, t.target FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, md5(doc_id::VARCHAR || ':' || c::VARCHAR) AS o FROM docs, (VALUES (1), (2)) v(c)
  WHERE size > 0 AND target > 0 AND c <= ceil(target / source_size)
), queued AS (
  SELECT *, ((c - 1) * source_size + sum(size) OVER (PARTITION BY source, c ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING))::DOUBLE / target AS finish FROM copies
), taken AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source, o, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM queued
), words AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM taken WHERE total <= (SELECT sum(target) FROM target) GROUP BY doc_id)
SELECT d.doc_id, d.size, d.source_size, d.target, coalesce(w.taken, 0)::BIGINT AS taken FROM docs d LEFT JOIN words w USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p
), b AS (
  SELECT page_id, payload_bytes, hex, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (i // 8 * 10 + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest
  FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = min(page_id) OVER w THEN NULL ELSE min(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY payload_digest)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chosen_path_join": CHOSEN_PATH, "op6_cover_tree_pairs": COVER_TREE, "op8_source_mixing": MIXING, "op10_warc_packages": WARC}
