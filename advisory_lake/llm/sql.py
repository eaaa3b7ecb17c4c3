"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP1 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages
), grouped AS (
  SELECT *, strlen(payload) AS payload_bytes,
    CASE WHEN strlen(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS least
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN least IS NULL OR page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM grouped
"""

OP2 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


OP12 = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def all_sql() -> dict[str, str]:
    return {"op1_warc_round_trip": OP1, "op2_exact_top_k": OP2, "op12_hard_negatives": OP12}
