"""DuckDB SQL for the queries that SQL can express."""

OP1 = """
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, CASE WHEN html IS NULL THEN ''::BLOB ELSE encode(html) END AS body FROM pages
), h AS (
  SELECT page_id, url, octet_length(body) AS n, sha1(body) AS s,
    row_number() OVER (PARTITION BY sha1(body) ORDER BY page_id DESC NULLS LAST, url DESC) AS k,
    first_value(page_id) OVER (PARTITION BY sha1(body) ORDER BY page_id DESC NULLS LAST, url DESC) AS response
  FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes,
  translate(array_to_string([lpad(upper(to_base(('0x' || substr(s, 1 + 5 * k, 5))::BIGINT, 32)), 4, '0') FOR k IN range(8)], ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN h.k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN h.k > 1 THEN response END AS refers_to
FROM h
"""

_MIX = """
sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ((('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS n FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, [5, 2, 1][(n % 3 + 1)::INT] AS weight, 2 * source_size AS most, (2 * source_size)::DOUBLE / [5, 2, 1][(n % 3 + 1)::INT] AS ratio FROM totals
), levels AS (
  SELECT *, ((1.5::DOUBLE * sum(source_size) OVER ()) - coalesce(sum(most) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM weighed WINDOW w AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), edge AS (
  SELECT ratio, level FROM levels WHERE level <= ratio ORDER BY ratio, source ASC NULLS LAST LIMIT 1
), goals AS (
  SELECT l.source, l.source_size, CASE WHEN edge.ratio IS NULL OR l.ratio < edge.ratio THEN l.most::DOUBLE ELSE least(l.most::DOUBLE, edge.level * l.weight) END AS target
  FROM levels l LEFT JOIN edge ON true
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS sure,
    CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS p FROM goals
), ranked AS (
  SELECT s.doc_id, s.source, s.size, r.source_size, r.target, r.sure, r.p, r.target - r.sure * r.source_size AS remaining,
    CASE WHEN r.p > 0 THEN u / (1 - u) / (r.p / (1 - r.p)) END AS rank_key
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank_key, doc_id ASC NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ranked
)
"""

OP6 = (
    "WITH "
    + _MIX
    + """
SELECT doc_id, size, source_size, target, (size * (sure + CASE WHEN p > 0 AND ahead + size / 2 <= remaining THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed
"""
)

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

SQL = {"op5_top_k": OP5, "op1_warc": OP1, "op6_mixing": OP6}
