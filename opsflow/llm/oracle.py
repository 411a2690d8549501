"""DuckDB SQL of the queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL["op6_line_dedup"] = f"""
WITH rows_in AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM rows_in),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.k)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (k) GROUP BY r, doc_id
"""

ORACLE_SQL["op7_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k FROM s),
levels AS (
  SELECT k, 3 * source_size / w AS own,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM ranked WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fill AS (SELECT coalesce(arg_min(level, k) FILTER (WHERE own >= level), 0) AS level FROM levels),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, w * level) AS target FROM s, fill),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS whole FROM t),
c AS (
  SELECT doc_id, size, b.source_size, target, whole, target - whole * b.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source, h) AS tied,
    sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN whole < 3 AND 2 * (upto - tied) + tied <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""

ORACLE_SQL["op3_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN least_id ON a = vec_id
"""

ORACLE_SQL["op9_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE_SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS alike, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
