"""DuckDB SQL of the queries that SQL can express."""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op2_minhash_dedup"] = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'),
    '{_WORDS}') AS ws FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS shingles
  FROM worded
), sizes AS (SELECT doc_id, len(shingles) AS n FROM sets),
rows_ AS (SELECT doc_id, unnest(shingles) AS s FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM rows_ x JOIN rows_ y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN roots USING (doc_id)
"""

ORACLES["op6_mixing"] = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per
), stepped AS (
  SELECT *, 3.0::DOUBLE * source_size AS full_,
    ((SELECT sum(source_size) FROM per)
      - coalesce(sum(3 * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM weighed
), chosen AS (
  SELECT level FROM stepped WHERE full_ >= weight * level ORDER BY 3.0::DOUBLE * source_size / weight, source LIMIT 1
),
aimed AS (
  SELECT source, source_size, weight, least(3.0::DOUBLE * source_size, weight * (SELECT level FROM chosen)) AS target
  FROM weighed
), placed AS (
  SELECT doc_id, size, source_size, target, weight,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5(doc_id::VARCHAR), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at_,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
), counted AS (
  SELECT *, (floor(ratio) + CASE WHEN at_ + size / 2.0::DOUBLE < (ratio - floor(ratio)) * source_size
    THEN 1 ELSE 0 END)::BIGINT AS copies,
    CASE WHEN target > 0 THEN least(at_ / target, 1.0::DOUBLE) ELSE 0 END AS share,
    [-0.5::DOUBLE, 0.0::DOUBLE, 0.5::DOUBLE][weight] AS drift
  FROM placed
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
  CASE WHEN copies > 0 THEN CASE WHEN drift = 0 THEN share ELSE
    (sqrt((1 - drift) * (1 - drift) + 2 * ((1 + drift) - (1 - drift)) * (((1 - drift) + (1 + drift)) / 2) * share)
      - (1 - drift)) / ((1 + drift) - (1 - drift)) END END AS position
FROM counted
"""

ORACLES["op1_embedding_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN counts USING (vec_id)
"""
