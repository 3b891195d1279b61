"""SQL counterparts of the queries that SQL can express."""

# Words, md5 order, running sums and the filling of the targets are the operator's definitions, written for one table.
OP6_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), 'null')) || md5(coalesce(text, '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
         (CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE
          - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (SELECT source, source_size, least(most, max(level) OVER () * w) AS target FROM f),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT)
         AS taken
FROM p
"""

# All pairs compared. The operator finds nearly all links at a cosine close to 0.9 and all well above it.
OP2_EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT * FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links,
  (SELECT min(b) FROM reached WHERE reached.a = v.vec_id) AS component_id,
  v.vec_id = (SELECT min(b) FROM reached WHERE reached.a = v.vec_id) AS kept
FROM v
"""

ORACLES: dict[str, str] = {"op2_embedding_dedup": OP2_EMBEDDING_DEDUP, "op6_mixing": OP6_MIXING}
