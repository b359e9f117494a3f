"""Queries on embeddings."""

from pyspark.sql import functions as F

from labflow.llm import capfilters, nearest
from labflow.llm.common import read_table

NEIGHBOURS = 10
QUERY_STEP = 100
LEAST_COSINE = 0.93


def op4_one_bit_neighbours(spark, folder):
    """The nearest vectors of every hundredth one."""
    vectors = read_table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), NEIGHBOURS)


OP4_SQL = f"""
WITH vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])),
      lambda s, x: s + x)) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % {QUERY_STEP} = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
WHERE rank <= {NEIGHBOURS}
"""


def op6_cap_filter_duplicates(spark, folder):
    """Links and components of near-duplicate vectors within a label."""
    return capfilters.near_duplicates(read_table(spark, folder, "embeddings"), LEAST_COSINE)


OP6_SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    AND list_cosine_similarity(a.v, b.v) >= {LEAST_COSINE}),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id)::BIGINT AS n_links,
  coalesce((SELECT min(b) FROM reached WHERE reached.a = e.vec_id), e.vec_id) AS component_id,
  coalesce((SELECT min(b) FROM reached WHERE reached.a = e.vec_id), e.vec_id) = e.vec_id AS kept
FROM embeddings e
"""
