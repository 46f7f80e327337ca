"""The embedding near-duplicate query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.common import table
from quaywork.llm.range_join import near_duplicates
from quaywork.llm.registry import query

SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
  vec_id <= coalesce(least.b, vec_id) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN degree ON vec_id = degree.a
"""


@query("op4_range_join", SQL)
def op4_range_join(spark: SparkSession, folder: str) -> DataFrame:
    """Links, groups and representatives among all embeddings at cosine 0.95."""
    found = near_duplicates(table(spark, folder, "embeddings"), least=0.95)
    return found.select("vec_id", "n_links", "component_id", "kept")
