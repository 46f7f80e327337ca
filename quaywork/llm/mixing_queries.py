"""The mixing query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.llm.common import table
from quaywork.llm.mixing import plan_mix
from quaywork.llm.registry import query

SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
stats AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0::DOUBLE AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS bar FROM stats),
running AS (
  SELECT *,
    ((SELECT sum(source_size) FROM stats)::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY bar, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / (sum(weight) OVER (ORDER BY bar, source NULLS LAST
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS here
  FROM ordered),
flat AS (SELECT here AS level FROM running WHERE here <= bar ORDER BY bar, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(cap, weight * (SELECT level FROM flat)) AS target FROM running),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0 END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(floor(rate) + CASE WHEN
    CAST(('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)
      / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) * size AS taken
FROM rated
"""


@query("op1_mixing", SQL)
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed; one row per document with the words taken from it."""
    planned = plan_mix(table(spark, folder, "documents"), max_rate=3.0, seed=42)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken)
