"""The chat formatting query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.chat import format_chats
from quaywork.llm.common import table
from quaywork.llm.registry import query

SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
                       ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations),
c AS (SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY place) AS whole FROM t GROUP BY conv_id),
proper AS (SELECT DISTINCT list_slice(whole, 1, i) AS whole FROM (SELECT whole, unnest(range(1, n)) AS i FROM c)),
kept AS (
  SELECT min(conv_id) AS conv_id FROM c WHERE whole NOT IN (SELECT whole FROM proper) GROUP BY whole)
SELECT conv_id, CAST((place - 1) // 256 AS BIGINT) AS part, count(*) AS n_turns,
  string_agg('<|im_start|>' || CASE WHEN role = '' THEN 'unknown' ELSE replace(role, '<|', '< |') END
    || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
FROM t JOIN kept USING (conv_id) GROUP BY 1, 2
"""


@query("op3_chat", SQL)
def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All logged conversations, snapshots collapsed, rendered."""
    return format_chats(table(spark, folder, "conversations"))
