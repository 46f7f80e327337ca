"""The archive query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.common import table
from quaywork.llm.registry import query
from quaywork.llm.warc import read_archives, write_archives

SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
latest AS (
  SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM p LEFT JOIN latest USING (payload_digest)
"""


@query("op6_warc", SQL)
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back."""
    files = write_archives(table(spark, folder, "pages"))
    read = read_archives(files, with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
