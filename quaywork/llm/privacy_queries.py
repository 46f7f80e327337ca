"""The personal data query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.llm.common import table
from quaywork.llm.privacy import KINDS, TERM, find_private, span_list
from quaywork.llm.registry import query


@query("op2_pii")
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every whole document."""
    found = find_private(table(spark, folder, "documents"), carry=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != TERM)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
        count(TERM),
    )
