"""The cross-tokenizer alignment query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.llm.alignment import align, link_scores
from quaywork.llm.common import settle, table
from quaywork.llm.registry import query


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Token groups and link counts of every whole document."""
    aligned = align(table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    narrow = aligned.select(
        F.monotonically_increasing_id().alias("place"),
        F.col("row.doc_id").alias("doc_id"),
        "n_a",
        "n_b",
        "n_groups",
        digest.alias("groups_sha256"),
        "pairs",
        "times",
    )
    return link_scores(settle(narrow, "aligned")).drop("place")
