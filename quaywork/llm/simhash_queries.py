"""The SimHash query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.common import table
from quaywork.llm.registry import query
from quaywork.llm.simhash import simhash_groups


@query("op5_simhash")
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of every document: 4-word shingles, at most 4 differing bits."""
    return simhash_groups(table(spark, folder, "documents"), shingle=4, distance=4, carry=["doc_id"])
