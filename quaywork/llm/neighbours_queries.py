"""The nearest neighbour query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.llm.common import table
from quaywork.llm.neighbours import nearest
from quaywork.llm.registry import query


@query("op8_nearest")
def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest embeddings of every one whose id is divisible by 50, among all."""
    rows = table(spark, folder, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)
