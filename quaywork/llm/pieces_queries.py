"""The SentencePiece query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.common import table
from quaywork.llm.pieces import tokenize
from quaywork.llm.registry import query


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every whole document and whether they decode to its text."""
    return tokenize(table(spark, folder, "documents").select("doc_id", "text"))
