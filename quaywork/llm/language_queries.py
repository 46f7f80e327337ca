"""The language query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.common import table
from quaywork.llm.language import fit_chain, identify
from quaywork.llm.registry import query
from quaywork.llm.toxicity import held_out


@query("op10_language")
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every whole document, learned outside fold 2 of 4."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    fold = held_out("doc_id", 4, 2)
    found = identify(docs, fit_chain(docs.where(~fold)))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")
