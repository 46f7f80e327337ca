"""The toxicity query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.common import table
from quaywork.llm.registry import query
from quaywork.llm.toxicity import Machine, fit_machine, held_out, score_toxicity


def production_machine(spark: SparkSession, docs: DataFrame, folder: str) -> Machine:
    """Learned from the labels outside fold 0 of 5."""
    labels = table(spark, folder, "labels").where(~held_out("doc_id", 5, 0))
    return fit_machine(docs, labels.select("doc_id", "toxic"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score and prediction of every whole document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, production_machine(spark, docs, folder))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
