"""The quality rules query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaywork.llm.common import table
from quaywork.llm.quality import fit_rules, judge
from quaywork.llm.registry import query
from quaywork.llm.toxicity import held_out


@query("op12_quality")
def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every whole document; the rules learn from the labels outside fold 0 of 5."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~held_out("doc_id", 5, 0)).select("doc_id", "quality")
    judged = judge(docs, fit_rules(docs, labels))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
        held_out("doc_id", 5, 0).alias("held_out"),
    )
