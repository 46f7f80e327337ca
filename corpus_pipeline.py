"""The corpus pipeline: documents to piece ids in five written stages.

Every stage takes (spark, docs, sf_dir) and works on all rows the one before it
kept.  ``run`` writes each stage as Parquet to the shared scratch folder and
reads it again for the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywork.llm.common import settle, table
from quaywork.llm.mixing import mix
from quaywork.llm.pieces import tokenize
from quaywork.llm.privacy import sanitise
from quaywork.llm.simhash import keep_one
from quaywork.llm.toxicity import keep_clean
from quaywork.llm.toxicity_queries import production_machine


def _with_sizes(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with n_chars of the text as it is now, where the table has that column."""
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the machine learns from the labels outside fold 0 of 5."""
    return keep_clean(docs, production_machine(spark, docs, sf_dir), at=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group by SimHash, that of the least doc_id: 4-word shingles, at most 4 differing bits."""
    return keep_one(docs, shingle=4, distance=4)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms that disclose it replaced."""
    return _with_sizes(sanitise(docs), docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources; all words kept are shared out."""
    return mix(docs, max_rate=3.0, seed=42)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every whole document."""
    return tokenize(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("mixing", mixing),
    ("piece_ids", piece_ids),
]

#: SQL has no factorization machine, SimHash or transducer; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
