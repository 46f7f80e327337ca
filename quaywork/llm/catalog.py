"""All queries of this subpackage and their checking SQL."""

from quaywork.llm import (  # noqa: F401
    alignment_queries,
    chat_queries,
    language_queries,
    mixing_queries,
    neighbours_queries,
    pieces_queries,
    privacy_queries,
    quality_queries,
    range_join_queries,
    repair_queries,
    simhash_queries,
    toxicity_queries,
    warc_queries,
)
from quaywork.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
