"""All registered queries and their checking SQL."""

from quaywork.plans import (  # noqa: F401
    capacity_queries,
    interchange_queries,
    io_queries,
    lookup_queries,
    report_queries,
    staging_queries,
    stream_queries,
    view_queries,
)
from quaywork.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
