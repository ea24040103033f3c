"""All registered queries; importing this module registers them."""

from tidemark.plans import (  # noqa: F401
    mart_queries,
    quality_queries,
    row_queries,
    stream_queries,
    table_queries,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
