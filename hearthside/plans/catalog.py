"""Importing this module registers every query."""

from hearthside.plans import (  # noqa: F401
    clean_queries,
    deal_queries,
    ingest_queries,
    market_queries,
    model_queries,
    page_queries,
    search_queries,
    source_queries,
    text_queries,
)
from hearthside.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
