"""Importing this module registers every query of the subpackage."""

from hearthside.llm import queries, selection_queries  # noqa: F401
from hearthside.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
