"""The registered queries of the core and their SQL equivalents."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

AREAS = ("nested_queries", "line_queries", "section_queries", "graph_queries", "block_queries", "record_queries", "box_queries", "table_queries", "glossary_queries", "file_queries")


def _areas() -> list:
    return [importlib.import_module(f"docloom.plans.{a}") for a in AREAS]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The registered queries by name."""
    return {n: f for a in _areas() for n, f in a.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL by query name, where SQL can state the operator."""
    return {n: s for a in _areas() for n, s in a.SQL.items()}
