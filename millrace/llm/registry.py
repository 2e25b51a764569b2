"""Name -> query and name -> oracle SQL of this subpackage."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("toxicity", "language", "neighbours", "edits", "packing", "mixing", "similar", "repeats", "fertility", "pages", "sketches", "turns", "periods")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"millrace.llm.{name}")
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    all_queries()
    return dict(ORACLES)
