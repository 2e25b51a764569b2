"""Named queries over the given tables, each with the SQL its result is checked against."""

from __future__ import annotations

import importlib

from millrace.plans.registry import ORACLES, QUERIES, Query

MODULES = ("relational", "scalars", "sources", "table_changes", "audited_loads", "checks", "streams", "reports")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"millrace.plans.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
