"""All registered queries, gathered from the query modules."""

from __future__ import annotations

import importlib

from tidemark.plans import registry

MODULES = [
    "aggregations",
    "parsing",
    "filtering",
    "combining",
    "files",
    "topics",
    "streams",
]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"tidemark.plans.{name}")


def queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
