"""Ready-made queries over the given tables, each next to its SQL statement."""

from __future__ import annotations

import importlib

MODULES = (
    "quality_queries",
    "cleaning_queries",
    "sampling_queries",
    "risk_queries",
    "cube_queries",
    "explorer_queries",
    "rule_queries",
    "segment_queries",
    "source_queries",
)


def _load():
    for module in MODULES:
        importlib.import_module(f"ledgerlens.plans.{module}")
    return importlib.import_module("ledgerlens.plans.registry")


def all_queries() -> dict:
    return dict(_load().QUERIES)


def all_statements() -> dict[str, str]:
    return dict(_load().STATEMENTS)
