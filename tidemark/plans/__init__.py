"""Queries over the given tables, built from the operators."""

from __future__ import annotations

import importlib

from tidemark.plans.registry import ORACLES, QUERIES

MODULES = (
    "campaign_queries",
    "label_queries",
    "model_queries",
    "profit_queries",
    "quality_queries",
    "sampling_queries",
    "stump_queries",
    "table_queries",
    "window_queries",
)


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"tidemark.plans.{module}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_sql():
    _load()
    return dict(ORACLES)
