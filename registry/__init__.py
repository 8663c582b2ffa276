"""Registered queries: every operator run on the driver's tables, with SQL to check it."""

from __future__ import annotations

import importlib
from types import ModuleType

MODULES = (
    "source_queries", "quality_queries", "model_queries", "load_queries", "mart_queries",
    "analysis_queries", "serving_queries", "stored_queries",
)


def load_all() -> ModuleType:
    """The catalog with every query module imported."""
    for module in MODULES:
        importlib.import_module(f"registry.{module}")
    return importlib.import_module("registry.catalog")
