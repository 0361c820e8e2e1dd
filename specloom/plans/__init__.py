"""Registered queries: each names its Spark plan and, where SQL can state it, the SQL."""

from __future__ import annotations

import importlib
from types import ModuleType

FAMILIES = ("ingest", "catalogue", "melting", "mapping", "normalizing", "resolving",
            "quality", "comparing", "documents")


def load() -> ModuleType:
    """Import every family, so that all queries are registered."""
    for family in FAMILIES:
        importlib.import_module(f"specloom.plans.{family}")
    return importlib.import_module("specloom.plans.registry")
