"""Query catalog: every registered query with its oracle SQL."""

from __future__ import annotations

CATALOG_MODULES = ("catalog", "catalog_series", "catalog_dashboard", "catalog_models", "catalog_tables")


def registry():
    """All registered queries (importing the catalog modules registers them)."""
    import importlib
    for name in CATALOG_MODULES:
        importlib.import_module(f"meterwise.plans.{name}")
    from meterwise.plans.catalog import REGISTRY
    return REGISTRY
