"""Registered queries over the given tables, each with the SQL that restates it."""

from importlib import import_module

MODULES = ("basics", "preparation", "features", "inference", "scores", "modelling", "learning")


def load():
    """Import every catalog module; returns (queries, sql)."""
    for name in MODULES:
        import_module(f"winnow.catalog.{name}")
    registry = import_module("winnow.catalog.registry")
    return registry.QUERIES, registry.ORACLES
