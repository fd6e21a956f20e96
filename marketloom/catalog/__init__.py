"""The registered queries and, where SQL can say the same, their DuckDB counterparts."""

from __future__ import annotations

from importlib import import_module

MODULES = ["scans_sinks", "projections", "relational", "quality", "jobs", "recommenders"]


def load():
    """(queries, oracle SQL) of all modules, by name."""
    from marketloom.catalog import base

    for name in MODULES:
        import_module(f"marketloom.catalog.{name}")
    return dict(base.QUERIES), dict(base.ORACLES)
