"""Registered queries over the driver tables, each with the SQL that states the same result."""

from __future__ import annotations

from importlib import import_module

MODULES = ("risk", "places", "inspections", "items", "foods", "readings", "quality", "storage", "files")


def load() -> tuple[dict, dict]:
    queries, sql = {}, {}
    for name in MODULES:
        module = import_module(f"larderline.catalog.{name}")
        queries.update(module.REGISTRY.queries)
        sql.update(module.REGISTRY.sql)
    return queries, sql
