"""Collects the registered queries and their oracle SQL from every query module."""
from __future__ import annotations

import importlib

MODULES = ["marts", "cleaning", "joins", "windows", "aggregates", "ingestion", "quality", "tables", "dictionary", "misc", "corrections", "estimates", "rules", "lifecycle"]


def _modules():
    return [importlib.import_module(f"microlake.queries.{m}") for m in MODULES]


def all_queries() -> dict:
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    for m in _modules():
        out.update(getattr(m, "SQL", {}))
    return out
