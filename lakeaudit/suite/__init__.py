"""Registered queries: each with its Spark form and, where SQL can say it, an oracle."""

from __future__ import annotations

from importlib import import_module

from lakeaudit.suite.registry import ORACLES, QUERIES

MODULES = ("relational", "texts", "health", "nestedviews", "streams")

for _name in MODULES:
    import_module(f"lakeaudit.suite.{_name}")

__all__ = ["ORACLES", "QUERIES"]
