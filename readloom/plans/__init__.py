"""Registered queries: operators applied to the given tables, each with the SQL that gives the same rows."""

from importlib import import_module

from readloom.plans.registry import QUERIES, SQL

for _name in ("scalars", "reads", "positions", "reports", "calls", "more", "segments", "files", "streams"):
    import_module(f"readloom.plans.{_name}")

__all__ = ["QUERIES", "SQL"]
