"""Queries over the star-schema test tables, each with the SQL it must agree with."""

from importlib import import_module

MODULES = ("scalars", "relational", "changes", "documents", "usage", "revenue", "stored", "chain")


def load_all():
    """The registry, with every query module loaded."""
    for name in MODULES:
        import_module(f"revloom.queries.{name}")
    return import_module("revloom.queries.registry")
