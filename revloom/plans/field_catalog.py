"""Field lists of CRM objects as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revloom.sources.catalog import field_catalog


def run(described: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """described: object name -> field metadata (name, label, type, nested columns)."""
    return {name: field_catalog(df) for name, df in described.items()}
