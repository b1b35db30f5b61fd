"""Forecast exports of several forecasts merged into five tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators.schema import clean_names, flatten, union_distinct

# List in the export -> table.
PARTS = {
    "entries": "entries", "users": "users", "fields": "field_map", "timePeriods": "time_period_map", "timeFrames": "time_frame_map",
}


def part(export: DataFrame, name: str) -> DataFrame:
    """One list of the export as rows, nested objects flattened."""
    return flatten(export.select(F.explode(name).alias("item")).select("item.*"))


def run(exports: list[DataFrame]) -> dict[str, DataFrame]:
    """exports: one frame per forecast id; their columns may differ. Equal rows are kept once."""
    return {
        table: clean_names(union_distinct(*[part(e, name) for e in exports if name in e.columns])) for name, table in PARTS.items()
    }
