"""Copies of external tables into one or two stores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators.schema import clean_names
from revloom.sources.catalog import tables_to_copy
from revloom.sources.writers import mirror


def copy_tables(
    every: list[str], read: Callable[[str], DataFrame], folder: str, write: list[Callable[[str, DataFrame], None]], modified, as_of, **scope
) -> list[str]:
    """Copy the tables due (`tables_to_copy`) to a folder and from there to further stores. Returns their names."""
    due = tables_to_copy(every, modified, as_of, **scope)
    for name in due:
        mirror(read(name), f"{folder}/{name}", *[lambda df, w=w, n=name: w(n, df) for w in write])
    return due


def cleaned(table: DataFrame) -> DataFrame:
    """A table under warehouse-safe column names, ready to overwrite its copy."""
    return clean_names(table)


def activity_dates(report: DataFrame, date: str = "Last Activity Date") -> DataFrame:
    """Activity report with its date typed and clean names."""
    return clean_names(report.withColumn(date, F.to_date(f"`{date}`")))
