"""What tables exist, how fresh they are, which fields they have."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.functions.dates import from_millis
from revloom.operators.schema import nested_to_json

# The tables a daily refresh always takes, and the mark of those taken besides.
DAILY_TABLES = (
    "assets", "contract_renewal_discount", "contract_renewal_links", "contracts", "customers", "license_info",
    "line_item", "orders", "product", "quotes", "serialnumbers", "users",
)
DAILY_MARK = "sanitized"
FULL_REFRESH_AFTER_DAYS = 7


def tables_matching(tables: DataFrame, pattern: str, name: str = "table_name", time: str = "creation_time") -> DataFrame:
    """Catalog rows whose table name matches, oldest first."""
    return tables.where(F.col(name).rlike(pattern)).orderBy(F.col(time).asc_nulls_last(), name)


def list_tables(spark: SparkSession, database: str, pattern: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if re.search(pattern, t.name))


def last_modified(metadata: DataFrame, table: str, name: str = "table_id", millis: str = "last_modified_time") -> dt.datetime | None:
    """Newest modification time of one table, from a metadata table in epoch millis."""
    return metadata.where(F.col(name) == table).agg(F.max(from_millis(millis))).first()[0]


def is_behind(modified: dt.datetime | None, as_of: dt.date) -> bool:
    """Is the target empty, or a week or more behind?"""
    return modified is None or modified <= dt.datetime.combine(as_of, dt.time()) - dt.timedelta(days=FULL_REFRESH_AFTER_DAYS)


def tables_to_copy(
    every: list[str], modified: dt.datetime | None, as_of: dt.date, short: tuple[str, ...] = DAILY_TABLES, mark: str = DAILY_MARK
) -> list[str]:
    """All tables when the target is behind, else the short list and marked ones."""
    return [t for t in every if is_behind(modified, as_of) or t in short or mark in t]


def due(name: Column, modified: dt.datetime | None, as_of: dt.date, short: tuple[str, ...] = DAILY_TABLES, mark: str = DAILY_MARK) -> Column:
    """`tables_to_copy` as a condition on a column of table names."""
    return F.lit(is_behind(modified, as_of)) | name.isin(*short) | F.contains(name, F.lit(mark))


def field_catalog(described: DataFrame) -> DataFrame:
    """Field metadata, one row per field: name and label first, nested columns as text, all of it.

    A sheet whose cells hold less takes `text.truncate`.
    """
    return nested_to_json(described, first=("name", "label"))


def describe(df: DataFrame) -> DataFrame:
    """Field metadata of a frame itself: name, label, type, nullable."""
    rows = [(f.name, f.name.replace("_", " "), f.dataType.simpleString(), f.nullable) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, label string, type string, nullable boolean")
