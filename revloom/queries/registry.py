"""Name -> (Spark query, SQL) registry and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from revloom.session import settle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """The tables of one scale folder; `t.orders` reads orders, wall-clock times as instants in UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            # through the read schema, not a cast, so that time filters still reach the scan
            fields = self.spark.read.parquet(path).schema
            instants = [T.StructField(f.name, T.TimestampType()) if isinstance(f.dataType, T.TimestampNTZType) else f for f in fields]
            _SCHEMAS[path] = T.StructType(instants)
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)


def query(name: str, sql: str | None = None):
    """Register fn(tables) under `name`, with the SQL giving the same columns and rows."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            settle(spark)
            return fn(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
