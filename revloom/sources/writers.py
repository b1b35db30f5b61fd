"""Loads into tables: overwrite, append, mirror, load stamp."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: How outputs that the next step reads back are written: sorted keys by what they differ in, and packed closer than by default.
STORED = {"compression": "zstd", "parquet.writer.version": "v2"}
#: Outputs that are written at once.
AT_A_TIME = 3


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, **options) -> None:
    """Replace the table, creating it if needed. With partitions only those in `df` are replaced."""
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def stored(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Tables that do not build on each other, written below `folder` and read back. A few are written at a time, so that the last
    tasks of one leave no machine idle."""
    def one(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, df = item
        overwrite(df, f"{folder}/{name}", **STORED)
        return name, df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(AT_A_TIME) as pool:
        return dict(pool.map(inheritable_thread_target(spark)(one), tables.items()))


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append; an empty frame adds no rows."""
    df.write.mode("append").format(fmt).save(path)


def append_if_any(df: DataFrame | None, path: str, fmt: str = "parquet") -> bool:
    """Append a frame that exists and has rows; tells whether it did. The plan runs once, its rows are counted on the way."""
    if df is None:
        return False
    seen = Observation()
    append(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt)
    return seen.get["rows"] > 0


def append_day(df: DataFrame, path: str, load_date: str, column: str = "load_date") -> None:
    """Append under a load date. A rerun of the same date replaces it instead of doubling it."""
    overwrite(df.withColumn(column, F.lit(load_date).cast("date")), path, partition_by=[column])


def append_stamped(df: DataFrame, path: str, loaded_at) -> None:
    append(df.withColumn("now", F.lit(str(loaded_at)).cast("timestamp")), path)


def mirror(df: DataFrame, path: str, *sinks: Callable[[DataFrame], None], fmt: str = "parquet") -> None:
    """One frame into a table at `path` and, read back from there, into further sinks: computed once, held nowhere else."""
    overwrite(df, path, fmt)
    stored = df.sparkSession.read.format(fmt).schema(df.schema).load(path)
    for sink in sinks:
        sink(stored)


def write_all(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite", last: str | None = None) -> None:
    """A job's outputs, one folder each. `last` is written after the others: it tells what is complete."""
    names = [n for n in tables if n != last] + ([last] if last else [])
    for name in names:
        tables[name].write.mode(mode).parquet(f"{folder}/{name}")


def _as_array(batches):
    """The lines of one JSON array from those of its records, as they come."""
    mark = "["
    for batch in batches:
        if batch.num_rows:
            marks = pa.array([mark] + [","] * (batch.num_rows - 1))
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column(0), "")], ["value"])
            mark = ","
    yield pa.RecordBatch.from_pydict({"value": ["[]" if mark == "[" else "]"]})


def write_json_array(records: DataFrame, path: str) -> None:
    """JSON texts, one column, into one file that is a single array, in no order. Its one task passes them on and holds a batch of them."""
    name = records.columns[0]
    lines = records.select(F.col(name).alias("value")).where("value IS NOT NULL").repartition(1).mapInArrow(_as_array, "value string")
    lines.write.text(path)


def write_sql_table(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Load into an external SQL table over JDBC; an overwrite empties the table and keeps its definition."""
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, truncate=True, **options).save()
