"""Tables stored in hash partitions of their key: what a batch does to them touches only the partitions that it meets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.operators.changes import apply_change_set
from revloom.session import shared_folder
from revloom.sources.writers import overwrite

#: Partitions of a table, and the column that numbers them. The count belongs to the table: keep it for its life.
PARTITIONS, PART = 256, "key_part"


def part_of(keys: list[str], partitions: int = PARTITIONS) -> Column:
    """The partition of a key. Keys of different types are in different ones: cast them to the table's first."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(partitions)).cast("int")


def write(df: DataFrame, path: str, keys: list[str], partitions: int = PARTITIONS) -> None:
    """Replaces the whole table."""
    df.withColumn(PART, part_of(keys, partitions)).repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(path)


def met(batch: DataFrame, keys: list[str], partitions: int = PARTITIONS) -> list[int]:
    """The partitions that the keys of a batch are in. At most `partitions` numbers come to the driver."""
    return sorted(r[0] for r in batch.select(part_of(keys, partitions)).distinct().collect())


def read(spark: SparkSession, path: str, numbers: Iterable[int] | None = None) -> DataFrame | None:
    """The table, or just some of its partitions: others are not even listed for reading. None where there is no table."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return table if numbers is None else table.where(F.col(PART).isin([int(n) for n in numbers]))


def apply(changes: DataFrame, path: str, key: str, partitions: int = PARTITIONS) -> list[int]:
    """Applies a change set (`changes.change_set`) to the table at `path`; returns the partitions that were rewritten.

    The new rows of these partitions are written to the shared folder first and then replace the old ones, so the change set may
    come from the table itself, and a run that fails can be repeated. Rows of other partitions are neither read nor written.
    """
    spark = changes.sparkSession
    table = read(spark, path)
    kinds = dict(table.dtypes)
    due = changes.where("action <> 'noop'").withColumn(key, F.col(f"`{key}`").cast(kinds[key]))
    written = shared_folder(spark)
    due.write.parquet(written)  # what it is made from is worked through once
    due = spark.read.schema(due.schema).parquet(written)
    numbers = met(due, [key], partitions)
    if not numbers:
        return []
    old = read(spark, path, numbers).drop(PART)
    new = apply_change_set(old, due, key).withColumn(PART, part_of([key], partitions))
    staged = shared_folder(spark)
    new.repartition(PART).write.parquet(staged)
    rows = spark.read.schema(new.schema).parquet(staged)
    left = {r[0] for r in rows.select(PART).distinct().collect()}
    overwrite(rows, path, partition_by=[PART])
    drop(spark, path, [n for n in numbers if n not in left])
    spark.catalog.refreshByPath(path)
    return numbers


def drop(spark: SparkSession, path: str, numbers: list[int]) -> None:
    """Removes partitions that lost all their rows."""
    for n in numbers:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={n}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
