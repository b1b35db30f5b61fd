"""Intermediate tables in the shared folder, and rows that belong together read as a stream."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.session import shared_folder


def known_to_workers(spark: SparkSession) -> None:
    """Lets Python workers of the driver's machine import this package from where the driver has it. Elsewhere it is installed."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    settings = spark.sparkContext.environment
    paths = settings.get("PYTHONPATH", "")
    if here not in paths.split(os.pathsep):
        settings["PYTHONPATH"] = os.pathsep.join(x for x in (here, paths) if x)


def folder(spark: SparkSession) -> str:
    """A new folder that all machines share, below spark.checkpoint.dir."""
    return shared_folder(spark)


def stored(df: DataFrame, place: str) -> DataFrame:
    """Writes the rows as Parquet in `place` and reads them again: lost executors cost no more than this step."""
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def own_name(name: str, taken: list[str]) -> str:
    """The name of an output column beside the columns `taken`, which keep theirs: `name`, with underscores behind it if needed."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def as_row(df: DataFrame) -> Column:
    """A whole row in one struct, for work beside it that no column name can disturb."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


#: Bits of a table that tells which values may be there: 2 MiB, whatever the data.
BITS = 1 << 24
_WORD = 1 << 15


def may_hold(values: DataFrame):
    """A function of a long column: false only where the value is not among `values` (one column).

    It spares rows a shuffle before an exact join. The table has a fixed size, so with many more values than bits it lets
    more rows pass, never fewer.
    """
    spot = F.pmod(F.xxhash64(values.columns[0]), F.lit(BITS))
    marked = values.groupBy(F.floor(spot / _WORD).alias("word")).agg(F.bitmap_construct_agg(spot % _WORD).alias("bits"))
    table = np.zeros((BITS // _WORD, _WORD // 8), np.uint8)
    for row in marked.collect():
        table[row["word"]] = np.frombuffer(row["bits"], np.uint8)
    sent = values.sparkSession.sparkContext.broadcast(table.ravel())

    @F.arrow_udf("boolean")
    def held(spots: pa.Array) -> pa.Array:
        spot = spots.to_numpy(zero_copy_only=False)
        return pa.array((sent.value[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool))

    def test(column: Column) -> Column:
        return held(F.pmod(F.xxhash64(column), F.lit(BITS)))

    return test


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of batches sorted by integer `keys` without nulls, in tables that part no run of equal keys.

    No more is held than one batch and the run that it ends in.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        last = np.ones(len(table), dtype=bool)
        for k in keys:
            column = table.column(k).combine_chunks().to_numpy(zero_copy_only=False)
            last &= column == column[-1]
        cut = len(table) - int(np.argmin(last[::-1])) if not last.all() else 0
        if held and any(held[-1].column(k)[-1].as_py() != table.column(k)[0].as_py() for k in keys):
            yield pa.concat_tables(held)
            held = []
        if cut:
            yield pa.concat_tables([*held, table.slice(0, cut)])
            held = []
        held.append(table.slice(cut))
    if held:
        yield pa.concat_tables(held)


def starts_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new value of the keys begins."""
    new = np.zeros(len(sorted_keys[0]), dtype=bool)
    if len(new):
        new[0] = True
        for k in sorted_keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, one table after another, from batches sorted by integer `keys` without nulls.

    No more is held than the run at hand and one batch.
    """
    for table in whole_runs(batches, keys):
        at = starts_of(*[table.column(k).to_numpy() for k in keys])
        for a, b in zip(at, [*at[1:], len(table)], strict=True):
            yield table.slice(int(a), int(b - a))


def block_pairs(rows: DataFrame, *group: str) -> DataFrame:
    """Rows of each group dealt by `vertex` to `blocks` blocks and sent to every pair (i, j) of blocks, i <= j, that theirs is in.

    Sorted by group, i and j within partitions, so that `runs` gives the rows of a pair: a group of any size is compared
    with itself without ever being in one task.
    """
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")
    return rows.repartition(*group, "i", "j").sortWithinPartitions(*group, "i", "j")


def smallest_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n positions the smallest position that it reaches through the pairs (a, b)."""
    up = np.arange(n)
    while True:
        low = np.minimum(up[a], up[b])
        new = up.copy()
        for end in (a, b):
            np.minimum.at(new, end, low)
            np.minimum.at(new, up[end], low)
        new = new[new]
        if (new == up).all():
            return up
        up = new
