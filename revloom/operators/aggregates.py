"""Aggregations that stay whole when one group holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.functions.keys import same
from revloom.functions.text import as_col
from revloom.operators import scan


def sum_per(df: DataFrame, keys: list[str], value: str, alias: str | None = None) -> DataFrame:
    """Sum by key with NULLs skipped, 0 for a group of NULLs only. A NULL key is a group."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0)).alias(alias or value))


def mean_of_sums(df: DataFrame, outer: list[str], inner: list[str], value: str, alias: str) -> DataFrame:
    """Sum per (outer, inner), then the mean of those sums per outer key."""
    sums = df.groupBy(*outer, *inner).agg(F.sum(value).alias("_sum"))
    return sums.groupBy(*outer).agg(F.avg("_sum").alias(alias))


def first_distinct(array, item_field: str, default: str) -> Column:
    """Field of the first element of a nested list; `default` for a missing or empty list or field."""
    return F.coalesce(F.try_element_at(as_col(array)[item_field], F.lit(1)), F.lit(default))


def joined_text(
    df: DataFrame, keys: list[str], value: str, alias: str, *, unique: bool = False, sep: str = ",", chunk_bytes: int = 1 << 16
) -> DataFrame:
    """Values of each group as sorted texts, NULLs skipped, plus `count` of all rows of the group; one row per `part` of the text.

    Put one after another by `part`, with `sep` between, the texts are the whole one that string_agg gives. A value begins at its
    byte in the whole text, separators included, and is in part (that byte) / chunk_bytes: a text has at most about chunk_bytes
    bytes and one value, and numbers leave gaps behind values longer than that. Bytes are summed over ranges of the sorted values, equal
    values counted first, so no task holds a group. A group without values has one row with NULL text.
    """
    counted = df.withColumn(value, F.col(value).cast("string")).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    held = counted.where(F.col(value).isNotNull()).withColumn("_copies", F.lit(1).cast("long") if unique else F.col("_n"))
    held = held.withColumn("_wide", (F.octet_length(value) + len(sep.encode())).cast("long")).withColumn("_bytes", F.col("_copies") * F.col("_wide"))
    held = scan.running_sum(held, keys, [value], "_bytes", "_end").withColumn("_start", F.col("_end") - F.col("_bytes"))

    size = F.lit(chunk_bytes).cast("long")

    def up_to(part: Column) -> Column:
        """Copies that begin before a part."""
        return F.least(F.col("_copies"), F.greatest(F.lit(0).cast("long"), F.floor((part * size - F.col("_start") + F.col("_wide") - 1) / F.col("_wide"))))

    last = F.expr(f"(_start + (_copies - 1) * _wide) div {chunk_bytes}")
    spread = held.withColumn("part", F.explode(F.sequence(F.expr(f"_start div {chunk_bytes}"), last)))
    spread = spread.withColumn("_here", up_to(F.col("part") + 1) - up_to(F.col("part"))).where("_here > 0")
    listed = F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_here").cast("int").alias("n"))))
    text = F.array_join(F.flatten(F.transform(listed, lambda x: F.array_repeat(x["v"], x["n"]))), sep)
    texts = spread.groupBy(*keys, "part").agg(text.alias(alias))
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("count"), F.count(value).alias("_values"))
    l, t = texts.alias("l"), totals.alias("t")
    on = same([F.col(f"l.`{k}`") for k in keys], [F.col(f"t.`{k}`") for k in keys])
    empty = totals.where("_values = 0").select(*keys, F.lit(0).cast("long").alias("part"), F.lit(None).cast("string").alias(alias), "count")
    return l.join(t, on, "inner").select("l.*", "t.count").unionByName(empty)


def pivot_sum(df: DataFrame, keys: list[str], by: str, values: list, value: str) -> DataFrame:
    """Long to wide: one summed column per listed value."""
    return df.groupBy(*keys).pivot(by, values).agg(F.sum(value))

