"""Running sums and predecessors over one global order, in ranges that hold about equally many rows.

The order is cut where the rows are, not where the calendar is: a sample of the keys, drawn by their hash so that every use sees the
same one, gives the borders. Rows move once, to their range. What a range needs from those before it, a last row or a partial sum, is
aggregated before the shuffle and becomes a row ahead of the range's own. So a series of any size, in one minute or in many years,
is worked on by as many tasks as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges per shuffle partition, and sampled keys per range. Both only decide how even the ranges are.
RANGES_PER_PARTITION, SAMPLED_PER_RANGE = 2, 24
#: The values of the sampling hash.
_SPAN = 1 << 52


def default_ranges(df: DataFrame) -> int:
    return RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sampled(df: DataFrame, key: Column, most: int) -> DataFrame:
    """About `most` rows of df, those whose `key` has a small hash: the same ones wherever they are asked for."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    return df.where(F.pmod(F.xxhash64(key), F.lit(_SPAN)) < F.lit(float(most) * _SPAN) / F.greatest(rows, F.lit(1)))


def cuts(df: DataFrame, key: Column, ranges: int) -> Column:
    """A sorted array of at most ranges - 1 keys that part the rows of df evenly, for use in any plan.

    About ranges * SAMPLED_PER_RANGE distinct keys are looked at. It is computed with the query, not before it.
    """
    drawn = sampled(df.select(key.alias("k")), F.col("k"), ranges * SAMPLED_PER_RANGE)
    sample = drawn.agg(F.array_sort(F.collect_set("k")).alias("s"))
    size = F.size("s")
    borders = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("s", F.floor(i * size / ranges).cast("int")))
    return sample.select(F.when((size > 0) & F.lit(ranges > 1), F.array_distinct(borders)).otherwise(F.slice("s", 1, 0))).scalar()


def position(sorted_array: str, key: Column, most: int, field: str | None = None) -> Column:
    """How many elements (or their `field`) of a column's sorted array of at most `most` elements are <= key: a binary search."""
    steps = [1 << b for b in reversed(range(max(1, most).bit_length()))]

    def further(p: Column, s: Column) -> Column:
        one = F.get(F.col(sorted_array), p + s - 1)
        return F.when((one if field is None else one[field]) <= key, p + s).otherwise(p)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def ranged(df: DataFrame, key: list[str], ranges: int | None = None) -> DataFrame:
    """df with `_range`, the number of the range of the global order by `key` (nulls first) that a row is in."""
    ranges = ranges or default_ranges(df)
    whole = F.struct(*[F.col(f"`{k}`") for k in key])
    return placed(df, cuts(df, whole, ranges), whole, ranges)


def placed(df: DataFrame, borders: Column, key: Column, ranges: int) -> DataFrame:
    """df with `_range`, the number of `borders` that are <= key."""
    # a column of its own first: a function over arrays takes no subquery
    return df.withColumn("_borders", borders).withColumn("_range", position("_borders", key, ranges)).drop("_borders")


def running_sum(df: DataFrame, series: list[str], order: list[str], value: str, alias: str, ranges: int | None = None) -> DataFrame:
    """df with `alias`: the sum of `value` over the rows of the series up to and with this one.

    `order` must be total within a series. NULL values add nothing; the sum is NULL until the first other one. A NULL in the series
    is a series. Floating-point sums are added range by range.
    """
    rows = ranged(df, [*series, *order], ranges)
    sums = rows.groupBy("_range", *series).agg(F.sum(value).alias("_add"))
    before = Window.partitionBy(*series).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # only series that straddle a border have a row here
    carried = sums.withColumn("_add", F.sum("_add").over(before)).where("_add IS NOT NULL").withColumn("_own", F.lit(0))
    stacked = rows.withColumns({"_add": F.col(f"`{value}`"), "_own": F.lit(1)}).unionByName(carried, allowMissingColumns=True)
    inside = Window.partitionBy("_range", *series).orderBy("_own", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stacked.withColumn(alias, F.sum("_add").over(inside)).where("_own = 1").drop("_own", "_add", "_range")


def numbered(df: DataFrame, order: list[str], alias: str, ranges: int | None = None) -> DataFrame:
    """df with `alias`: the number of a row, from 1, in the order of the columns `order`, which must be total."""
    return running_sum(df.withColumn("_one", F.lit(1)), [], order, "_one", alias, ranges).drop("_one")


def with_previous(df: DataFrame, series: list[str], order: list[str], columns: list[str], ranges: int | None = None) -> DataFrame:
    """df with `_lag_<c>` for each of the columns: its value in the row before, of the same series. `order` must be total."""
    rows = ranged(df, [*series, *order], ranges).withColumn("_own", F.lit(1))
    taken = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([*series, *columns])])
    ends = rows.groupBy("_range").agg(F.max_by(taken, F.struct(*[F.col(f"`{c}`") for c in (*series, *order)])).alias("_end"))
    # one row per range; the last row before a range matters to the series it belongs to
    following = F.lead("_range").over(Window.partitionBy(F.lit(0)).orderBy("_range"))
    carried = ends.withColumn("_next", following).where("_next IS NOT NULL").select("_end.*", F.col("_next").alias("_range"), F.lit(0).alias("_own"))
    inside = Window.partitionBy("_range", *series).orderBy("_own", *order)
    stacked = rows.unionByName(carried, allowMissingColumns=True)
    return stacked.withColumns({f"_lag_{c}": F.lag(c).over(inside) for c in columns}).where("_own = 1").drop("_own", "_range")
