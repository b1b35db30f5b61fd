"""Activity counts by month, and which requests came back empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import month_start
from revloom.operators import scan
from revloom.operators.joins import missing_combinations
from revloom.operators.reshape import unpivot_map, unpivot_prefix
from revloom.operators.schema import union_fill

#: Order of the monthly table. Rows of a series, the first three, lie together; the series are cut into that many ranges or more.
SORTED_BY, LEAST_RANGES = ["portal_id", "envid", "activity", "month", "type"], 200


def by_month(activity: DataFrame) -> DataFrame:
    """Month columns `data.Jan`... (or a `data` map) and a year to one row per month, empty months kept."""
    if "data" in activity.columns:
        long = unpivot_map(activity, "data", "month_name", "count")
    else:
        long = unpivot_prefix(activity, "data.", "month_name", "count")
    return long.withColumn("month", month_start("month_name", "year")).drop("month_name", "year")


def sorted_fact(long: DataFrame) -> DataFrame:
    """By portal, environment, activity and month, missing values last."""
    return long.orderBy(*[F.col(k).asc_nulls_last() for k in SORTED_BY])


def sorted_months(activity: DataFrame) -> DataFrame:
    """`by_month` in the order of `sorted_fact`. Rows are dealt by series before their months become rows: a twelfth of them is
    shuffled, no month is worked out to find the ranges, and inside a range months come nearly sorted."""
    series = [F.col(k).asc_nulls_last() for k in SORTED_BY[:3]]
    ranges = max(LEAST_RANGES, scan.default_ranges(activity))
    wide = activity.repartitionByRange(ranges, *series).sortWithinPartitions(*series, F.col("year").asc_nulls_last())
    return by_month(wide).sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in SORTED_BY])


def empty_requests(customers: DataFrame, activity_types: DataFrame, years: DataFrame, activity: DataFrame) -> DataFrame:
    """Every (customer, type, activity, year) of a portal type that was asked for and brought nothing.

    Only what is missing becomes rows. A NULL name is a name; customers of no type, or of one without a list, were asked nothing.
    """
    asked = customers.select("customerid", "type").distinct()
    lists = {"activity": activity_types.select("type", F.col("name").alias("activity")), "year": years.toDF("year")}
    got = activity.select("portal_id", "type", "activity", F.col("year").cast(years.schema[0].dataType).alias("year")).distinct()
    return missing_combinations(asked, ["customerid", "type"], got, [("customerid", "portal_id"), ("type", "type")], lists)


def run(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Sources: activity (portal_id, envid, activity, year, type, data), customers_<i>, activity_types_<i>, years."""
    customers = union_fill(*[df for n, df in sorted(sources.items()) if n.startswith("customers_")])
    types = union_fill(*[df for n, df in sorted(sources.items()) if n.startswith("activity_types_")])
    return {
        "activity": sorted_months(sources["activity"]),
        "activity_customers": customers,
        "empty_requests": empty_requests(customers, types, sources["years"], sources["activity"]),
    }
