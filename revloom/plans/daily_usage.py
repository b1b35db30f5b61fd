"""Daily usage per portal and environment, on the customer's own calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import from_millis, local_date
from revloom.functions.text import is_clean_id
from revloom.operators.joins import left_lookup, lookup_or_default, present_in
from revloom.operators.reshape import unpivot_except, unpivot_map
from revloom.operators.schema import drop_matching, union_distinct

TIMES = ["portal_id", "startMillis", "endMillis"]


def portal_ids(sources: dict[str, DataFrame]) -> DataFrame:
    """Usable ids of the three customer lists."""
    ids = union_distinct(
        sources["customers"].select("portal_id"),
        sources["activity_customers"].select(F.col("customer_id").alias("portal_id")),
        sources["clients"].select(F.col("customer_code").alias("portal_id")),
    )
    return ids.where(is_clean_id("portal_id"))


def zones(account_map: DataFrame, accounts: DataFrame, default: str = "UTC") -> DataFrame:
    """Time zone per portal id."""
    zone = left_lookup(account_map, accounts, [("account_id", "id")], {"zone": "timezone"})
    return zone.select("portal_id", F.coalesce("zone", F.lit(default)).alias("zone"))


def local_days(consumption: DataFrame, zone_of: DataFrame, default: str = "UTC") -> DataFrame:
    """Hourly wide usage to one row per portal, environment and local date.

    The zone is looked up while a row still holds all its environments, so the join moves the fewest rows; environments that are columns
    are summed by day as they stand and become rows after that. Of a map, a portal has the environments that any of its rows names.
    """
    timed = consumption.where("startMillis IS NOT NULL AND endMillis IS NOT NULL")
    timed = lookup_or_default(timed, zone_of, "portal_id", "zone", default)
    timed = timed.withColumn("_date", local_date(from_millis("startMillis"), "zone")).drop("jobExecutions")
    times = [F.min("startMillis").alias("_start"), F.max("endMillis").alias("_end")]
    if "environments" in timed.columns:
        long = unpivot_map(timed, "environments", "environment", "job_executions", per=["portal_id"])
        days = long.groupBy("portal_id", "environment", "_date").agg(F.sum("job_executions").alias("job_executions"), *times)
    else:
        wide = [c for c in timed.columns if c not in (*TIMES, "zone", "_date")]
        days = timed.groupBy("portal_id", "_date").agg(*times, *[F.sum(f"`{c}`").alias(c) for c in wide])
        days = unpivot_except(days, ["portal_id", "_date", "_start", "_end"], "environment", "job_executions")
    days = days.select("portal_id", "environment", F.col("_date").alias("date"), F.coalesce("job_executions", F.lit(0)).alias("job_executions"), "_start", "_end")
    return days.withColumns({"human_start": from_millis("_start"), "human_end": from_millis("_end")}).drop("_start", "_end")


def run(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Sources: consumption(portal_id, startMillis, endMillis, jobExecutions, environments map or one column per
    environment), customers(portal_id, ...), clients(customer_code), activity_customers(customer_id),
    account_map(portal_id, account_id), accounts(id, timezone), known_usage(portal_id)."""
    ids = portal_ids(sources)
    wanted = present_in(sources["consumption"], ids, ["portal_id"])
    usage = local_days(wanted, zones(sources["account_map"], sources["accounts"]))
    return {
        "usage": usage,
        "customers": drop_matching(sources["customers"], r"^(billingAddress|owner|shippingAddress)(\.|$)"),
        "all_portal_ids": union_distinct(ids, sources["known_usage"].select("portal_id")),
    }
