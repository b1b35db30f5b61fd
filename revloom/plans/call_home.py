"""Newest contact of each account's servers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import months_before
from revloom.functions.text import is_record_id, uuid_in
from revloom.operators.joins import absent_from, left_lookup, present_in
from revloom.operators.windows import latest_per_key


def calls(statistics: DataFrame, details: DataFrame, as_of, product_type: str, months: int = 12) -> DataFrame:
    """Distinct (customer, time, version) of released versions within a year, with the serial inside the customer id."""
    recent = statistics.where(F.to_date("creationDate") >= months_before(as_of, months))
    wanted = details.where((F.col("productType") == product_type) & ~F.lower("version").like("%beta%"))
    joined = recent.select("id", "creationDate").join(
        wanted.select(F.col("product_statistics_id").alias("id"), "customerId", "version"), "id"
    )
    seen = joined.select("customerId", F.col("creationDate").alias("last_call_home"), F.col("version").alias("latest_version")).distinct()
    return seen.withColumn("serial", uuid_in("customerId"))


def last_calls(seen: DataFrame, assets: DataFrame) -> DataFrame:
    """Newest call per account, known by the asset's serial or, failing that, by a customer id that is a record id."""
    out = left_lookup(seen, assets, [("serial", "serial")], {"_asset": "account_id"})
    account = F.coalesce("_asset", F.when(is_record_id("customerId"), F.col("customerId")))
    known = out.withColumn("account_id", account).drop("_asset").where("account_id IS NOT NULL")
    return latest_per_key(known, ["account_id"], "last_call_home", "customerId", "latest_version")


def run(sources: dict[str, DataFrame], as_of, product_type: str) -> dict[str, DataFrame]:
    """Sources: statistics(id, creationDate), details(product_statistics_id, customerId, productType, version),
    assets(account_id, serial), accounts(id, last_call_home, latest_version). `before` has the accounts as they were."""
    last = last_calls(calls(sources["statistics"], sources["details"], as_of, product_type), sources["assets"])
    update = last.select(F.col("account_id").alias("id"), "last_call_home", "latest_version")
    kept = [c for c in update.columns if c in sources["accounts"].columns]
    return {
        "last_calls": last,
        "unknown_accounts": absent_from(last, sources["accounts"], [("account_id", "id")]),
        "account_update": update,
        "before": present_in(sources["accounts"].select(*kept), update, ["id"], unique=True),
    }
