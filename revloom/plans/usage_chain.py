"""The usage chain, from landed payloads to what the CRM is sent: each job works on what the one before has stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators.schema import rename, typed_nulls
from revloom.plans import activity, contracts, daily_usage, usage_sync
from revloom.sources.writers import stored

#: What a usage period need not have.
PERIOD_EXTRAS = dict.fromkeys(["expectedEndCredit", "expectedEndUsage", "expectedOverage", "expectedOverageAmount", "overageAmount", "startCredit", "newCredit", "overage"], "int")


def _filled(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    missing = {c: kind for c, kind in kinds.items() if c not in df.columns}
    return typed_nulls(df, missing) if missing else df


def sync_sources(daily: dict[str, DataFrame], documents: dict[str, DataFrame], portals: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What the sync takes from the outputs of daily usage, contracts and activity.

    Portals' accounts are those of the contracts' customers and, where the activity customers name one, theirs.
    """
    contract = rename(_filled(documents["contracts"], {"customer_accountId": "string", "customer_portalId": "string"}), {"customerId": "customer_id", "customer_accountId": "account_id"})
    contract = contract.withColumn("account_id", F.col("account_id").cast("string"))
    customers = _filled(portals["activity_customers"], {"account_id": "string"})
    return {
        "usage": daily["usage"].select("portal_id", "environment", "date", "job_executions"),
        "contracts": contract,
        "products": rename(documents["products"], {"display_name": "displayName"}),
        "usage_periods": _filled(documents["usage_periods"], PERIOD_EXTRAS),
        "customers": contract.where("customer_portalId IS NOT NULL").select(F.col("customer_portalId").alias("id"), F.col("account_id").alias("account")).distinct(),
        "activity_customers": customers.select(F.col("customerid").alias("id"), F.col("account_id").alias("account")).distinct(),
    }


def store(
    sources: dict[str, dict[str, DataFrame]], as_of, folder: str, *, portal_product: str, instance_product: str, bad_ids=(), bad_accounts=()
) -> dict[str, DataFrame]:
    """Daily usage, contracts, activity and then the usage sync, every output written below `folder` and read back.

    Sources by job: `daily_usage`, `contracts` and `activity` as their `run` takes them; `sync` with what else the usage sync
    takes (reported, snapshots, captures, schedulers, instance_customers, crm_usage, crm_daily, accounts).
    """
    jobs = {
        "daily_usage": daily_usage.run(sources["daily_usage"]), "contracts": contracts.run(sources["contracts"], as_of), "activity": activity.run(sources["activity"]),
    }
    back = stored({f"{job}/{name}": df for job, tables in jobs.items() for name, df in tables.items()}, folder)
    daily, documents, portals = ({name: back[f"{job}/{name}"] for name in tables} for job, tables in jobs.items())
    sync = usage_sync.store(
        {**sources["sync"], **sync_sources(daily, documents, portals)}, as_of, f"{folder}/sync",
        portal_product=portal_product, instance_product=instance_product, bad_ids=bad_ids, bad_accounts=bad_accounts,
    )
    return {**daily, **documents, **portals, **sync}
