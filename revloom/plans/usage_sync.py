"""Usage pushed to the CRM: id map, usage periods, daily usage, month-over-month change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import month_floor_years_before, months_before
from revloom.functions.keys import count_text, text_key
from revloom.functions.text import strip_prefix
from revloom.operators.changes import change_set, failed_rows, new_only, null_out_stale
from revloom.operators.joins import absent_from, id_account_map, left_lookup
from revloom.operators.schema import rename, union_fill
from revloom.operators.windows import latest_per_key, usage_change
from revloom.sources import keyed
from revloom.sources.writers import stored

# Fixed values.
YEARS_KEPT = 3
UNMAPPED_MARK, SCHEDULER_MARK = "NA - ", "JssId - "
PERIOD_COLUMNS = [
    "deal_id", "portal_id", "overage", "usage", "expected_end_credit", "expected_end_usage", "contract_id", "customer_id",
    "period_start", "period_end", "expected_overage", "expected_overage_amount", "usage_period", "contract_start",
    "contract_end", "overage_amount", "record_key", "type", "allotted_usage", "deployment_type", "product",
]


def usage_periods(periods: DataFrame, contracts: DataFrame, products: DataFrame) -> DataFrame:
    """Usage periods with their contract and product, in the columns of the CRM object."""
    out = rename(periods, {
        "id": "record_key", "expectedEndCredit": "expected_end_credit", "expectedEndUsage": "expected_end_usage",
        "expectedOverage": "expected_overage", "expectedOverageAmount": "expected_overage_amount",
        "overageAmount": "overage_amount", "human_start": "period_start", "human_end": "period_end",
    })
    out = out.withColumns({"allotted_usage": F.col("newCredit") + F.col("startCredit"), "type": F.lit(None).cast("string")})
    out = left_lookup(out, contracts, [("contract_id", "id")], {
        "deal_id": "opportunityId", "customer_id": "customer_id", "usage_period": "usagePeriod", "contract_start": "human_start",
        "contract_end": "human_end", "deployment_type": "DeploymentType", "_product": "productId",
    })
    return left_lookup(out, products, [("_product", "id")], {"product": "displayName"}).select(*PERIOD_COLUMNS)


def portal_usage(usage: DataFrame, id_map: DataFrame, contracts: DataFrame, as_of, product: str) -> DataFrame:
    """Three years of daily portal usage with account and the deal of the account's newest contract."""
    recent = usage.where(F.col("date") >= month_floor_years_before(as_of, YEARS_KEPT))
    newest = latest_per_key(
        contracts.where(F.col("account_id").isNotNull()).select("account_id", "opportunityId", "human_end"),
        ["account_id"], "human_end", "opportunityId",
    )
    # accounts get their deal before the usage meets them, so that the usage is shuffled once
    deals = left_lookup(id_map.select("portal_id", "account_id"), newest, [("account_id", "account_id")], {"deal_id": "opportunityId"})
    out = left_lookup(recent, deals, [("portal_id", "portal_id")], {"account_id": "account_id", "deal_id": "deal_id"})
    return out.select(
        "portal_id", "environment", F.col("job_executions").cast("double").alias("job_executions"), "date",
        F.lit(product).alias("product"), "account_id", "deal_id",
    )


def instance_usage(snapshots: DataFrame, captures: DataFrame, schedulers: DataFrame, customers: DataFrame, as_of, product: str) -> DataFrame:
    """Three years of daily runs per scheduler from instance snapshots, finished in whichever way.

    Snapshots meet the other tables as they are and are summed by the scheduler's id, which they then lie by already; the texts are made
    of the sums. As in SQL, a group in which one of the three counters has no value at all has no total.
    """
    recent = snapshots.where(F.col("start") >= months_before(as_of, 12 * YEARS_KEPT))
    counters = ["succeeded", "failed", "aborted"]
    day = recent.select("capture_id", F.to_date("start").alias("date"), *counters)
    rows = day.join(captures.select("capture_id", "scheduler_id"), "capture_id")
    rows = rows.join(schedulers.select("scheduler_id", "customer_id"), "scheduler_id")
    rows = rows.join(customers.select("customer_id", "customer_name", "account_id"), "customer_id")
    summed = rows.groupBy("customer_name", "scheduler_id", "date", "account_id").agg(*[F.sum(c).alias(c) for c in counters])
    total = F.col("succeeded") + F.col("failed") + F.col("aborted")
    return summed.select(
        F.concat(F.lit(UNMAPPED_MARK), F.col("customer_name")).alias("portal_id"),
        F.concat(F.lit(SCHEDULER_MARK), F.col("scheduler_id").cast("string")).alias("environment"),
        total.cast("double").alias("job_executions"), "date",
        F.lit(product).alias("product"), "account_id", F.lit(None).cast("string").alias("deal_id"),
    )


def record_key(usage: DataFrame) -> DataFrame:
    """Daily usage with the text key the CRM rows are matched by; the count is always printed in full."""
    parts = ["portal_id", "environment", "date", count_text("job_executions"), "product"]
    return usage.withColumn("record_key", text_key(*parts))


def daily_changes(usage: DataFrame, loaded: DataFrame) -> dict[str, DataFrame]:
    """Daily rows to add and loaded rows to delete. A changed count is a new key, so there are no updates.

    Usage has a row per portal, environment and day, so its keys have few copies to drop before they meet the loaded ones.
    """
    keyed = record_key(usage)
    return {
        "daily_insert": new_only(keyed, loaded, ["record_key"], once=True),
        "daily_delete": absent_from(loaded, keyed.select("record_key"), ["record_key"], unique=True),
    }


def account_update(usage: DataFrame, accounts: DataFrame, buffer: int = 1) -> DataFrame:
    """Usage change per account, and emptied values for accounts that had usage and report none now."""
    change = usage_change(usage, "account_id", "date", "job_executions", buffer=buffer)
    upload = change.select(
        F.col("account_id").alias("id"), F.col("upload_change").alias("usage_change"),
        F.col("recent_usage").alias("usage_last_30"), F.col("last_submission").alias("last_usage_date"),
    )
    return null_out_stale(accounts, upload, "id", "usage_last_30", ["usage_change", "usage_last_30"])


def rejected_accounts(results: DataFrame, usage: DataFrame) -> DataFrame:
    """Accounts the CRM refused, with the portal ids and products they came from, by product."""
    failed = failed_rows(results, usage, ("id", "account_id"), "error", ["portal_id", "product"])
    named = failed.withColumn("portal_id", strip_prefix("portal_id", UNMAPPED_MARK))
    return named.orderBy(F.col("product").asc_nulls_last(), "id", "portal_id")


def id_map(sources: dict[str, DataFrame], bad_ids=(), bad_accounts=()) -> DataFrame:
    """Portal id to account, from the portal's own list, the contract customers and what was reported before."""
    mapped = id_account_map(
        sources["activity_customers"], sources["customers"], sources["reported"], bad_ids=list(bad_ids), bad_accounts=list(bad_accounts)
    )
    return mapped.select(F.col("id").alias("portal_id"), F.col("account").alias("account_id"))


def daily_usage(sources: dict[str, DataFrame], mapped: DataFrame, as_of, portal_product: str, instance_product: str) -> DataFrame:
    """Daily usage of both products."""
    return union_fill(
        portal_usage(sources["usage"], mapped, sources["contracts"], as_of, portal_product),
        instance_usage(
            sources["snapshots"], sources["captures"], sources["schedulers"], sources["instance_customers"], as_of, instance_product
        ),
    )


def period_changes(sources: dict[str, DataFrame]) -> DataFrame:
    """Change set of the CRM's usage periods."""
    periods = usage_periods(sources["usage_periods"], sources["contracts"], sources["products"])
    return change_set(sources["crm_usage"], periods, "record_key")


def run(
    sources: dict[str, DataFrame], as_of, *, portal_product: str, instance_product: str, bad_ids=(), bad_accounts=()
) -> dict[str, DataFrame]:
    """Sources: activity_customers / customers / reported (id, account), usage_periods, contracts, products, usage,
    snapshots, captures, schedulers, instance_customers, crm_usage(record_key, ...), crm_daily(id, record_key),
    accounts(id, usage_change, usage_last_30, last_usage_date). Three outputs are made from `daily_usage`: `store` writes it once."""
    mapped = id_map(sources, bad_ids, bad_accounts)
    usage = daily_usage(sources, mapped, as_of, portal_product, instance_product)
    return {
        "id_map": mapped,
        "period_changes": period_changes(sources),
        "daily_usage": usage,
        "account_update": account_update(usage, sources["accounts"]),
        **daily_changes(usage, sources["crm_daily"]),
    }


def store(
    sources: dict[str, DataFrame], as_of, folder: str, *, portal_product: str, instance_product: str, bad_ids=(), bad_accounts=()
) -> dict[str, DataFrame]:
    """`run` with its outputs written below `folder` and read back: the id map, then daily usage once, then what is made
    from them."""
    mapped = stored({"id_map": id_map(sources, bad_ids, bad_accounts)}, folder)
    first = {
        "daily_usage": daily_usage(sources, mapped["id_map"], as_of, portal_product, instance_product), "period_changes": period_changes(sources),
    }
    first = stored(first, folder)
    usage = first["daily_usage"]
    later = {"account_update": account_update(usage, sources["accounts"]), **daily_changes(usage, sources["crm_daily"])}
    return {**mapped, **first, **stored(later, folder)}


def apply_periods(sources: dict[str, DataFrame], crm_usage: str) -> list[int]:
    """Brings the stored copy of the CRM's usage periods (`keyed.write` by record_key) to the state of the sources.

    Only the partitions of it that change are read for the update and written; returns their numbers.
    """
    spark = sources["usage_periods"].sparkSession
    before = keyed.read(spark, crm_usage).drop(keyed.PART)
    return keyed.apply(period_changes({**sources, "crm_usage": before}), crm_usage, "record_key")
