"""Contracts as tables: products, packages, contracts, periods, job tiers, usage periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import active_on, date_from_parts
from revloom.functions.keys import text_key
from revloom.operators.aggregates import first_distinct
from revloom.operators.schema import clean_names, drop_matching, flatten


def products(documents: DataFrame) -> dict[str, DataFrame]:
    """documents: one row per product with id, ..., contractItemTypes and packages lists."""
    packages = documents.select(F.col("id").alias("ProductId"), F.explode("packages").alias("p")).select("p.*", "ProductId")
    return {
        "products": clean_names(flatten(documents.drop("contractItemTypes", "packages"))),
        "product_packages": clean_names(packages.drop("items")),
    }


def contract_table(documents: DataFrame) -> DataFrame:
    """One row per contract: nested objects flattened, deployment type, first start and last end of its periods."""
    out = documents.withColumns({
        "provision_date": date_from_parts("provisionDate"),
        "DeploymentType": first_distinct("locationCounts", "deploymentType", "Unknown"),
        "human_start": F.array_min(F.transform("contractPeriods", lambda p: date_from_parts(p["startDate"]))),
        "human_end": F.array_max(F.transform("contractPeriods", lambda p: date_from_parts(p["endDate"]))),
    })
    flat = flatten(out.drop("locationCounts", "contractItems", "contractPeriods"))
    return clean_names(drop_matching(flat, r"opportunity\."))


def period_table(documents: DataFrame, as_of) -> DataFrame:
    """One row per contract period, with its dates and whether it is active on `as_of`."""
    rows = documents.select("opportunityId", F.col("usagePeriod").alias("usage_period"), F.explode("contractPeriods").alias("p"))
    out = rows.select(
        "p.*", "opportunityId", date_from_parts("p.startDate").alias("human_start"),
        date_from_parts("p.endDate").alias("human_end"), "usage_period",
    )
    out = out.withColumn("active_today", active_on("human_start", "human_end", as_of))
    return clean_names(flatten(out.drop("jobTiers")))


def job_tier_table(documents: DataFrame, last_only: bool = False) -> DataFrame:
    """One row per job tier of every period. `last_only` keeps the last period's tiers of each contract alone."""
    periods = F.slice("contractPeriods", -1, 1) if last_only else F.col("contractPeriods")
    if last_only:
        documents = documents.where(F.size("contractPeriods") > 0)
    rows = documents.select("opportunityId", F.explode(periods).alias("p"))
    rows = rows.select("opportunityId", F.col("p.id").alias("ContractPeriodId"), F.explode("p.jobTiers").alias("t"))
    return clean_names(rows.select("t.*", "ContractPeriodId", "opportunityId"))


def sorted_tiers(tiers: DataFrame) -> DataFrame:
    """By opportunity, start and period, missing values last."""
    return tiers.orderBy(*[F.col(k).asc_nulls_last() for k in ("opportunityId", "start", "ContractPeriodId")])


def usage_period_table(usage: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per usage period of a contract, with the contract's ids and a record key.

    usage: contract_id and the usagePeriods list; contracts without any give no rows.
    """
    contract = documents.select(
        F.col("id").alias("contract_id"), "opportunityId", "customerId", F.col("customer.portalId").alias("portal_id")
    )
    # a contract's list meets it whole: one row to shuffle
    rows = usage.where(F.size("usagePeriods") > 0).select("contract_id", "usagePeriods").join(contract, "contract_id")
    rows = rows.select(*contract.columns, F.explode("usagePeriods").alias("u"))
    out = rows.select(
        "u.*", "opportunityId", "contract_id", "customerId", "portal_id",
        date_from_parts("u.startDate").alias("human_start"), date_from_parts("u.endDate").alias("human_end"),
    )
    key = text_key("contract_id", "customerId", "human_start", "human_end", sep="-")
    return clean_names(flatten(out.withColumn("id", key)))


def run(sources: dict[str, DataFrame], as_of, last_only: bool = False) -> dict[str, DataFrame]:
    """Sources: products, contracts, contract_usage - JSON documents, see the functions above."""
    docs = sources["contracts"]
    return {
        **products(sources["products"]),
        "contracts": contract_table(docs),
        "contract_periods": period_table(docs, as_of),
        "contract_job_tiers": sorted_tiers(job_tier_table(docs, last_only)),
        "usage_periods": usage_period_table(sources["contract_usage"], docs),
    }
