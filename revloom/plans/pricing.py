"""Gap between what an account pays and the list price of its usage tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import day
from revloom.functions.numbers import row_argmax, row_max, row_sum
from revloom.functions.text import hyperlink, record_link
from revloom.operators.changes import zero_out_stale
from revloom.operators.joins import floor_listed, left_lookup, present_in, with_presence
from revloom.operators.schema import assign_where, prettify, union_fill

# Fixed values.
EDITIONS = ["Standard", "Professional", "Enterprise"]
FLIP_CATEGORIES = ["Flips - Term License", "Flips - Maintenance"]
YEAR_DAYS, CALENDAR_DAYS, JOBS_PER_INSTANCE = 365.25, 365, 2
USAGE_FROM_DAYS, USAGE_TO_DAYS, USAGE_MIN = 100, 3, 10
LOW_TIER, LOW_TIER_PRICED_AS = 2, 3


def account_revenue(revenue: DataFrame, deals: DataFrame) -> DataFrame:
    """Recurring revenue per account and product. Summed per deal first, so a hot deal is small before it moves."""
    per_deal = revenue.groupBy("deal_id", "product").agg(F.sum("arr").alias("arr"))
    named = left_lookup(per_deal, deals, [("deal_id", "id")], {"account_id": "account_id"})
    return named.groupBy("account_id", "product").agg(F.sum("arr").alias("arr"))


def instance_jobs(captures: DataFrame, schedulers: DataFrame, customers: DataFrame) -> DataFrame:
    """Jobs a year and schedulers per account, from the average of jobs a day of each scheduler."""
    named = left_lookup(captures, schedulers, [("scheduler_id", "scheduler_id")], {"customer_id": "customer_id", "_known": "scheduler_id"})
    named = left_lookup(named, customers, [("customer_id", "customer_id")], {"account_id": "account_id"})
    return named.groupBy("account_id").agg(
        F.round(F.sum(F.col("per_day") * YEAR_DAYS)).alias("instance_jobs"),
        F.count_distinct("_known").alias("schedulers"),
    )


def portal_jobs(usage: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """Jobs a year per account and portal: daily sums over environments, their mean, times the days of a year."""
    start = F.col("human_start")
    recent = usage.where(
        (start >= F.date_sub(day(as_of), USAGE_FROM_DAYS)) & (start < F.date_sub(day(as_of), USAGE_TO_DAYS))
        & (F.col("job_executions") > USAGE_MIN)
    )
    per_day = recent.groupBy("portal_id", "human_start").agg(F.sum("job_executions").alias("jobs"))
    mean = per_day.groupBy("portal_id").agg(F.avg("jobs").alias("jobs"))
    named = left_lookup(mean, customers, [("portal_id", "portal_id")], {"account_id": "account_id"})
    # copies of a customer row repeat every day of its portal, which leaves the mean as it is
    return named.select("account_id", "portal_id", F.round(F.col("jobs") * CALENDAR_DAYS).alias("portal_jobs")).distinct()


def seed(sources: dict[str, DataFrame], as_of, instance_product: str, portal_product: str) -> DataFrame:
    """One row per account and product (and portal) that pays, with its yearly jobs."""
    arr = account_revenue(sources["revenue"], sources["deals"])
    arr = arr.where(F.col("product").isin(instance_product, portal_product) & (F.col("arr") > 0))
    inst = instance_jobs(sources["captures"], sources["schedulers"], sources["instance_customers"])
    port = portal_jobs(sources["usage"], sources["portal_customers"], as_of)
    # each product has jobs of one kind only, so one lookup serves both
    jobs = union_fill(inst.withColumn("product", F.lit(instance_product)), port.withColumn("product", F.lit(portal_product)))
    on = [("account_id", "account_id"), ("product", "product")]
    out = left_lookup(arr, jobs, on, {c: c for c in ("schedulers", "instance_jobs", "portal_jobs")})
    out = left_lookup(out, sources["accounts"], [("account_id", "id")], {"name": "name"})
    flips = sources["deals"].where(F.col("category").isin(FLIP_CATEGORIES) & (F.col("stage") == "Closed Won"))
    out = with_presence(out, flips, ("account_id", "account_id"), "flipped")
    out = out.withColumn("instance_jobs", F.col("instance_jobs") * JOBS_PER_INSTANCE)
    return out.withColumn("total_yearly_jobs", row_sum("instance_jobs", "portal_jobs"))


def tier_gaps(rows: DataFrame, tiers: DataFrame, portal_product: str) -> DataFrame:
    """Tier of the yearly jobs, list price per edition and the gap to it; the edition with the smallest shortfall.

    tiers: tier, up_to, base_<edition>, overage_<edition>, a declared list with a row per tier. The lookup is a floor: the
    greatest `up_to` not above the jobs, and what exceeds it is overage. Portal customers are never priced below their minimum tier.
    """
    found = floor_listed(rows, tiers, "total_yearly_jobs", "up_to", "tier", "_tier")
    low = (F.col("_tier.tier") < LOW_TIER) & (F.col("product") == portal_product)
    whole = F.struct(*[F.col(f) for f in ("up_to", "tier", *[c for c in tiers.columns if c not in ("up_to", "tier")])])
    priced_as = tiers.where(F.col("tier") == LOW_TIER_PRICED_AS).agg(F.min(whole)).scalar()
    found = found.withColumn("_tier", F.when(low, F.coalesce(priced_as, "_tier")).otherwise(F.col("_tier")))
    out = found.select("*", "_tier.*").drop("_tier")
    over = F.col("total_yearly_jobs") - F.col("up_to")
    out = out.withColumn("job_overage", F.when(over < 0, F.lit(0)).otherwise(over))
    for edition in (e.lower() for e in EDITIONS):
        out = out.withColumn(f"{edition}_overage_charge", F.col("job_overage") * F.col(f"overage_{edition}"))
        out = out.withColumn(f"{edition}_list", F.col(f"base_{edition}") + F.col(f"{edition}_overage_charge"))
        out = out.withColumn(f"{edition}_gap", F.col("arr") - F.col(f"{edition}_list"))
    gaps = [f"{e.lower()}_gap" for e in EDITIONS]
    return out.withColumns({"lowest_cost_gap": row_max(*gaps), "lowest_cost_edition": row_argmax(gaps, EDITIONS)})


def report(gaps: DataFrame, base_url: str, excluded: list[str]) -> DataFrame:
    """The table people read: linked names, readable headings, highest revenue first."""
    shown = gaps.where(~F.col("account_id").isin(excluded)) if excluded else gaps
    shown = shown.withColumn("name", hyperlink(record_link(base_url, "Account", "account_id"), "name"))
    hidden = ["instance_jobs", "portal_jobs", *[c for c in gaps.columns if c.startswith(("base_", "overage_")) or c.endswith("_overage_charge")]]
    ordered = shown.orderBy(F.col("arr").desc_nulls_last(), "account_id", "product").drop("account_id", *hidden)
    special = {"name": "Account Name", "tier": "Usage Tier", "total yearly jobs": "Total Yearly Jobs",
               "up to": "Annual Executions Limit", "job overage": "Estimated Overage"}
    return prettify(ordered, special)


def account_gaps(gaps: DataFrame, accounts: DataFrame) -> DataFrame:
    """Professional gap per account, summed over products; 0 for accounts that had a gap and have none now."""
    return zero_out_stale(
        accounts.select("id", "gap_to_list"), gaps.select(F.col("account_id").alias("id"), F.col("professional_gap").alias("gap_to_list")),
        "id", "gap_to_list",
    )


def run(
    sources: dict[str, DataFrame], as_of, *, instance_product: str, portal_product: str, base_url: str = "", excluded: list[str] = ()
) -> dict[str, DataFrame]:
    """Sources: revenue(deal_id, product, arr), deals(id, account_id, category, stage), accounts(id, name, gap_to_list),
    captures(scheduler_id, per_day), schedulers(scheduler_id, customer_id), instance_customers(customer_id, account_id),
    usage(portal_id, human_start, job_executions), portal_customers(portal_id, account_id), tiers. `before` has the
    accounts' gaps as they were."""
    gaps = tier_gaps(seed(sources, as_of, instance_product, portal_product), sources["tiers"], portal_product)
    update = account_gaps(gaps, sources["accounts"])
    return {
        "gaps": gaps,
        "report": report(gaps, base_url, list(excluded)),
        "account_update": update,
        "before": present_in(sources["accounts"].select("id", "gap_to_list"), update, ["id"], unique=True),
    }
