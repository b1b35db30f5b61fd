"""Won deals with their services deal, project, onboarding task and people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.operators.joins import absent_from, left_lookup, next_within, update_from
from revloom.operators.schema import assign_where, override_by_id, typed_nulls

# Fixed values.
SERVICES, NEW, EXISTING, FLIP, WON = "Professional Services", "New Business", "Existing Business", "SAP Flip", "Closed Won"
TASK_TYPE, TASK_ROLE, BUNDLE = "Onboarding", "%success%", "New Business w/PS Bundle"
LINK_MONTHS = 12
RELATED = {"related_name": "name", "related_stage": "stage", "related_type": "type", "related_amount": "services_bookings"}


def won_deals(sources: dict[str, DataFrame], since, excluded: list[str]) -> DataFrame:
    """Closed-won new business and flips after `since`, of accounts with an active product."""
    opp = sources["deals"]
    kind = F.col("type")
    wanted = (kind == NEW) | ((kind == EXISTING) & (F.col("expansion_category") == FLIP))
    opp = opp.where(wanted & (F.col("stage") == WON) & (F.to_date("close_date") > F.lit(str(since)).cast("date")))
    if excluded:
        opp = opp.where(~F.col("product").isin(excluded))
    owners = sources["users"].select(F.col("id").alias("owner_id"), F.col("name").alias("owner"))
    opp = opp.join(owners, "owner_id")
    opp = left_lookup(opp, sources["users"], [("team_lead_id", "id")], {"team_lead": "name"})
    idle = sources["accounts"].where(F.col("active_products").isNull())
    opp = absent_from(opp, idle.where(F.col("id").isNotNull()), [("account_id", "id")])
    out = opp.select(
        "account_id", "owner", "team_lead", "id", "name", "related_id", F.to_date("close_date").alias("close_date"),
        F.to_date("sao_date").alias("sao_date"), "software_bookings", "services_bookings", F.col("type").alias("opp_type"),
        "expansion_category", "product", "owner_manager", "services_requirements", "migration",
    )
    return typed_nulls(out, {
        "related_name": "string", "related_stage": "string", "related_type": "string", "related_amount": "double",
        "related_close_date": "date",
    })


def link_services(deals: DataFrame, every: DataFrame, manual: dict[str, str]) -> DataFrame:
    """The services deal of each won deal: the one it names, else one naming it, else a manual choice by deal name,
    else the account's next one within a year.

    A named deal that is no services deal is dropped before the last step; its close date stays, as that step
    does not set one. Several candidates: earliest close date, then smallest id.
    """
    order = [F.to_date("close_date").asc_nulls_last(), F.col("id")]
    services = every.where(F.col("type") == SERVICES)
    open_ = F.col("related_id").isNull()
    deals = update_from(deals, services, [("id", "related_id")], {"related_id": "id"}, order, only=open_)
    choice = {name: {"related_id": F.coalesce(F.col("related_id"), F.lit(v))} for name, v in manual.items()}
    deals = override_columns(deals, "name", choice)

    dated = every.withColumn("close_day", F.to_date("close_date"))
    deals = update_from(deals, dated, [("related_id", "id")], {**RELATED, "related_close_date": "close_day"})
    wrong = F.col("related_type") != SERVICES
    wrong_type = deals.withColumn("_wrong", F.coalesce(wrong, F.lit(False)))
    for c in ("related_id", "related_amount", "related_name", "related_stage", "related_type"):
        wrong_type = assign_where(wrong_type, c, F.col("_wrong"), F.lit(None))
    deals = wrong_type.drop("_wrong")

    deals = next_within(deals, services, "account_id", "close_date", "close_date", "id", LINK_MONTHS, "_next")
    deals = deals.withColumn("related_id", F.coalesce("related_id", "_next")).drop("_next")
    return update_from(deals, every, [("related_id", "id")], RELATED)


def override_columns(df: DataFrame, key: str, choice: dict[str, dict[str, Column]]) -> DataFrame:
    """`override_by_id` with values that are expressions of the row."""
    for name, values in choice.items():
        for column, value in values.items():
            df = assign_where(df, column, F.col(key) == name, value)
    return df


def onboarding_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks of the customer success people, with the day of their activity."""
    tasks = tasks.withColumn("activity_date", F.to_date("activity_date"))
    return tasks.where((F.col("type") == TASK_TYPE) & F.lower("role").like(TASK_ROLE))


#: Columns taken from a deal's project and its onboarding task: {column: column of the object}.
PROJECT = {
    "project_name": "name", "project_status": "status", "project_created": "created", "project_type": "type", "project_stage": "stage",
    "project_start": "start", "project_owner_id": "owner_id", "engagement_manager": "manager_id",
}
TASK = {
    "task_id": "id", "task_status": "status", "task_subject": "subject", "task_activity_date": "activity_date", "task_owner_id": "owner_id",
    "task_product": "product",
}


def projects(sources: dict[str, DataFrame]) -> DataFrame:
    return sources["projects"].withColumns({"created": F.to_date("created"), "start": F.to_date("start")})


def with_project_and_task(deals: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Deals with one project, one onboarding task and their owners' names; the smallest id where there are several."""
    dates = ("project_created", "project_start", "task_activity_date")
    blank = {c: "date" if c in dates else "string" for c in (*PROJECT, "project_owner", *TASK, "task_owner")}
    out = typed_nulls(deals, blank)
    out = update_from(out, projects(sources), [("related_id", "deal_id")], PROJECT, [F.col("id")])
    out = update_from(out, onboarding_tasks(sources["tasks"]), [("id", "deal_id")], TASK, [F.col("id")])
    users = sources["users"]
    out = update_from(out, users, [("project_owner_id", "id")], {"project_owner": "name"})
    return update_from(out, users, [("task_owner_id", "id")], {"task_owner": "name"})


def report(deals: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """One row per deal, onboarding task and project."""
    kind = (
        F.when(F.col("opp_type") == EXISTING, FLIP)
        .when((F.col("opp_type") == NEW) & (F.col("services_bookings") > 0), BUNDLE)
        .otherwise(NEW)
    )
    out = deals.withColumn("opp_type", kind)
    out = left_lookup(out, onboarding_tasks(sources["tasks"]), [("id", "deal_id")], TASK)
    out = left_lookup(out, projects(sources), [("related_id", "deal_id")], PROJECT)
    out = left_lookup(out, sources["users"], [("task_owner_id", "id")], {"task_owner": "name"})
    out = left_lookup(out, sources["users"], [("project_owner_id", "id")], {"project_owner": "name"})
    out = typed_nulls(out, {"engagement_manager_name": "string", "in_production": "string"})
    out = update_from(out, sources["contacts"], [("engagement_manager", "id")], {"engagement_manager_name": "name"})
    return update_from(out, sources["accounts"], [("account_id", "id")], {"in_production": "in_production"})


def run(
    sources: dict[str, DataFrame], since, *, excluded: list[str] = (), manual: dict[str, str] | None = None,
    overrides: dict[str, dict[str, object]] | None = None,
) -> dict[str, DataFrame]:
    """Sources: deals, users, accounts, projects, tasks, contacts; see the columns used above. Services requirements are the
    migration question of a deal, `migration` its flag."""
    deals = link_services(won_deals(sources, since, list(excluded)), sources["deals"], manual or {})
    deals = override_by_id(deals, "id", overrides or {})
    return {"deals": with_project_and_task(deals, sources), "onboarding": report(deals, sources)}
