"""The usage chain as a whole, and maps that lack names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators.schema import typed_nulls
from revloom.plans import activity, usage_chain, usage_sync
from revloom.plans.daily_usage import run as daily_run
from revloom.queries.documents import contract_documents, usage_documents
from revloom.queries.registry import SQL, Tables, query
from revloom.queries.usage import AS_OF, DAILY, KINDS, MONTHS, activity_sources, daily_sources, sync_sources
from revloom.session import shared_folder


def chain(t: Tables) -> dict[str, DataFrame]:
    """Payloads of all jobs; the CRM knows the first period of each contract, with other values, and one that is gone."""
    o = t.orders
    product = o.select(F.col("o_orderpriority").alias("id")).distinct().select(
        "id", F.lower("id").alias("display.name"), F.array("id").alias("contractItemTypes"),
        F.array(F.struct(F.col("id"), F.array(F.lit(1)).alias("items"))).alias("packages"),
    )
    day = F.to_date("o_orderdate")
    known = o.where("o_orderpriority NOT IN ('5-LOW', '2-HIGH')").select(F.concat_ws("-", "o_orderkey", "o_custkey", day, F.add_months(day, 12)).alias("record_key"))
    known = known.union(t.spark.range(1).select(F.lit("gone")))
    rest = sync_sources(t)
    taken = ["reported", "snapshots", "captures", "schedulers", "instance_customers", "crm_daily", "accounts"]
    sources = {
        "daily_usage": daily_sources(t, as_map=False),
        "contracts": {"products": product, "contracts": contract_documents(t), "contract_usage": usage_documents(t)},
        "activity": activity_sources(t),
        "sync": {n: rest[n] for n in taken} | {"crm_usage": typed_nulls(known, {c: "string" for c in usage_sync.PERIOD_COLUMNS if c != "record_key"})},
    }
    return usage_chain.store(sources, AS_OF, shared_folder(t.spark), portal_product="P", instance_product="I")


@query("chain_usage", f"""
WITH newest AS (SELECT o_custkey::VARCHAR AS account_id, 'opp' || o_orderkey AS deal_id FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR * CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS DATE) DESC, 'opp' || o_orderkey DESC) = 1)
SELECT portal_id, environment, job_executions::DOUBLE AS job_executions, date, account_id, deal_id
FROM ({DAILY}) d LEFT JOIN newest n ON n.account_id = substring(portal_id, 2) WHERE date >= DATE '1996-06-01'""")
def chain_usage(t: Tables):
    """Daily usage of the portals, through all stored steps."""
    return chain(t)["daily_usage"].where("product = 'P'").select("portal_id", "environment", "job_executions", "date", "account_id", "deal_id")


@query("chain_period_changes", f"""
SELECT u.id AS record_key, CASE WHEN u.overage = 0 THEN 'update' ELSE 'insert' END AS action, u.usage, u."newCredit" + u."startCredit" AS allotted_usage, u."opportunityId" AS deal_id,
       u."customerId" AS customer_id, lower(c."productId") AS product, u.human_start AS period_start, c.human_end AS contract_end, c."DeploymentType" AS deployment_type
FROM ({SQL['usage_periods']}) u JOIN ({SQL['contracts']}) c ON c.id = u.contract_id
UNION ALL SELECT 'gone', 'delete', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""")
def chain_period_changes(t: Tables):
    """The change set of the CRM's usage periods, through all stored steps."""
    return chain(t)["period_changes"].select("record_key", "action", "usage", "allotted_usage", "deal_id", "customer_id", "product", "period_start", "contract_end", "deployment_type")


@query("activity_by_month_map", """
WITH g AS (SELECT o_custkey::VARCHAR AS portal_id, o_orderstatus AS envid, o_orderpriority AS activity, year(o_orderdate)::INTEGER AS y, list(month(o_orderdate)) AS ms FROM orders GROUP BY ALL),
m AS (SELECT DISTINCT month(o_orderdate)::INTEGER AS m FROM orders WHERE o_orderstatus <> 'P')
SELECT portal_id, envid, activity, 'jobs' AS type, make_date(y, m.m, 1) AS month,
       CASE WHEN envid <> 'P' AND list_contains(ms, m.m) THEN len(list_filter(ms, lambda e: e = m.m)) END::BIGINT AS count FROM g, m""")
def activity_by_month_map(t: Tables):
    """Maps that hold only months with a count, and none at all for partial orders."""
    sources = activity_sources(t)
    wide = sources["activity"]
    counts = F.create_map(*[x for n in MONTHS for x in (F.lit(n), F.col(f"`data.{n}`"))])
    held = F.when(F.col("envid") != "P", F.map_filter(counts, lambda _, v: v > 0))
    sources["activity"] = wide.withColumn("data", held).drop(*[f"data.{n}" for n in MONTHS])
    return activity.run(sources)["activity"]


@query("daily_usage_sparse", DAILY.replace("FROM x GROUP BY ALL", "FROM (SELECT *, count(v) OVER (PARTITION BY portal_id, environment) AS known FROM x) WHERE known > 0 GROUP BY ALL"))
def daily_usage_sparse(t: Tables):
    """Maps that hold only environments with runs, and none at all where there were none."""
    sources = daily_sources(t, as_map=False)
    held = F.map_filter(F.create_map(*[x for k in KINDS for x in (F.lit(k), F.col(k))]), lambda _, v: v.isNotNull())
    held = F.when(F.size(held) > 0, held)
    sources["consumption"] = sources["consumption"].withColumn("environments", held).drop(*KINDS)
    usage = daily_run(sources)["usage"]
    return usage.select("portal_id", "environment", "date", "job_executions", F.unix_seconds("human_start").alias("start_s"), F.unix_seconds("human_end").alias("end_s"))
