"""Revenue jobs: reconciliation, list-price gaps, forecasts, snapshots, onboarding, tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revloom.operators.changes import watermark
from revloom.operators.schema import union_fill
from revloom.operators.aggregates import joined_text
from revloom.operators.joins import left_lookup
from revloom.plans import forecast, onboarding, pricing, reconcile, snapshots, tag_sync
from revloom.queries.registry import Tables, query
from revloom.sources.readers import query as sql_query


# Invoices are orders, order rows are their lines: amounts in the currency of the customer's nation.
def recon_sources(t: Tables) -> dict[str, DataFrame]:
    o, c, l = t.orders, t.customer, t.lineitem
    day = F.to_date("o_orderdate")
    named = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "Royalty").when(F.col("o_orderpriority") == "5-LOW", None).otherwise("Annual")
    status = F.when(F.col("o_orderstatus") == "F", "Sent").when(F.col("o_orderstatus") == "O", "Draft")
    invoices = named.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("deal_id"), kind.alias("type"), status.alias("invoice_status"),
        day.alias("billing_start"), F.col("o_totalprice").alias("amount"), F.col("c_nationkey").alias("currency"), (F.col("c_nationkey") == 9).alias("test"),
    )
    per_line = l.groupBy("l_orderkey", "l_linestatus").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
    lines = per_line.join(named, F.col("l_orderkey") == F.col("o_orderkey"))
    orders = lines.select(
        F.concat_ws("-", F.col("o_orderkey").cast("string"), "l_linestatus").alias("id"), F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("deal_id"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.concat(F.lit("prod"), (F.col("o_orderkey") % 3).cast("string"))).alias("product"), kind.alias("type"),
        F.when(F.col("l_linestatus") == "F", "Sent").alias("invoice_status"), day.alias("effective_date"), F.col("amount").cast("double").alias("amount"),
        F.col("c_nationkey").alias("currency"), F.col("o_orderkey").alias("invoice_id"), (F.col("c_nationkey") == 9).alias("test"),
    )
    return {
        "invoices": invoices, "orders": orders,
        "accounts": c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") != 4, F.col("c_nationkey").cast("string")).alias("region"), F.col("c_mktsegment").alias("segment")),
        "deals": o.select(
            F.col("o_orderkey").alias("id"), F.concat(F.lit("deal "), F.col("o_orderkey").cast("string")).alias("name"),
            F.when(F.col("o_orderpriority") != "2-HIGH", F.concat(F.lit("prod"), (F.col("o_orderkey") % 3).cast("string"))).alias("product"),
        ),
        "rates": t.nation.where("n_name <> 'NATION_7'").select(F.col("n_nationkey").alias("iso_code"), (1 + F.col("n_nationkey") / 4.0).alias("rate")),
    }


RECON = """
WITH base AS (SELECT o.*, c.*, CAST(o_orderdate AS DATE) AS d, CASE WHEN c_nationkey <> 7 THEN 1 + c_nationkey / 4.0 END AS rate,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 'Default' ELSE 'prod' || (o_orderkey % 3) END AS product,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'SAP - Royalty' ELSE 'Contracted' END AS rpt_group,
  CASE WHEN c_nationkey <> 4 THEN c_nationkey::VARCHAR END AS region FROM orders o JOIN customer c ON o_custkey = c_custkey
  WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND c_nationkey <> 9),
ord AS (SELECT b.*, l_linestatus, round(s / rate) AS v FROM base b JOIN (SELECT l_orderkey, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS s FROM lineitem GROUP BY 1, 2) ON l_orderkey = o_orderkey),
inv AS (SELECT *, round(o_totalprice / rate) AS v FROM base WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
a AS (SELECT d, product, rpt_group, region, c_mktsegment AS segment, o_custkey AS account_id, sum(CASE WHEN l_linestatus = 'F' THEN coalesce(v, 0) ELSE 0 END) AS order_won,
  sum(CASE WHEN l_linestatus = 'F' THEN 0 ELSE coalesce(v, 0) END) AS order_forecast, count(*) AS order_n FROM ord GROUP BY ALL),
b AS (SELECT d, product, rpt_group, region, c_mktsegment AS segment, o_custkey AS account_id, sum(CASE WHEN o_orderstatus = 'F' THEN coalesce(v, 0) ELSE 0 END) AS invoice_won,
  sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE coalesce(v, 0) END) AS invoice_forecast, count(*) AS invoice_n FROM inv GROUP BY ALL)"""


@query("recon_master_check", RECON + """
SELECT coalesce(a.d, b.d) AS quarter, coalesce(a.product, b.product) AS product, coalesce(a.rpt_group, b.rpt_group) AS rpt_group, coalesce(a.region, b.region) AS region,
       coalesce(a.segment, b.segment) AS segment, coalesce(a.account_id, b.account_id) AS account_id, order_won, order_forecast, order_n, invoice_won, invoice_forecast, invoice_n,
       coalesce(order_won, 0) - coalesce(invoice_won, 0) AS won_check, coalesce(order_forecast, 0) - coalesce(invoice_forecast, 0) AS forecast_check,
       coalesce(order_n, 0) - coalesce(invoice_n, 0) AS n_check,
       coalesce(a.d, b.d) || coalesce(a.product, b.product) || coalesce(a.rpt_group, b.rpt_group) || coalesce(a.region, b.region, 'NA') || coalesce(a.segment, b.segment) || coalesce(a.account_id, b.account_id) AS helper
FROM a FULL JOIN b ON a.d = b.d AND a.product = b.product AND a.rpt_group = b.rpt_group AND a.region IS NOT DISTINCT FROM b.region AND a.segment = b.segment AND a.account_id = b.account_id""")
def recon_master_check(t: Tables):
    return reconcile.run(recon_sources(t), "1996-01-01")["master_check"]


@query("recon_missing_invoices", """
SELECT o_orderkey AS id, o_custkey AS account_id, round(o_totalprice / CASE WHEN c_nationkey <> 7 THEN 1 + c_nationkey / 4.0 END) AS value,
       'deal ' || o_orderkey AS deal_name FROM orders JOIN customer ON o_custkey = c_custkey
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND c_nationkey <> 9 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def recon_missing_invoices(t: Tables):
    return reconcile.run(recon_sources(t), "1996-01-01")["missing_invoices"].select("id", "account_id", "value", "deal_name")


def pricing_sources(t: Tables) -> dict[str, DataFrame]:
    """Revenue and deals from orders, scheduler captures from parts, portal usage from events, tiers from nations."""
    o, c = t.orders, t.customer
    n = F.col("n_nationkey")
    product = F.when(F.col("o_orderpriority") == "1-URGENT", "INST").when(F.col("o_orderpriority") == "2-HIGH", "PORT").otherwise("OTHER")
    cat = F.when(F.col("o_orderpriority") == "5-LOW", "Flips - Maintenance").when(F.col("o_orderpriority") == "3-MEDIUM", "New")
    return {
        "revenue": o.select(F.col("o_orderkey").alias("deal_id"), product.alias("product"), F.floor("o_totalprice").cast("double").alias("arr")),
        "deals": o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("account_id"), cat.alias("category"), F.when(F.col("o_orderstatus") == "F", "Closed Won").otherwise("Open").alias("stage")),
        "accounts": c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("gap_to_list")),
        "captures": t.part.select(F.col("p_partkey").alias("scheduler_id"), F.col("p_size").cast("double").alias("per_day")),
        "schedulers": t.part.select(F.col("p_partkey").alias("scheduler_id"), (F.col("p_partkey") % 700).alias("customer_id")),
        "instance_customers": c.select(F.col("c_custkey").alias("customer_id"), F.col("c_custkey").alias("account_id")),
        "usage": t.events.select(F.col("user_id").alias("portal_id"), F.date_trunc("day", "ts").alias("human_start"), F.floor("value").alias("job_executions")),
        "portal_customers": c.select(F.col("c_custkey").alias("portal_id"), F.col("c_custkey").alias("account_id")),
        "tiers": t.nation.select(
            (n + 1).alias("tier"), (n * n * 400).cast("double").alias("up_to"),
            *[(F.lit(k * 10000.0) + n * k * 1000).alias(f"base_{e}") for k, e in ((1, "standard"), (2, "professional"), (3, "enterprise"))],
            *[F.lit(v).alias(f"overage_{e}") for v, e in ((8.0, "standard"), (4.0, "professional"), (2.0, "enterprise"))],
        ),
    }


GAPS = """
WITH arr AS (SELECT o_custkey AS account_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'INST' ELSE 'PORT' END AS product, sum(floor(o_totalprice)) AS arr FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2),
inst AS (SELECT c_custkey AS account_id, round(sum(p_size * 365.25)) AS jobs, count(DISTINCT p_partkey) AS schedulers FROM part JOIN customer ON c_custkey = p_partkey % 700 GROUP BY 1),
pd AS (SELECT user_id, date_trunc('day', ts) AS d, sum(floor(value)) AS s FROM events WHERE floor(value) > 10 AND ts >= TIMESTAMP '2023-10-18' AND date_trunc('day', ts) < TIMESTAMP '2024-01-23' GROUP BY 1, 2),
port AS (SELECT user_id AS account_id, round(avg(s) * 365) AS jobs FROM pd WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY 1),
seed AS (SELECT arr.*, c_name AS name, i.schedulers, i.jobs * 2 AS instance_jobs, p.jobs AS portal_jobs, coalesce(i.jobs * 2, 0) + coalesce(p.jobs, 0) AS total_yearly_jobs,
  arr.account_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F') AS flipped
  FROM arr LEFT JOIN inst i ON i.account_id = arr.account_id AND arr.product = 'INST' LEFT JOIN port p ON p.account_id = arr.account_id AND arr.product = 'PORT' LEFT JOIN customer ON c_custkey = arr.account_id),
tiers AS (SELECT n_nationkey + 1 AS tier, CAST(n_nationkey * n_nationkey * 400 AS DOUBLE) AS up_to, 10000.0 + n_nationkey * 1000 AS b1, 20000.0 + n_nationkey * 2000 AS b2, 30000.0 + n_nationkey * 3000 AS b3 FROM nation),
t1 AS (SELECT seed.*, (SELECT max(tier) FROM tiers WHERE up_to <= total_yearly_jobs) AS t0 FROM seed),
t2 AS (SELECT * EXCLUDE (t0), CASE WHEN t0 < 2 AND product = 'PORT' THEN 3 ELSE t0 END AS tier FROM t1),
t3 AS (SELECT t2.*, up_to, greatest(total_yearly_jobs - up_to, 0) AS job_overage, b1, b2, b3 FROM t2 LEFT JOIN tiers USING (tier)),
g AS (SELECT account_id, product, arr, name, schedulers, flipped, total_yearly_jobs, tier, up_to, job_overage, arr - (b1 + job_overage * 8) AS standard_gap, arr - (b2 + job_overage * 4) AS professional_gap, arr - (b3 + job_overage * 2) AS enterprise_gap FROM t3)"""


def _gaps(t: Tables) -> dict[str, DataFrame]:
    return pricing.run(pricing_sources(t), "2024-01-26", instance_product="INST", portal_product="PORT", base_url="https://crm.example/r", excluded=[3])


@query("gap_to_list", GAPS + """
SELECT *, greatest(standard_gap, professional_gap, enterprise_gap) AS lowest_cost_gap, CASE WHEN standard_gap >= professional_gap AND standard_gap >= enterprise_gap THEN 'Standard'
WHEN professional_gap >= enterprise_gap THEN 'Professional' ELSE 'Enterprise' END AS lowest_cost_edition FROM g""")
def gap_to_list(t: Tables):
    return _gaps(t)["gaps"].select(
        "account_id", "product", "arr", "name", "schedulers", "flipped", "total_yearly_jobs", "tier", "up_to", "job_overage",
        "standard_gap", "professional_gap", "enterprise_gap", "lowest_cost_gap", "lowest_cost_edition",
    )


@query("gap_account_update", GAPS + """
SELECT c_custkey AS id, coalesce(s, 0) AS gap_to_list FROM customer LEFT JOIN (SELECT account_id, sum(professional_gap) AS s FROM g GROUP BY 1) ON account_id = c_custkey WHERE account_id IS NOT NULL OR c_acctbal > 0""")
def gap_account_update(t: Tables):
    return _gaps(t)["account_update"]


@query("gap_report", GAPS + """
SELECT '=HYPERLINK("https://crm.example/r/Account/' || account_id || '/view","' || name || '")' AS "Account Name", product, arr, tier AS "Usage Tier", up_to AS "Annual Executions Limit",
       total_yearly_jobs AS "Total Yearly Jobs", job_overage AS "Estimated Overage", professional_gap AS "professional gap" FROM g WHERE account_id <> 3""")
def gap_report(t: Tables):
    return _gaps(t)["report"].select("Account Name", "product", "arr", "Usage Tier", "Annual Executions Limit", "Total Yearly Jobs", "Estimated Overage", "professional gap")


def forecast_sheet(t: Tables) -> DataFrame:
    """Cumulative forecasts and actuals per priority and day, from orders summed to one row per priority and day."""
    amount, status = F.floor("o_totalprice"), F.col("o_orderstatus")
    day = t.orders.groupBy(F.col("o_orderpriority").alias("line"), F.to_date("o_orderdate").alias("order_date")).agg(
        F.sum(F.when(status == "O", amount).otherwise(0)).alias("o"), F.sum(F.when(status == "F", amount).otherwise(0)).alias("f"), F.sum(F.when(status == "P", amount)).alias("p"),
    )
    upto = Window.partitionBy("line").orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
    cum = {n: F.sum(c).over(upto).cast("double") for n, c in (("new_forecast", "o"), ("new_actual", "f"), ("expansion_forecast", "f"), ("expansion_actual", "o"), ("flips_forecast", "o"))}
    return day.select("line", "order_date", *[e.alias(n) for n, e in cum.items()], F.col("p").cast("double").alias("flips_actual"))


SHEET = """
WITH x AS (SELECT o_orderpriority AS line, CAST(o_orderdate AS DATE) AS d, sum(CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice) ELSE 0 END) AS o,
  sum(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE 0 END) AS f, sum(CASE WHEN o_orderstatus = 'P' THEN floor(o_totalprice) END) AS p FROM orders GROUP BY 1, 2),
c AS (SELECT *, sum(o) OVER w AS co, sum(f) OVER w AS cf, row_number() OVER w = 1 AS first FROM x WINDOW w AS (PARTITION BY line ORDER BY d)),
r AS (SELECT line, d, CASE WHEN co < cf OR d < DATE '1998-01-01' THEN 0 WHEN first THEN NULL ELSE o END AS new, CASE WHEN cf < co OR d < DATE '1998-01-01' THEN 0 WHEN first THEN NULL ELSE f END AS exp,
  CASE WHEN first THEN 0 ELSE o END - coalesce(p, 0) AS net, CASE WHEN first THEN NULL ELSE o END AS raw FROM c),
"""
RATES = """ SELECT line, d AS order_date, booking_type, forecast::DOUBLE AS forecast FROM (SELECT line, d, 'New' AS booking_type, new AS forecast FROM s UNION ALL SELECT line, d, 'Expansion', exp FROM s
UNION ALL SELECT line, d, 'Flips - Maintenance', flip FROM s) WHERE forecast <> 0"""


@query("forecast_decumulate_v1", SHEET + "s AS (SELECT *, greatest(net, 0) AS flip FROM r)" + RATES)
def forecast_decumulate_v1(t: Tables):
    return forecast.daily_rates(forecast_sheet(t), "1998-01-01", version=1, series=["line"])


@query("forecast_decumulate_v2", SHEET + "s AS (SELECT *, CASE WHEN d < DATE '1998-01-01' THEN net ELSE raw END AS flip FROM r)" + RATES)
def forecast_decumulate_v2(t: Tables):
    return forecast.daily_rates(forecast_sheet(t), "1998-01-01", version=2, series=["line"])


def snapshot_rows(t: Tables) -> DataFrame:
    """A snapshot per order year; those before 1998 lack three amounts, as early captures do."""
    o = t.orders
    base = o.select(
        F.col("o_orderkey").alias("id"), F.lit("deal").alias("name"), F.to_date("o_orderdate").alias("close_date"), F.col("o_orderstatus").alias("stage"),
        F.col("o_orderpriority").alias("type"), F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("billing_period_1_amount"),
        (F.col("o_totalprice") / 2).alias("acv_bookings"), F.lit(7.0).alias("forecast"), F.col("o_totalprice").alias("software_bookings"),
        F.lit(1.0).alias("expansion_amount"), F.lit(2.0).alias("expansion_forecast"), (F.col("o_custkey") % 25).alias("currency"),
        (F.col("o_orderstatus") == "P").alias("test"), F.make_date(F.year("o_orderdate") + 1, F.lit(1), F.lit(1)).alias("snapshot_time"),
    )
    old = base.where("snapshot_time < '1998-06-01'").drop("software_bookings", "expansion_amount", "expansion_forecast")
    return union_fill(base.where("snapshot_time >= '1998-06-01'"), old)


@query("snapshot_history", """
WITH s AS (SELECT o.*, make_date(year(o_orderdate)::INTEGER + 1, 1, 1) AS st, CASE WHEN o_custkey % 25 = 3 THEN NULL ELSE 1 + (o_custkey % 25) / 8.0 END AS rate FROM orders o WHERE o_orderstatus <> 'P')
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS close_date, o_orderstatus AS stage, CASE WHEN o_orderkey = 6 THEN 'New Business' ELSE o_orderpriority END AS type,
       round(o_totalprice / rate, 4) AS fyv, round(CASE WHEN st >= DATE '1998-06-01' THEN o_totalprice / rate END, 4) AS software, NULL::VARCHAR AS sao_date, st AS snapshot_time
FROM s WHERE st > (SELECT max(make_date(year(o_orderdate)::INTEGER + 1, 1, 1)) FROM orders WHERE year(o_orderdate) = 1995)""")
def snapshot_history(t: Tables):
    rows = snapshot_rows(t)
    rates = t.nation.where("n_name <> 'NATION_3'").select(F.col("n_nationkey").cast("bigint").alias("iso_code"), (1 + F.col("n_nationkey") / 8.0).alias("rate"))
    mark = watermark(rows.where("close_date < '1996-01-01'"), "snapshot_time")
    out = snapshots.run(rows, rates, mark, {6: {"type": "New Business"}})
    return out.select(
        "id", "close_date", "stage", "type", F.round("first_year_value_usd", 4).alias("fyv"), F.round("software_usd", 4).alias("software"), "sao_date", "snapshot_time"
    )


def onboarding_sources(t: Tables) -> dict[str, DataFrame]:
    """Deals from orders: urgent ones new business, high ones flips, medium ones services; projects and tasks from lines."""
    o, l, c = t.orders, t.lineitem, t.customer
    p = F.col("o_orderpriority")
    kind = F.when(p == "1-URGENT", "New Business").when(p == "2-HIGH", "Existing Business").when(p == "3-MEDIUM", "Professional Services").otherwise("Renewal")
    related = F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey") - 1).when(F.col("o_custkey") % 4 == 0, F.col("o_orderkey") + 1)
    line = F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    people = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return {
        "deals": o.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("account_id"), F.concat(F.lit("deal "), F.col("o_orderkey").cast("string")).alias("name"),
            (F.col("o_custkey") % 12).alias("owner_id"), (F.col("o_custkey") % 30).alias("team_lead_id"), related.alias("related_id"), F.col("o_orderdate").alias("close_date"),
            F.col("o_totalprice").alias("software_bookings"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 3).cast("double").alias("services_bookings"),
            kind.alias("type"), F.when(p == "2-HIGH", F.when(F.col("o_custkey") % 2 == 0, "SAP Flip").otherwise("Other")).alias("expansion_category"),
            F.when(F.col("o_custkey") % 7 == 0, "Excluded").otherwise("P").alias("product"), F.lit("boss").alias("owner_manager"),
            F.when(F.col("o_orderstatus") == "P", "Open").otherwise("Closed Won").alias("stage"), F.date_add("o_orderdate", -30).alias("sao_date"),
            F.when(F.col("o_custkey") % 3 == 0, "migrates").alias("services_requirements"), (F.col("o_orderkey") % 2 == 0).alias("migration"),
        ),
        "users": people,
        "accounts": c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, "P").alias("active_products"), F.col("c_mktsegment").alias("in_production")),
        "projects": l.where("l_returnflag = 'R'").select(
            line.alias("id"), F.col("l_orderkey").alias("deal_id"), F.concat(F.lit("proj "), line).alias("name"), F.col("l_linestatus").alias("status"), F.lit("st").alias("stage"),
            F.col("l_shipdate").alias("created"), F.concat(F.lit("kind "), F.col("l_linestatus")).alias("type"), F.date_add("l_shipdate", 7).alias("start"),
            (F.col("l_suppkey") * 2).alias("owner_id"), F.col("l_partkey").alias("manager_id"),
        ).distinct(),
        "tasks": l.where("l_returnflag = 'A'").select(
            line.alias("id"), F.col("l_orderkey").alias("deal_id"), F.when(F.col("l_linestatus") == "O", "Onboarding").otherwise("Call").alias("type"),
            F.when(F.col("l_linenumber") <= 4, "Customer Success").otherwise("Sales").alias("role"), F.lit("open").alias("status"), F.concat(F.lit("task "), line).alias("subject"),
            F.col("l_suppkey").alias("owner_id"), F.lit("T").alias("product"), F.date_add("l_shipdate", 3).alias("activity_date"),
        ).distinct(),
        "contacts": t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
    }


DEALS = """
WITH opp AS (SELECT o_orderkey AS id, o_custkey AS account_id, 'deal ' || o_orderkey AS name, o_custkey % 12 AS owner_id, o_custkey % 30 AS lead_id,
  CASE WHEN o_orderstatus = 'O' THEN o_orderkey - 1 WHEN o_custkey % 4 = 0 THEN o_orderkey + 1 END AS related_id, CAST(o_orderdate AS DATE) AS close_date, o_totalprice AS software_bookings,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 3 AS DOUBLE) END AS services_bookings, CASE o_orderpriority WHEN '1-URGENT' THEN 'New Business' WHEN '2-HIGH' THEN 'Existing Business'
  WHEN '3-MEDIUM' THEN 'Professional Services' ELSE 'Renewal' END AS type, CASE WHEN o_orderpriority = '2-HIGH' THEN CASE WHEN o_custkey % 2 = 0 THEN 'SAP Flip' ELSE 'Other' END END AS cat,
  CASE WHEN o_custkey % 7 = 0 THEN 'Excluded' ELSE 'P' END AS product, CASE WHEN o_orderstatus = 'P' THEN 'Open' ELSE 'Closed Won' END AS stage, CAST(o_orderdate AS DATE) - 30 AS sao_date,
  CASE WHEN o_custkey % 3 = 0 THEN 'migrates' END AS services_requirements, o_orderkey % 2 = 0 AS migration FROM orders),
ps AS (SELECT * FROM opp WHERE type = 'Professional Services'),
d0 AS (SELECT o.*, u.s_name AS owner, u2.s_name AS team_lead FROM opp o JOIN supplier u ON u.s_suppkey = owner_id LEFT JOIN supplier u2 ON u2.s_suppkey = lead_id
  WHERE (type = 'New Business' OR (type = 'Existing Business' AND cat = 'SAP Flip')) AND stage = 'Closed Won' AND close_date > DATE '1996-12-31' AND product <> 'Excluded'
  AND account_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)),
rev AS (SELECT related_id AS k, arg_min(id, (close_date, id)) AS v FROM ps WHERE related_id IS NOT NULL GROUP BY 1),
d1 AS (SELECT d0.* EXCLUDE (related_id), CASE WHEN name = 'deal 10' AND coalesce(related_id, rev.v) IS NULL THEN 11 ELSE coalesce(related_id, rev.v) END AS related_id FROM d0 LEFT JOIN rev ON rev.k = d0.id),
d2 AS (SELECT d1.*, r.name AS rname, r.stage AS rstage, r.type AS rtype, r.services_bookings AS ramount, r.close_date AS related_close_date FROM d1 LEFT JOIN opp r ON r.id = d1.related_id),
d3 AS (SELECT d2.* EXCLUDE (related_id), CASE WHEN rtype <> 'Professional Services' THEN NULL ELSE related_id END AS related_id FROM d2),
nx AS (SELECT d.id, arg_min(b.id, (b.close_date, b.id)) AS v FROM d3 d JOIN ps b ON b.account_id = d.account_id AND b.close_date > d.close_date AND b.close_date < d.close_date + INTERVAL 12 MONTH GROUP BY 1),
d4 AS (SELECT d3.* EXCLUDE (related_id, rname, rstage, rtype, ramount), coalesce(related_id, nx.v) AS related_id FROM d3 LEFT JOIN nx ON nx.id = d3.id),
deals AS (SELECT d4.*, r.name AS related_name, r.stage AS related_stage, r.type AS related_type, r.services_bookings AS related_amount FROM d4 LEFT JOIN opp r ON r.id = d4.related_id),
proj AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, l_orderkey AS deal_id, l_linestatus AS status, l_suppkey * 2 AS owner_id, l_partkey AS manager_id,
  CAST(l_shipdate AS DATE) AS created, 'kind ' || l_linestatus AS type, CAST(l_shipdate AS DATE) + 7 AS start FROM lineitem WHERE l_returnflag = 'R'),
task AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, l_orderkey AS deal_id, l_suppkey AS owner_id, CAST(l_shipdate AS DATE) + 3 AS activity_date FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'O' AND l_linenumber <= 4)"""


def _onboarding(t: Tables) -> dict[str, DataFrame]:
    return onboarding.run(onboarding_sources(t), "1996-12-31", excluded=["Excluded"], manual={"deal 10": 11})


@query("onboarding_report", DEALS + """
SELECT d.account_id, d.id, d.owner, d.team_lead, CASE WHEN d.type = 'Existing Business' THEN 'SAP Flip' WHEN d.services_bookings > 0 THEN 'New Business w/PS Bundle' ELSE 'New Business' END AS opp_type,
       d.related_id, d.related_name, d.related_stage, d.related_type, d.related_amount, d.related_close_date, t.id AS task_id, 'task ' || t.id AS task_subject, tu.s_name AS task_owner,
       'proj ' || p.id AS project_name, p.status AS project_status, pu.s_name AS project_owner, c.p_name AS engagement_manager_name, a.c_mktsegment AS in_production,
       d.sao_date, d.services_requirements, d.migration, p.created AS project_created, p.type AS project_type, p.start AS project_start, t.activity_date AS task_activity_date
FROM deals d LEFT JOIN task t ON t.deal_id = d.id LEFT JOIN proj p ON p.deal_id = d.related_id LEFT JOIN supplier tu ON tu.s_suppkey = t.owner_id LEFT JOIN supplier pu ON pu.s_suppkey = p.owner_id
LEFT JOIN part c ON c.p_partkey = p.manager_id LEFT JOIN customer a ON a.c_custkey = d.account_id""")
def onboarding_report(t: Tables):
    return _onboarding(t)["onboarding"].select(
        "account_id", "id", "owner", "team_lead", "opp_type", "related_id", "related_name", "related_stage", "related_type", "related_amount", "related_close_date", "task_id",
        "task_subject", "task_owner", "project_name", "project_status", "project_owner", "engagement_manager_name", "in_production",
        "sao_date", "services_requirements", "migration", "project_created", "project_type", "project_start", "task_activity_date",
    )


@query("onboarding_deals", DEALS + """
SELECT d.id, d.related_id, 'proj ' || p.id AS project_name, pu.s_name AS project_owner, t.id AS task_id, tu.s_name AS task_owner,
       d.sao_date, d.services_requirements, d.migration, p.created AS project_created, p.type AS project_type, p.start AS project_start, t.activity_date AS task_activity_date FROM deals d
LEFT JOIN (SELECT deal_id, min(id) AS id, arg_min(owner_id, id) AS owner_id, arg_min(created, id) AS created, arg_min(type, id) AS type, arg_min(start, id) AS start FROM proj GROUP BY 1) p ON p.deal_id = d.related_id
LEFT JOIN (SELECT deal_id, min(id) AS id, arg_min(owner_id, id) AS owner_id, arg_min(activity_date, id) AS activity_date FROM task GROUP BY 1) t ON t.deal_id = d.id
LEFT JOIN supplier pu ON pu.s_suppkey = p.owner_id LEFT JOIN supplier tu ON tu.s_suppkey = t.owner_id""")
def onboarding_deals(t: Tables):
    return _onboarding(t)["deals"].select(
        "id", "related_id", "project_name", "project_owner", "task_id", "task_owner", "sao_date", "services_requirements", "migration", "project_created", "project_type",
        "project_start", "task_activity_date",
    )


def tag_sources(t: Tables) -> dict[str, DataFrame]:
    seg, key = F.col("c_mktsegment"), F.col("c_custkey")
    areas = F.when(seg == "BUILDING", None).when(seg == "MACHINERY", "Alpha;Tag").when(seg == "FURNITURE", "Tag;Alpha").when(seg == "HOUSEHOLD", "Tag").otherwise("Alpha")
    domain = F.when(F.col("c_nationkey") != 2, F.concat(F.lit("d"), F.col("c_nationkey").cast("string"), F.lit("."), F.substring("c_mktsegment", 1, 1)))
    first = F.when(F.col("s_nationkey") != 5, F.concat(F.lit("d"), F.col("s_nationkey").cast("string"), F.lit("."), F.element_at(F.array(*[F.lit(x) for x in "ABFHM"]), (F.col("s_suppkey") % 5 + 1).cast("int"))))
    return {
        "accounts": t.customer.select(key.alias("id"), areas.alias("areas"), domain.alias("domain"), F.when(F.col("c_acctbal") < 0, "x").alias("linked_id")),
        "customers": t.supplier.select(F.col("s_name").alias("id"), first.alias("domain"), F.when(F.col("s_acctbal") > 2000, "Active Account").otherwise("Former").alias("status")),
    }


TAGS = """
WITH r AS (SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'Alpha;Tag' WHEN 'FURNITURE' THEN 'Tag;Alpha' WHEN 'HOUSEHOLD' THEN 'Tag' ELSE 'Alpha' END AS areas,
  CASE WHEN c_nationkey <> 2 THEN 'd' || c_nationkey || '.' || substring(c_mktsegment, 1, 1) END AS domain, CASE WHEN c_acctbal < 0 THEN 'x' END AS linked_id FROM customer),
c AS (SELECT s_name AS id, CASE WHEN s_nationkey <> 5 THEN 'd' || s_nationkey || '.' || ['A','B','F','H','M'][CAST(s_suppkey % 5 AS INTEGER) + 1] END AS domain,
  CASE WHEN s_acctbal > 2000 THEN 'Active Account' ELSE 'Former' END AS status FROM supplier),
seed AS (SELECT r.id, r.areas, r.linked_id, string_agg(c.id, ',' ORDER BY c.id) AS matched_ids, count(*) AS match_count FROM r LEFT JOIN c ON r.domain = c.domain
  WHERE c.status = 'Active Account' OR r.areas LIKE '%Tag%' OR r.linked_id IS NOT NULL GROUP BY 1, 2, 3)"""


@query("tag_matches", TAGS + " SELECT id, match_count, matched_ids IS NOT NULL AS matched FROM seed")
def tag_matches(t: Tables):
    return tag_sync.run(tag_sources(t), "Tag")["candidates"].select("id", "match_count", "matched")


@query("tag_matched_ids", TAGS + " SELECT id, 0 AS part, matched_ids FROM seed WHERE matched_ids IS NOT NULL")
def tag_matched_ids(t: Tables):
    """The ids that each matched candidate has, as one text (parts of 1 GiB). A domain's text is put together once; then each candidate gets it."""
    out = tag_sync.run(tag_sources(t), "Tag")
    texts = joined_text(out["domain_ids"], ["scope", "domain"], "matched_id", "matched_ids", chunk_bytes=1 << 30)
    named = left_lookup(out["candidates"].where("matched"), texts, [("scope", "scope"), ("domain", "domain")], {"part": "part", "matched_ids": "matched_ids"})
    return named.select("id", F.col("part").cast("int").alias("part"), "matched_ids")


@query("tag_sync", TAGS + """,
up AS (SELECT id, areas AS old, matched_ids IS NULL AS churned, CASE WHEN areas IS NULL THEN 'Tag' ELSE areas || ';Tag' END AS tagged FROM seed WHERE matched_ids IS NULL OR areas IS NULL OR NOT contains(areas, 'Tag')),
nw AS (SELECT id, old, CASE WHEN churned THEN replace(replace(tagged, ';Tag', ''), 'Tag', '') ELSE tagged END AS areas FROM up)
SELECT id, nullif(areas, '') AS areas FROM nw WHERE areas IS DISTINCT FROM old""")
def tag_sync_(t: Tables):
    return tag_sync.run(tag_sources(t), "Tag")["account_update"]


@query("tag_sync_exact", TAGS + """,
nw AS (SELECT id, areas AS old, CASE WHEN matched_ids IS NOT NULL THEN CASE WHEN areas IS NULL THEN 'Tag' ELSE areas || ';Tag' END
  ELSE coalesce(array_to_string(list_filter(string_split(areas, ';'), lambda e: e <> 'Tag'), ';'), '') END AS areas FROM seed WHERE matched_ids IS NULL OR areas IS NULL OR NOT contains(areas, 'Tag'))
SELECT id, nullif(areas, '') AS areas FROM nw WHERE areas IS DISTINCT FROM old""")
def tag_sync_exact(t: Tables):
    return tag_sync.run(tag_sources(t), "Tag", exact=True)["account_update"]


@query("warehouse_query", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def warehouse_query(t: Tables):
    return sql_query(
        t.spark,
        """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, count(*) AS n FROM {lineitem}
           WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""",
        lineitem=t.lineitem,
    )
