"""Usage jobs: daily consolidation, activity by month, CRM sync, newest contact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import to_millis
from revloom.operators.schema import union_fill
from revloom.plans import activity, call_home, daily_usage, usage_sync
from revloom.queries.registry import Tables, query

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
KINDS = ["click", "error", "purchase", "signup", "view"]

# Portals of customers in nation 3 carry a legacy path and are dropped; hours starting at four have no start time.
PORTAL = "CASE WHEN c_nationkey = 3 THEN 'p/r2w/' ELSE 'p' END || c_custkey"


def portal_id():
    return F.concat(F.when(F.col("c_nationkey") == 3, "p/r2w/").otherwise("p"), F.col("c_custkey").cast("string"))


def zone():
    return F.when(F.col("c_nationkey") % 3 == 0, "America/New_York").when(F.col("c_nationkey") % 3 == 1, "Asia/Tokyo")


def daily_sources(t: Tables, as_map: bool) -> dict[str, DataFrame]:
    """Hourly consumption from events, wide: one column (or map entry) per event type."""
    hour = F.date_trunc("hour", "ts")
    e = t.events.select(F.col("user_id"), hour.alias("h"), "event_type", F.floor("value").alias("v"))
    wide = e.groupBy("user_id", "h").agg(*[F.sum(F.when(F.col("event_type") == k, F.col("v"))).alias(k) for k in KINDS])
    portals = t.customer.select(F.col("c_custkey").alias("user_id"), portal_id().alias("portal_id"))
    wide = wide.join(portals, "user_id")
    start = F.when(F.hour("h") != 4, to_millis("h"))
    total = sum((F.coalesce(F.col(k), F.lit(0)) for k in KINDS), F.lit(0))
    timed = [F.col("portal_id"), start.alias("startMillis"), (to_millis("h") + 3600000).alias("endMillis"), total.alias("jobExecutions")]
    envs = [F.create_map(*[x for k in KINDS for x in (F.lit(k), F.col(k))]).alias("environments")] if as_map else [F.col(k) for k in KINDS]
    c = t.customer
    return {
        "consumption": wide.select(*timed, *envs),
        "customers": c.where("c_mktsegment <> 'BUILDING'").select(portal_id().alias("portal_id"), F.col("c_name").alias("owner"), "c_acctbal"),
        "clients": c.where("c_mktsegment = 'BUILDING'").select(portal_id().alias("customer_code")),
        "activity_customers": c.where("c_acctbal < 0").select(portal_id().alias("customer_id")),
        "account_map": c.select(portal_id().alias("portal_id"), F.col("c_custkey").alias("account_id")),
        "accounts": c.select(F.col("c_custkey").alias("id"), zone().alias("timezone")),
        "known_usage": t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("portal_id")),
    }


DAILY = f"""
WITH h AS (SELECT user_id, date_trunc('hour', ts) AS h FROM events GROUP BY ALL),
x AS (SELECT {PORTAL} AS portal_id, h.h, k.k AS environment, CASE c_nationkey % 3 WHEN 0 THEN -5 WHEN 1 THEN 9 ELSE 0 END AS off,
      (SELECT sum(floor(value)) FROM events e WHERE e.user_id = h.user_id AND date_trunc('hour', e.ts) = h.h AND e.event_type = k.k) AS v
      FROM h JOIN customer ON c_custkey = h.user_id, (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) k(k)
      WHERE hour(h.h) <> 4 AND c_nationkey <> 3)
SELECT portal_id, environment, CAST(h + INTERVAL 1 HOUR * off AS DATE) AS date, coalesce(sum(v), 0)::BIGINT AS job_executions,
       epoch_us(min(h)) // 1000000 AS start_s, epoch_us(max(h)) // 1000000 + 3600 AS end_s
FROM x GROUP BY ALL"""


def _daily(t: Tables, as_map: bool) -> DataFrame:
    usage = daily_usage.run(daily_sources(t, as_map))["usage"]
    return usage.select(
        "portal_id", "environment", "date", "job_executions", F.unix_seconds("human_start").alias("start_s"), F.unix_seconds("human_end").alias("end_s")
    )


@query("daily_usage_local", DAILY)
def daily_usage_local(t: Tables):
    return _daily(t, as_map=False)


@query("daily_usage_map", DAILY)
def daily_usage_map(t: Tables):
    return _daily(t, as_map=True)


@query("all_portal_ids", f"SELECT DISTINCT {PORTAL} AS portal_id FROM customer WHERE c_nationkey <> 3 UNION SELECT 's' || s_suppkey FROM supplier")
def all_portal_ids(t: Tables):
    return daily_usage.run(daily_sources(t, False))["all_portal_ids"]


def activity_sources(t: Tables) -> dict[str, DataFrame]:
    """Monthly order counts as activity: portals are customers, activities priorities. Partial orders have no data for December."""
    o = t.orders.select(
        F.col("o_custkey").cast("string").alias("portal_id"), F.col("o_orderstatus").alias("envid"), F.col("o_orderpriority").alias("activity"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m"),
    )
    counts = [
        (F.count(F.when(F.col("m") == i, 1)) if n != "Dec" else F.sum(F.when((F.col("m") == i) & (F.col("envid") != "P"), 1))).alias(f"data.{n}")
        for i, n in enumerate(MONTHS, 1)
    ]
    wide = o.groupBy("portal_id", "envid", "activity", "year").agg(*counts).withColumn("type", F.lit("jobs"))
    c, names = t.customer, t.orders.select(F.col("o_orderpriority").alias("name")).distinct()
    return {
        "activity": wide,
        "customers_1": c.where("c_acctbal >= 0").select(F.col("c_custkey").cast("string").alias("customerid"), F.lit("jobs").alias("type")),
        "customers_2": c.where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("customerid"), F.lit("finance").alias("type"), F.col("c_name").alias("name")),
        "activity_types_1": names.withColumn("type", F.lit("jobs")),
        "activity_types_2": names.where("name LIKE '%H%'").withColumn("type", F.lit("finance")),
        "years": o.select("year").distinct(),
    }


@query("activity_by_month", """
WITH g AS (SELECT o_custkey::VARCHAR AS portal_id, o_orderstatus AS envid, o_orderpriority AS activity, year(o_orderdate)::INTEGER AS y, 'jobs' AS type, list(month(o_orderdate)) AS ms FROM orders GROUP BY ALL)
SELECT portal_id, envid, activity, type, make_date(y, m.m, 1) AS month,
       CASE WHEN m.m = 12 THEN CASE WHEN envid = 'P' OR NOT list_contains(ms, 12) THEN NULL ELSE len(list_filter(ms, lambda e: e = 12)) END
            ELSE len(list_filter(ms, lambda e: e = m.m)) END::BIGINT AS count
FROM g, (SELECT unnest(range(1, 13))::INTEGER AS m) m""")
def activity_by_month(t: Tables):
    return activity.run(activity_sources(t))["activity"]


@query("empty_requests", """
WITH a AS (SELECT c_custkey::VARCHAR AS customerid, CASE WHEN c_acctbal >= 0 THEN 'jobs' ELSE 'finance' END AS type FROM customer),
y AS (SELECT DISTINCT year(o_orderdate)::INTEGER AS year FROM orders), n AS (SELECT DISTINCT o_orderpriority AS activity FROM orders),
asked AS (SELECT * FROM a, y, n WHERE type = 'jobs' OR activity LIKE '%H%')
SELECT * FROM asked s WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE s.type = 'jobs' AND o.o_custkey::VARCHAR = s.customerid AND o.o_orderpriority = s.activity AND year(o.o_orderdate) = s.year)""")
def empty_requests(t: Tables):
    return activity.run(activity_sources(t))["empty_requests"]


@query("activity_customers", """
SELECT c_custkey::VARCHAR AS customerid, CASE WHEN c_acctbal >= 0 THEN 'jobs' ELSE 'finance' END AS type, CASE WHEN c_acctbal < 0 THEN c_name END AS name FROM customer""")
def activity_customers(t: Tables):
    return activity.run(activity_sources(t))["activity_customers"]


AS_OF = "1999-06-20"


def sync_sources(t: Tables) -> dict[str, DataFrame]:
    """Daily usage, contracts and snapshots from orders; instance counters from lineitem."""
    o, c, l = t.orders, t.customer, t.lineitem
    text = lambda name: F.col(name).cast("string")
    return {
        "activity_customers": c.where("c_mktsegment <> 'BUILDING'").select(text("c_custkey").alias("id"), F.concat(F.lit("A"), text("c_custkey")).alias("account")),
        "customers": c.where("c_mktsegment = 'BUILDING'").select(text("c_custkey").alias("id"), F.concat(F.lit("B"), text("c_custkey")).alias("account")),
        "reported": c.where("c_acctbal < 0").select(text("c_custkey").alias("id"), F.concat(F.lit("A"), text("c_custkey")).alias("account")),
        "contracts": o.select(
            F.col("o_orderkey").alias("id"), F.concat(F.lit("opp"), text("o_orderkey")).alias("opportunityId"), F.col("o_custkey").alias("customer_id"),
            F.concat(F.lit("A"), text("o_custkey")).alias("account_id"), F.lit("MONTHLY").alias("usagePeriod"), F.to_date("o_orderdate").alias("human_start"),
            F.add_months(F.to_date("o_orderdate"), 12).alias("human_end"), F.col("o_orderstatus").alias("DeploymentType"), F.col("o_orderpriority").alias("productId"),
        ),
        "products": o.select(F.col("o_orderpriority").alias("id")).distinct().where("id <> '5-LOW'").withColumn("displayName", F.lower("id")),
        "usage_periods": l.groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("usage")).select(
            F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("id"), F.col("l_orderkey").alias("contract_id"), text("l_orderkey").alias("portal_id"), "usage",
            F.lit(0).alias("overage"), F.lit(1).alias("expectedEndCredit"), F.lit(2).alias("expectedEndUsage"), F.lit(3).alias("expectedOverage"), F.lit(4).alias("expectedOverageAmount"),
            F.lit(5).alias("overageAmount"), F.col("l_linenumber").alias("newCredit"), F.lit(10).alias("startCredit"), F.lit("1999-01-01").cast("date").alias("human_start"),
            F.lit("1999-12-31").cast("date").alias("human_end"),
        ),
        "usage": o.select(
            text("o_custkey").alias("portal_id"), F.col("o_orderpriority").alias("environment"), F.to_date("o_orderdate").alias("date"), (F.col("o_orderkey") % 1000).alias("job_executions"),
        ),
        "snapshots": l.select(
            F.col("l_orderkey").alias("capture_id"), F.col("l_shipdate").alias("start"), F.col("l_quantity").cast("bigint").alias("succeeded"),
            F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")).otherwise(0).alias("failed"), F.when(F.col("l_linestatus") == "O", 1).alias("aborted"),
        ),
        "captures": o.select(F.col("o_orderkey").alias("capture_id"), F.col("o_custkey").alias("scheduler_id")),
        "schedulers": c.select(F.col("c_custkey").alias("scheduler_id"), F.col("c_nationkey").alias("customer_id")),
        "instance_customers": t.nation.select(F.col("n_nationkey").alias("customer_id"), F.col("n_name").alias("customer_name"), F.concat(F.lit("N"), text("n_nationkey")).alias("account_id")),
        "crm_daily": o.where("o_orderstatus <> 'O'").select(
            text("o_orderkey").alias("id"), F.concat(text("o_custkey"), "o_orderpriority", F.to_date("o_orderdate").cast("string"), text("o_orderkey"), F.lit("P")).alias("record_key"),
        ),
        "accounts": c.select(
            F.concat(F.lit("A"), text("c_custkey")).alias("id"), F.lit(1.0).alias("usage_change"), F.when(F.col("c_nationkey") != 3, 2.0).alias("usage_last_30"),
            F.lit("1990-01-01").cast("date").alias("last_usage_date"),
        ),
    }


def synced_usage(s: dict[str, DataFrame]) -> DataFrame:
    return usage_sync.daily_usage(s, usage_sync.id_map(s), AS_OF, "P", "I")


MAP = """m AS (SELECT c_custkey::VARCHAR AS portal_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE 'A' END || c_custkey AS account_id FROM customer),
newest AS (SELECT account_id, opportunityId FROM (SELECT 'A' || o_custkey AS account_id, 'opp' || o_orderkey AS opportunityId,
  row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR DESC, 'opp' || o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)"""
USAGE = f"""WITH {MAP},
portal AS (SELECT o_custkey::VARCHAR AS portal_id, o_orderpriority AS environment, CAST(o_orderkey % 1000 AS DOUBLE) AS job_executions, CAST(o_orderdate AS DATE) AS date,
  'P' AS product, m.account_id, n.opportunityId AS deal_id FROM orders LEFT JOIN m ON m.portal_id = o_custkey::VARCHAR LEFT JOIN newest n ON n.account_id = m.account_id
  WHERE CAST(o_orderdate AS DATE) >= DATE '1996-06-01'),
inst AS (SELECT 'NA - ' || n_name AS portal_id, 'JssId - ' || o_custkey AS environment,
  (sum(l_quantity) + sum(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END) + sum(CASE WHEN l_linestatus = 'O' THEN 1 END))::DOUBLE AS job_executions,
  CAST(l_shipdate AS DATE) AS date, 'I' AS product, 'N' || n_nationkey AS account_id, NULL::VARCHAR AS deal_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE l_shipdate >= TIMESTAMP '1996-06-20' GROUP BY n_name, o_custkey, CAST(l_shipdate AS DATE), n_nationkey),
u AS (SELECT * FROM portal UNION ALL SELECT * FROM inst),
k AS (SELECT *, portal_id || environment || date || coalesce(CAST(CAST(job_executions AS BIGINT) AS VARCHAR), 'NA') || product AS record_key FROM u)"""


@query("usage_daily", USAGE + " SELECT * FROM u")
def usage_daily(t: Tables):
    return synced_usage(sync_sources(t))


@query("usage_daily_insert", USAGE + """
SELECT DISTINCT record_key, portal_id, environment, date, product FROM k WHERE record_key NOT IN (SELECT o_custkey::VARCHAR || o_orderpriority || CAST(o_orderdate AS DATE) || o_orderkey || 'P' FROM orders WHERE o_orderstatus <> 'O')""")
def usage_daily_insert(t: Tables):
    s = sync_sources(t)
    return usage_sync.daily_changes(synced_usage(s), s["crm_daily"])["daily_insert"].select("record_key", "portal_id", "environment", "date", "product")


@query("usage_daily_delete", USAGE + """
SELECT o_orderkey::VARCHAR AS id, o_custkey::VARCHAR || o_orderpriority || CAST(o_orderdate AS DATE) || o_orderkey || 'P' AS record_key FROM orders WHERE o_orderstatus <> 'O'
AND o_custkey::VARCHAR || o_orderpriority || CAST(o_orderdate AS DATE) || o_orderkey || 'P' NOT IN (SELECT record_key FROM k)""")
def usage_daily_delete(t: Tables):
    s = sync_sources(t)
    return usage_sync.daily_changes(synced_usage(s), s["crm_daily"])["daily_delete"]


@query("usage_account_update", USAGE + """,
l AS (SELECT account_id, max(date) AS last FROM u GROUP BY 1),
s AS (SELECT account_id, last, coalesce(sum(job_executions) FILTER (date >= last - 62 AND date < last - 32), 0) AS b,
      coalesce(sum(job_executions) FILTER (date >= last - 32 AND date < last), 0) AS a FROM u JOIN l USING (account_id) GROUP BY 1, 2)
SELECT account_id AS id, CASE WHEN a = 0 AND b = 0 THEN 0 WHEN b = 0 THEN 100 ELSE round_even(round(100 * (a - b) / b, 9), 0) END::DOUBLE AS usage_change, a AS usage_last_30, last AS last_usage_date FROM s
UNION ALL SELECT 'A' || c_custkey, NULL, NULL, DATE '1990-01-01' FROM customer WHERE c_nationkey <> 3 AND 'A' || c_custkey NOT IN (SELECT account_id FROM s)""")
def usage_account_update(t: Tables):
    s = sync_sources(t)
    return usage_sync.account_update(synced_usage(s), s["accounts"])


@query("usage_id_map", """
SELECT c_custkey::VARCHAR AS portal_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE 'A' END || c_custkey AS account_id FROM customer
UNION SELECT c_custkey::VARCHAR, 'A' || c_custkey FROM customer WHERE c_acctbal < 0 AND c_mktsegment <> 'BUILDING'""")
def usage_id_map(t: Tables):
    return usage_sync.id_map(sync_sources(t))


def with_crm_usage(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    crm = usage_sync.usage_periods(s["usage_periods"], s["contracts"], s["products"])
    return s | {"crm_usage": crm.where("product IS NOT NULL").withColumn("usage", F.when(F.col("allotted_usage") == 11, 0).otherwise(F.col("usage")))}


@query("usage_period_changes", """
WITH p AS (SELECT l_orderkey || '-' || l_linenumber AS record_key, l_orderkey, l_linenumber + 10 AS allotted, CAST(sum(l_quantity) AS BIGINT) AS usage, o_orderpriority AS pr, o_custkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_linenumber, o_orderpriority, o_custkey)
SELECT record_key, CASE WHEN pr = '5-LOW' THEN 'insert' WHEN allotted = 11 AND usage <> 0 THEN 'update' ELSE 'noop' END AS action, usage, allotted AS allotted_usage,
       'opp' || l_orderkey AS deal_id, o_custkey AS customer_id, CASE WHEN pr <> '5-LOW' THEN lower(pr) END AS product FROM p""")
def usage_period_changes(t: Tables):
    return usage_sync.period_changes(with_crm_usage(sync_sources(t))).select("record_key", "action", "usage", "allotted_usage", "deal_id", "customer_id", "product")


@query("usage_rejected_accounts", USAGE + """,
r AS (SELECT 'N' || n_nationkey AS id FROM nation UNION ALL SELECT 'A' || c_custkey FROM customer WHERE c_acctbal < 0)
SELECT DISTINCT r.id, 'gone' AS error, replace(portal_id, 'NA - ', '') AS portal_id, product FROM r LEFT JOIN u ON u.account_id = r.id""")
def usage_rejected_accounts(t: Tables):
    nations = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"))
    low = t.customer.where("c_acctbal < 0").select(F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("id"))
    return usage_sync.rejected_accounts(union_fill(nations, low).withColumn("error", F.lit("gone")), synced_usage(sync_sources(t)))


def call_sources(t: Tables) -> dict[str, DataFrame]:
    """Calls from events. Customers below user 40 send a record id; others a site id with a UUID, assets know the even ones."""
    h = lambda c: F.md5(F.col(c).cast("string").cast("binary"))
    uuid = lambda c: F.concat_ws("-", *[F.substring(h(c), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    e = t.events
    site = F.when(F.col("user_id") < 40, F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))).otherwise(F.concat(F.lit("site-"), uuid("user_id")))
    return {
        "statistics": e.select(F.col("event_id").alias("id"), F.col("ts").alias("creationDate")),
        "details": e.select(
            F.col("event_id").alias("product_statistics_id"), site.alias("customerId"), F.when(F.col("event_type") == "error", "OTHER").otherwise("SERVER").alias("productType"),
            F.when(F.col("event_type") == "view", "9.1 Beta").otherwise(F.concat(F.lit("9."), F.length("event_type").cast("string"))).alias("version"),
        ),
        "assets": t.customer.where("c_custkey % 2 = 0").select(F.concat(F.lit("acct-"), F.col("c_custkey").cast("string")).alias("account_id"), uuid("c_custkey").alias("serial")),
        "accounts": t.customer.select(F.explode(F.array("c_name", F.concat(F.lit("acct-"), F.col("c_custkey").cast("string")))).alias("id")).where("id NOT LIKE '%7'"),
    }


CALLS = """
WITH c AS (SELECT ts, user_id, CASE WHEN user_id < 40 THEN printf('Customer#%09d', user_id) WHEN user_id % 2 = 0 AND user_id IN (SELECT c_custkey FROM customer) THEN 'acct-' || user_id END AS account_id,
                  '9.' || length(event_type) AS version FROM events WHERE event_type NOT IN ('error', 'view') AND CAST(ts AS DATE) >= DATE '2024-01-10'),
r AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY ts DESC) AS rn FROM c WHERE account_id IS NOT NULL)
SELECT account_id AS id, epoch_us(ts) AS called_us, version AS latest_version FROM r WHERE rn = 1"""


@query("call_home_latest", CALLS)
def call_home_latest(t: Tables):
    out = call_home.run(call_sources(t), "2025-01-10", "SERVER")["account_update"]
    return out.select("id", F.unix_micros("last_call_home").alias("called_us"), "latest_version")


@query("call_home_unknown", f"SELECT id FROM ({CALLS}) WHERE id LIKE '%7'")
def call_home_unknown(t: Tables):
    return call_home.run(call_sources(t), "2025-01-10", "SERVER")["unknown_accounts"].select(F.col("account_id").alias("id"))
