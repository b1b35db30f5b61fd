"""Jobs over nested documents: contracts, telemetry, forecast exports, installer events.

The documents are made by Spark from the flat tables, one per row; those that arrive as text are JSON text.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.dates import to_millis
from revloom.operators import joins
from revloom.operators.schema import flatten, union_fill
from revloom.plans import contracts, forecast_export, install_match, telemetry
from revloom.queries.registry import SQL, Tables, query
from revloom.session import shared_folder


@cache
def ddl(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def parts(d: Column) -> Column:
    return F.struct(F.year(d).alias("year"), F.month(d).alias("month"), F.day(d).alias("dayOfMonth"))


def contract_documents(t: Tables) -> DataFrame:
    """A contract per order: two yearly periods, one when filled; two tiers per period, none when partial."""
    o = t.orders
    day, key = F.to_date("o_orderdate"), F.col("o_orderkey").cast("string")
    tiers = F.when(F.col("o_orderstatus") != "P", F.array(
        F.struct(F.lit(0).alias("start"), F.lit(1.5).alias("price")),
        F.struct((F.col("o_orderkey") % 9).alias("start"), (F.col("o_orderkey") % 9 / 2).alias("price")),
    ))

    def period(n: int) -> Column:
        return F.struct(
            F.concat(key, F.lit(f"-{n}")).alias("id"), parts(F.add_months(day, 12 * n)).alias("startDate"),
            parts(F.add_months(day, 12 * (n + 1))).alias("endDate"), tiers.alias("jobTiers"),
        )

    one, two = F.array(period(0)), F.array(period(0), period(1))
    places = F.when(F.col("o_orderpriority") == "5-LOW", None).when(F.col("o_orderpriority") == "2-HIGH", F.array().cast("array<struct<deploymentType:string>>"))
    places = places.otherwise(F.array(F.struct(F.col("o_orderstatus").alias("deploymentType")), F.struct(F.lit("Z").alias("deploymentType"))))
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("opp"), key).alias("opportunityId"), F.col("o_custkey").alias("customerId"),
        F.col("o_orderpriority").alias("productId"), F.lit("MONTHLY").alias("usagePeriod"), F.col("o_orderstatus").alias("status"),
        F.struct(F.concat(F.lit("p"), F.col("o_custkey")).alias("portalId"), F.lit("n").alias("name"), F.col("o_custkey").alias("accountId")).alias("customer"),
        F.struct(F.lit("x").alias("id"), F.lit("y").alias("stage")).alias("opportunity"),
        F.when(F.col("o_orderstatus") != "P", parts(day)).alias("provisionDate"), places.alias("locationCounts"),
        F.array(F.struct(F.lit("s").alias("sku"))).alias("contractItems"), F.when(F.col("o_orderstatus") == "F", one).otherwise(two).alias("contractPeriods"),
    )


PERIODS = """
WITH p AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d, n, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR * n AS DATE) AS s,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR * (n + 1) AS DATE) AS e FROM orders, (VALUES (0), (1)) v(n) WHERE n = 0 OR o_orderstatus <> 'F')"""


@query("contracts", """
SELECT o_orderkey AS id, 'opp' || o_orderkey AS "opportunityId", o_custkey AS "customerId", o_orderpriority AS "productId", 'MONTHLY' AS "usagePeriod", o_orderstatus AS status,
       'p' || o_custkey AS "customer_portalId", 'n' AS customer_name, o_custkey AS "customer_accountId",
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS provision_date,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS "provisionDate_year", CASE WHEN o_orderstatus <> 'P' THEN CAST(month(o_orderdate) AS INTEGER) END AS "provisionDate_month",
       CASE WHEN o_orderstatus <> 'P' THEN CAST(day(o_orderdate) AS INTEGER) END AS "provisionDate_dayOfMonth",
       CASE WHEN o_orderpriority IN ('5-LOW', '2-HIGH') THEN 'Unknown' ELSE o_orderstatus END AS "DeploymentType",
       CAST(o_orderdate AS DATE) AS human_start,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR * CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS DATE) AS human_end
FROM orders""")
def contracts_(t: Tables):
    return contracts.contract_table(contract_documents(t))


@query("contract_periods", PERIODS + """
SELECT o_orderkey || '-' || n AS id, 'opp' || o_orderkey AS "opportunityId", 'MONTHLY' AS usage_period, CAST(year(s) AS INTEGER) AS "startDate_year", CAST(month(s) AS INTEGER) AS "startDate_month",
       CAST(day(s) AS INTEGER) AS "startDate_dayOfMonth", CAST(year(e) AS INTEGER) AS "endDate_year", CAST(month(e) AS INTEGER) AS "endDate_month", CAST(day(e) AS INTEGER) AS "endDate_dayOfMonth", s AS human_start, e AS human_end,
       s <= DATE '1998-06-01' AND e > DATE '1998-06-01' AS active_today FROM p""")
def contract_periods(t: Tables):
    return contracts.period_table(contract_documents(t), "1998-06-01")


TIERS = """ SELECT 'opp' || o_orderkey AS "opportunityId", o_orderkey || '-' || n AS "ContractPeriodId",
CASE k WHEN 0 THEN 0 ELSE o_orderkey % 9 END AS start, CASE k WHEN 0 THEN 1.5 ELSE (o_orderkey % 9) / 2 END::DOUBLE AS price FROM p, (VALUES (0), (1)) w(k) WHERE o_orderstatus <> 'P'"""


@query("contract_job_tiers", PERIODS + TIERS)
def contract_job_tiers(t: Tables):
    return contracts.job_tier_table(contract_documents(t))


@query("contract_job_tiers_last", PERIODS + TIERS + " AND (n = 1 OR o_orderstatus = 'F')")
def contract_job_tiers_last(t: Tables):
    return contracts.job_tier_table(contract_documents(t), last_only=True)


def usage_documents(t: Tables) -> DataFrame:
    """Usage periods per contract: two, an empty list for high priority, none at all for low."""
    day = F.to_date("o_orderdate")

    def used(n: int) -> Column:
        return F.struct(
            parts(F.add_months(day, 12 * n)).alias("startDate"), parts(F.add_months(day, 12 * (n + 1))).alias("endDate"),
            (F.col("o_orderkey") % 100 + n).alias("usage"), F.lit(2 * n).alias("overage"), F.lit(5).alias("newCredit"), F.lit(n).alias("startCredit"),
        )

    lists = F.when(F.col("o_orderpriority") == "5-LOW", None).when(F.col("o_orderpriority") == "2-HIGH", F.slice(F.array(used(0)), 1, 0))
    return t.orders.select(F.col("o_orderkey").alias("contract_id"), lists.otherwise(F.array(used(0), used(1))).alias("usagePeriods"))


@query("usage_periods", """
WITH p AS (SELECT o_orderkey, o_custkey, n, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR * n AS DATE) AS s,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR * (n + 1) AS DATE) AS e FROM orders, (VALUES (0), (1)) v(n) WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH'))
SELECT o_orderkey || '-' || o_custkey || '-' || s || '-' || e AS id, o_orderkey AS contract_id, 'opp' || o_orderkey AS "opportunityId", o_custkey AS "customerId",
       'p' || o_custkey AS portal_id, s AS human_start, e AS human_end, o_orderkey % 100 + n AS usage, 2 * n AS overage, 5 AS "newCredit", n AS "startCredit",
       CAST(year(s) AS INTEGER) AS "startDate_year", CAST(month(s) AS INTEGER) AS "startDate_month", CAST(day(s) AS INTEGER) AS "startDate_dayOfMonth", CAST(year(e) AS INTEGER) AS "endDate_year", CAST(month(e) AS INTEGER) AS "endDate_month", CAST(day(e) AS INTEGER) AS "endDate_dayOfMonth"
FROM p""")
def usage_periods(t: Tables):
    return contracts.usage_period_table(usage_documents(t), contract_documents(t))


def product_documents(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("display.name"), F.array(F.col("p_type")).alias("contractItemTypes"),
        F.array(
            F.struct(F.col("p_brand").alias("id"), F.col("p_size").alias("size"), F.array(F.lit(1)).alias("items")),
            F.struct(F.col("p_type").alias("id"), F.lit(None).cast("int").alias("size"), F.array(F.lit(2)).alias("items")),
        ).alias("packages"),
    )


@query("products", "SELECT p_partkey AS id, p_name AS display_name FROM part")
def products(t: Tables):
    return contracts.products(product_documents(t))["products"]


@query("product_packages", """
SELECT p_brand AS id, p_size AS size, p_partkey AS "ProductId" FROM part UNION ALL SELECT p_type, NULL, p_partkey FROM part""")
def product_packages(t: Tables):
    return contracts.products(product_documents(t))["product_packages"]


@query("flatten_objects", """
SELECT o_orderkey AS id, 'p' || o_custkey AS "customer.portalId", CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS "provisionDate.year" FROM orders""")
def flatten_objects(t: Tables):
    flat = flatten(contract_documents(t))
    return flat.select("id", "`customer.portalId`", "`provisionDate.year`")


# Telemetry, first family: a document per event. Sign-up events are loaded already, cheap views arrive cut off.
LIVE = "event_type <> 'signup' AND NOT (event_type = 'view' AND value < 20)"


def server_source(t: Tables) -> tuple[DataFrame, DataFrame]:
    e = t.events
    domains = F.array(F.struct(F.concat(F.lit("d"), F.col("user_id")).alias("domain"), F.floor("value").alias("users")), F.struct(F.lit("all").alias("domain"), F.lit(1).alias("users")))
    server = F.struct(F.col("user_id").alias("port"), F.col("event_type").alias("role"), F.array(F.lit(1), F.lit(2)).alias("ids"), domains.alias("domainData"))
    doc = F.to_json(F.struct(
        F.concat(F.lit("site-"), F.col("user_id")).alias("customerId"), F.lit("SERVER").alias("productType"), F.col("event_type").alias("version"),
        to_millis("ts").cast("string").alias("creationDate"), F.array(server).alias("serverData"),
        F.when(F.col("event_type") == "click", F.array(F.struct(F.col("value").alias("load"), F.struct(F.lit("h").alias("name")).alias("host")))).alias("gatewayData"),
    ))
    cut = F.when((F.col("event_type") == "view") & (F.col("value") < 20), F.substring(doc, 1, 20)).otherwise(doc)
    source = e.select(F.col("event_id").alias("id"), to_millis("ts").alias("creationDate"), cut.alias("data"))
    return source, e.where("event_type = 'signup'").select(F.col("event_id").alias("id"))


SERVER_DOC = """customerId STRING, productType STRING, version STRING, creationDate STRING,
serverData ARRAY<STRUCT<port: BIGINT, role: STRING, ids: ARRAY<INT>, domainData: ARRAY<STRUCT<domain: STRING, users: BIGINT>>>>,
gatewayData ARRAY<STRUCT<load: DOUBLE, host: STRUCT<name: STRING>>>"""


def server_tables(t: Tables) -> dict[str, DataFrame]:
    parsed = telemetry.new_documents(*server_source(t), ddl(SERVER_DOC))
    return {**telemetry.servers(parsed), "unreadable": telemetry.quarantine(parsed)}


@query("telemetry_data", f"""
SELECT event_id AS product_statistics_id, 'site-' || user_id AS "customerId", 'SERVER' AS "productType", event_type AS version, epoch_us(ts) // 1000 AS created_ms
FROM events WHERE {LIVE}""")
def telemetry_data(t: Tables):
    return server_tables(t)["data"].withColumn("created_ms", to_millis("creationDate")).drop("creationDate")


@query("telemetry_server", f"""
SELECT event_id AS product_statistics_id, user_id AS port, event_type AS role, '[1,2]' AS ids FROM events WHERE {LIVE}""")
def telemetry_server(t: Tables):
    return server_tables(t)["server"]


@query("telemetry_server_domain", f"""
SELECT event_id AS product_statistics_id, 'd' || user_id AS domain, CAST(floor(value) AS BIGINT) AS users FROM events WHERE {LIVE}
UNION ALL SELECT event_id, 'all', 1 FROM events WHERE {LIVE}""")
def telemetry_server_domain(t: Tables):
    return server_tables(t)["server_domain"]


@query("telemetry_gateway", f"""
SELECT event_id AS product_statistics_id, value AS load, 'h' AS host_name FROM events WHERE {LIVE} AND event_type = 'click'""")
def telemetry_gateway(t: Tables):
    return server_tables(t)["gateway"]


@query("telemetry_documents", f"SELECT event_id AS id, epoch_us(ts) // 1000 AS created_ms FROM events WHERE {LIVE}")
def telemetry_documents(t: Tables):
    return server_tables(t)["documents"].select("id", to_millis("creationDate").alias("created_ms"))


@query("telemetry_unreadable", "SELECT event_id AS id FROM events WHERE event_type = 'view' AND value < 20")
def telemetry_unreadable(t: Tables):
    return server_tables(t)["unreadable"].select(F.col(telemetry.KEY).alias("id"))


# Second family: a document per order, its schema found from the documents. Low-priority ones are loaded already.
NODE_LIVE = "o_orderpriority <> '5-LOW'"


def node_source(t: Tables) -> tuple[DataFrame, DataFrame]:
    sec = F.unix_seconds("o_orderdate")
    status = F.col("o_orderstatus")
    doc = F.to_json(F.struct(
        F.col("o_orderpriority").alias("version"), sec.alias("creationDate"),
        F.struct(F.col("o_orderstatus").alias("mode"), F.array(F.struct(F.col("o_custkey").alias("user")), F.struct((F.col("o_custkey") + 1).alias("user"))).alias("authList")).alias("auth"),
        F.array(F.struct(F.struct(sec.alias("installedDate"), F.lit("x").alias("edition")).alias("general"))).alias("config"),
        F.when(status != "P", F.struct(
            F.when(status == "O", "many").otherwise((F.col("o_orderkey") % 5).cast("string")).alias("sinkCount"),
            F.array(F.struct(F.concat(F.lit("r"), F.col("o_orderkey")).alias("rule"))).alias("rules"),
        )).alias("events"),
        F.array(F.struct(F.lit("web").alias("type"), (status == "F").alias("active"))).alias("interfaces"),
        F.struct(sec.alias("intervalStartTime"), (sec + 60).alias("intervalEndTime"), (sec - 60).alias("serverStartedTime")).alias("status"),
        F.when(status == "F", F.struct(F.lit("up").alias("state"), F.array(F.lit("a"), F.lit("b")).alias("peers"))).alias("sync"),
    ))
    source = t.orders.select(F.col("o_orderkey").alias("id"), sec.alias("creationDate"), doc.alias("data"))
    return source, t.orders.where("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias(telemetry.KEY))


def node_tables(t: Tables) -> dict[str, DataFrame]:
    return telemetry.nodes(telemetry.new_documents(*node_source(t)))


@query("node_product_statistics", f"""
SELECT o_orderkey AS product_statistics_id, o_orderpriority AS version, epoch_us(o_orderdate) // 1000000 AS created FROM orders WHERE {NODE_LIVE}""")
def node_product_statistics(t: Tables):
    return node_tables(t)["product_statistics"].select(telemetry.KEY, "version", F.unix_seconds("creationDate").alias("created"))


@query("node_auth", f"SELECT o_orderkey AS product_statistics_id, o_orderstatus AS mode FROM orders WHERE {NODE_LIVE}")
def node_auth(t: Tables):
    return node_tables(t)["auth"]


@query("node_auth_list", f"""
SELECT o_orderkey AS product_statistics_id, o_custkey AS user FROM orders WHERE {NODE_LIVE}
UNION ALL SELECT o_orderkey, o_custkey + 1 FROM orders WHERE {NODE_LIVE}""")
def node_auth_list(t: Tables):
    return node_tables(t)["auth_list"].withColumn("user", F.col("user").cast("bigint"))


@query("node_config", f"""
SELECT o_orderkey AS product_statistics_id, 'x' AS general_edition, epoch_us(o_orderdate) // 1000000 AS installed FROM orders WHERE {NODE_LIVE}""")
def node_config(t: Tables):
    return node_tables(t)["config"].select(telemetry.KEY, "general_edition", F.unix_seconds("general_installedDate").alias("installed"))


@query("node_events", f"""
SELECT o_orderkey AS product_statistics_id, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 5 AS INTEGER) END AS "sinkCount" FROM orders WHERE {NODE_LIVE} AND o_orderstatus <> 'P'""")
def node_events(t: Tables):
    return node_tables(t)["events"]


@query("node_event_rules", f"SELECT o_orderkey AS product_statistics_id, 'r' || o_orderkey AS rule FROM orders WHERE {NODE_LIVE} AND o_orderstatus <> 'P'")
def node_event_rules(t: Tables):
    return node_tables(t)["event_rules"]


@query("node_interfaces", f"SELECT o_orderkey AS product_statistics_id, 'web' AS type, o_orderstatus = 'F' AS active FROM orders WHERE {NODE_LIVE}")
def node_interfaces(t: Tables):
    return node_tables(t)["interfaces"]


@query("node_status", f"""
SELECT o_orderkey AS product_statistics_id, s AS started, s + 60 AS ended, s - 60 AS booted FROM (SELECT *, epoch_us(o_orderdate) // 1000000 AS s FROM orders) WHERE {NODE_LIVE}""")
def node_status(t: Tables):
    return node_tables(t)["status"].select(
        telemetry.KEY, F.unix_seconds("intervalStartTime").alias("started"), F.unix_seconds("intervalEndTime").alias("ended"), F.unix_seconds("serverStartedTime").alias("booted")
    )


@query("node_sync", f"""
SELECT o_orderkey AS product_statistics_id, 'up' AS state, '["a","b"]' AS peers FROM orders WHERE {NODE_LIVE} AND o_orderstatus = 'F'""")
def node_sync(t: Tables):
    return node_tables(t)["sync"]


@query("date_repair", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE epoch_us(o_orderdate) // 1000000 END AS text_s,
       CASE WHEN o_orderstatus = 'O' THEN 0 ELSE epoch_us(o_orderdate) // 1000000 END AS millis_s FROM orders""")
def date_repair(t: Tables):
    o = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.col("o_orderdate").cast("string")).alias("a"),
        F.when(F.col("o_orderstatus") != "O", to_millis("o_orderdate")).alias("b"),
    )
    o = telemetry.repair_dates(telemetry.repair_dates(o, ["a"]), ["b"], millis=True)
    return o.select("o_orderkey", F.unix_seconds("a").alias("text_s"), F.unix_seconds("b").alias("millis_s"))


def export_documents(t: Tables) -> list[DataFrame]:
    """Two forecast exports with different entry columns; their time frames are the same rows throughout."""
    o = t.orders
    who = F.array(F.struct(F.col("o_custkey").alias("user.id"), F.struct((F.col("o_custkey") % 3).alias("team")).alias("scope")))
    frames = F.array(F.struct(F.lit("Q1").alias("frame"), F.lit(1).alias("n")), F.struct(F.lit("Q2").alias("frame"), F.lit(2).alias("n")))
    periods = F.array(F.struct(F.year("o_orderdate").alias("year")))
    fields = F.array(F.struct(F.col("o_orderpriority").alias("field name")))
    first = F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("forecast")))
    second = F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("call.type")), F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("call.type")))
    common = [who.alias("users"), fields.alias("fields"), periods.alias("timePeriods"), frames.alias("timeFrames")]
    return [o.where("o_orderstatus = 'F'").select(first.alias("entries"), *common), o.where("o_orderstatus <> 'F'").select(second.alias("entries"), *common)]


@query("forecast_entries", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS forecast, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS call_type FROM orders""")
def forecast_entries(t: Tables):
    return forecast_export.run(export_documents(t))["entries"]


@query("forecast_dimensions", """
SELECT 'users' AS part, CAST(o_custkey AS VARCHAR) || ':' || CAST(o_custkey % 3 AS VARCHAR) AS value FROM orders UNION
SELECT 'fields', o_orderpriority FROM orders UNION SELECT 'periods', CAST(year(o_orderdate) AS VARCHAR) FROM orders UNION SELECT 'frames', f FROM (VALUES ('Q1-1'), ('Q2-2')) v(f)""")
def forecast_dimensions(t: Tables):
    tables = forecast_export.run(export_documents(t))
    return union_fill(
        tables["users"].select(F.lit("users").alias("part"), F.concat_ws(":", F.col("user_id").cast("string"), F.col("scope_team").cast("string")).alias("value")),
        tables["field_map"].select(F.lit("fields").alias("part"), F.col("field_name").alias("value")),
        tables["time_period_map"].select(F.lit("periods").alias("part"), F.col("year").cast("string").alias("value")),
        tables["time_frame_map"].select(F.lit("frames").alias("part"), F.concat_ws("-", "frame", F.col("n").cast("string")).alias("value")),
    )


# Installer events from pages: the download name holds six characters of the page's hash, then its address.
INSTALLS = r"""
WITH i AS (SELECT DISTINCT 'setup-' || substring(md5(url), 1, 6) || '.exe ' || url AS install FROM pages WHERE url LIKE 'https%'),
l AS (SELECT page_id AS id, CASE WHEN page_id % 2 = 0 THEN substring(md5(url), 1, 6) ELSE regexp_extract(url, '//([^/]+)/', 1) END AS token FROM pages),
m AS (SELECT l.id, l.token, install FROM l JOIN i ON CASE WHEN length(token) = 6 THEN contains(install, '-' || token || '.') ELSE contains(install, token) END WHERE token <> '')"""


def install_sources(t: Tables) -> dict[str, DataFrame]:
    p = t.pages
    code = F.substring(F.md5(F.col("url").cast("binary")), 1, 6)
    name = F.concat(F.lit("setup-"), code, F.lit(".exe "), F.col("url"))
    kind = F.when(F.col("url").like("https%"), "install").otherwise("visit")
    token = F.when(F.col("page_id") % 2 == 0, code).otherwise(F.regexp_extract("url", "//([^/]+)/", 1))
    return {
        "payload": p.select(kind.alias("type"), F.array(F.col("page_id").cast("string"), name).alias("properties")),
        "leads": p.select(F.col("page_id").alias("id"), token.alias("token"), F.lit(False).alias("verified"), F.lit(True).alias("token_present")),
    }


@query("install_match", INSTALLS + """
SELECT DISTINCT id, token, false AS verified, true AS token_present, install FROM m""")
def install_match_(t: Tables):
    return install_match.run(install_sources(t))["matches"]


@query("install_update", INSTALLS + " SELECT DISTINCT id, true AS verified FROM m")
def install_update(t: Tables):
    return install_match.run(install_sources(t))["lead_update"]


@query("words_in_documents", r"""
WITH w AS (SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(text, '[^ \n]+')) AS word FROM benchmark))
SELECT word AS token, doc_id FROM documents JOIN w ON CASE WHEN length(word) = 6 THEN contains(text, ' ' || word || ' ') ELSE contains(text, word) END""")
def words_in_documents(t: Tables):
    """All words of the benchmark in all documents; those of six characters between spaces."""
    words = t.benchmark.select(F.explode(F.regexp_extract_all("text", F.lit("([^ \\n]+)"), F.lit(1))).alias("word"))
    return joins.containing(t.documents, "doc_id", "text", words, "word", frame=(" ", " "))


# The same documents stored as VARIANT, their tables by declared names.
SERVER_TABLES = {
    "data": ([], {"customerId": "string", "productType": "string", "version": "string", "creationDate": "bigint"}),
    "server": (["serverData"], {"port": "bigint", "role": "string", "ids": "json"}),
    "server_domain": (["serverData", "domainData"], {"domain": "string", "users": "bigint"}),
    "gateway": (["gatewayData"], {"load": "double", "host.name": "string"}),
}
NODE_TABLES = {
    "events": (["events"], {"sinkCount": "int"}),
    "event_rules": (["events", "rules"], {"rule": "string"}),
    "auth_list": (["auth", "authList"], {"user": "bigint"}),
    "interfaces": (["interfaces"], {"type": "string", "active": "boolean"}),
    "sync": (["sync"], {"state": "string", "peers": "json"}),
    "status": (["status"], {"intervalStartTime": "bigint", "intervalEndTime": "bigint", "serverStartedTime": "bigint"}),
}


def stored_variants(t: Tables, source: DataFrame, loaded: DataFrame) -> DataFrame:
    place = shared_folder(t.spark)
    parsed = telemetry.new_variants(source, loaded).select(telemetry.KEY, "data", "doc")
    parsed.write.parquet(place)
    return t.spark.read.schema(parsed.schema).parquet(place)


@query("variant_data", SQL["telemetry_data"])
def variant_data(t: Tables):
    return telemetry.declared(stored_variants(t, *server_source(t)), SERVER_TABLES)["data"].withColumnRenamed("creationDate", "created_ms")


@query("variant_server", SQL["telemetry_server"])
def variant_server(t: Tables):
    return telemetry.declared(stored_variants(t, *server_source(t)), SERVER_TABLES)["server"]


@query("variant_server_domain", SQL["telemetry_server_domain"])
def variant_server_domain(t: Tables):
    return telemetry.declared(stored_variants(t, *server_source(t)), SERVER_TABLES)["server_domain"]


@query("variant_gateway", SQL["telemetry_gateway"])
def variant_gateway(t: Tables):
    return telemetry.declared(stored_variants(t, *server_source(t)), SERVER_TABLES)["gateway"]


@query("variant_unreadable", SQL["telemetry_unreadable"])
def variant_unreadable(t: Tables):
    return stored_variants(t, *server_source(t)).where("doc IS NULL").select(F.col(telemetry.KEY).alias("id"))


@query("variant_events", SQL["node_events"])
def variant_events(t: Tables):
    return telemetry.declared(stored_variants(t, *node_source(t)), NODE_TABLES)["events"]


@query("variant_event_rules", SQL["node_event_rules"])
def variant_event_rules(t: Tables):
    return telemetry.declared(stored_variants(t, *node_source(t)), NODE_TABLES)["event_rules"]


@query("variant_auth_list", SQL["node_auth_list"])
def variant_auth_list(t: Tables):
    return telemetry.declared(stored_variants(t, *node_source(t)), NODE_TABLES)["auth_list"]


@query("variant_interfaces", SQL["node_interfaces"])
def variant_interfaces(t: Tables):
    return telemetry.declared(stored_variants(t, *node_source(t)), NODE_TABLES)["interfaces"]


@query("variant_sync", SQL["node_sync"])
def variant_sync(t: Tables):
    return telemetry.declared(stored_variants(t, *node_source(t)), NODE_TABLES)["sync"]


@query("variant_status", SQL["node_status"])
def variant_status(t: Tables):
    out = telemetry.declared(stored_variants(t, *node_source(t)), NODE_TABLES)["status"]
    return out.withColumnsRenamed({"intervalStartTime": "started", "intervalEndTime": "ended", "serverStartedTime": "booted"})
