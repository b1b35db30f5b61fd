"""Reading and writing: round trips through files in the shared folder, each with the SQL of what must come back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators.schema import union_fill
from revloom.plans import mirror, snapshots, usage_sync
from revloom.queries.registry import SQL, Tables, query
from revloom.queries.usage import AS_OF, sync_sources, with_crm_usage
from revloom.session import shared_folder
from revloom.sources import keyed, readers, writers


@query("json_payloads", """
SELECT o_orderkey AS id, o_custkey AS customer, [o_orderpriority, o_orderstatus][1] AS first_tag, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total FROM orders""")
def json_payloads(t: Tables):
    """Documents as JSON lines."""
    o, place = t.orders, shared_folder(t.spark)
    doc = o.select(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("customer"), F.array("o_orderpriority", "o_orderstatus").alias("tags")).alias("data"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("total"),
    )
    doc.write.json(place)
    back = readers.read_json(t.spark, place, "id BIGINT, data STRUCT<customer: BIGINT, tags: ARRAY<STRING>>, total DOUBLE", multi_line=False)
    return back.select("id", "data.customer", F.element_at("data.tags", 1).alias("first_tag"), "total")


@query("json_paths", """
SELECT 'c ' || (o_custkey % 5) AS portal_id, o_orderpriority AS activity, year(o_orderdate)::VARCHAR AS "year", count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY ALL""")
def json_paths(t: Tables):
    """Payloads whose parameters are in their path."""
    place = shared_folder(t.spark)
    portal = F.concat(F.lit("c "), (F.col("o_custkey") % 5).cast("string"))
    o = t.orders.select(portal.alias("p"), F.col("o_orderpriority").alias("a"), F.year("o_orderdate").alias("y"), "o_orderkey")
    o.write.partitionBy("p", "a", "y").json(place)
    pattern = r"/p=([^/]+)/a=([^/]+)/y=(\d{4})/[^/]+$"
    back = readers.read_json_with_path(t.spark, f"{place}/*/*/*", "o_orderkey BIGINT", pattern, ["portal_id", "activity", "year"], multi_line=False)
    return back.groupBy("portal_id", "activity", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("csv_report", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, TIMESTAMP '2024-01-10 07:00:00' AS now FROM customer""")
def csv_report(t: Tables):
    place = shared_folder(t.spark)
    c = t.customer.select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    c.write.csv(place, header=True)
    return readers.read_csv_report(t.spark, place, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE", "2024-01-10 12:00:00")


@query("sheet_range", """
SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderkey AS forecast FROM orders WHERE o_orderstatus <> 'P'""")
def sheet_range(t: Tables):
    """A landed sheet: rows without the date are empty ones."""
    place = shared_folder(t.spark)
    day = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    t.orders.select(day.alias("order_date"), F.col("o_orderkey").alias("forecast")).write.csv(place, header=True)
    return readers.read_range(t.spark, place, "order_date DATE, forecast BIGINT", "order_date")


@query("report_dates", """
SELECT o_orderkey AS "Account_Id", CAST(o_orderdate AS DATE) AS "Last_Activity_Date" FROM orders""")
def report_dates(t: Tables):
    """An activity report: its date typed, its names clean."""
    report = t.orders.select(F.col("o_orderkey").alias("Account Id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Last Activity Date"))
    return mirror.activity_dates(report)


@query("crm_object", """
SELECT c_custkey AS "Id", c_acctbal AS "Amount_c", c_acctbal / (1 + c_nationkey) AS "Amount_c_converted" FROM customer""")
def crm_object(t: Tables):
    """A CRM object with its currency field converted."""
    rows = t.customer.select(F.col("c_custkey").alias("Id"), F.col("c_acctbal").alias("Amount.c"), F.col("c_nationkey").alias("CurrencyIsoCode"))
    rates = t.nation.select(F.col("n_nationkey").alias("IsoCode"), (1.0 + F.col("n_nationkey")).alias("ConversionRate"))
    out = readers.read_object(rows.select("Id", "`Amount.c`", "CurrencyIsoCode"), [("Id", "id"), ("Amount.c", "currency"), ("CurrencyIsoCode", "string")], rates=rates)
    names = [c for c in out.columns if c not in ("Id", "Amount_c", "CurrencyIsoCode")]
    return out.select("Id", "Amount_c", F.col(names[0]).alias("Amount_c_converted"))


def half(t: Tables, remainder: int) -> DataFrame:
    return t.orders.where(F.col("o_orderkey") % 2 == remainder).select("o_orderkey", "o_totalprice")


@query("overwrite_load", "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")
def overwrite_load(t: Tables):
    """A table replaced by the second load, which has other prices."""
    place = shared_folder(t.spark)
    writers.overwrite(t.orders.select("o_orderkey", "o_totalprice"), place)
    writers.overwrite(t.orders.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice")), place)
    return t.spark.read.parquet(place)


@query("append_load", "SELECT o_orderkey, o_totalprice FROM orders")
def append_load(t: Tables):
    """Two loads, then two of nothing: an empty frame and none at all."""
    place = shared_folder(t.spark)
    writers.append(half(t, 0), place)
    writers.append_if_any(half(t, 1), place)
    writers.append_if_any(half(t, 2), place)
    writers.append_if_any(None, place)
    return t.spark.read.parquet(place)


@query("append_per_day", """
SELECT o_orderkey, DATE '2024-01-01' AS load_date FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, DATE '2024-01-02' FROM orders WHERE o_orderkey % 2 = 1""")
def append_per_day(t: Tables):
    """Loads under their day; the day that runs again replaces itself."""
    place = shared_folder(t.spark)
    writers.append_day(half(t, 0).select("o_orderkey"), place, "2024-01-01")
    writers.append_day(half(t, 0).select("o_orderkey"), place, "2024-01-02")
    writers.append_day(half(t, 1).select("o_orderkey"), place, "2024-01-02")
    return t.spark.read.parquet(place)


@query("append_stamped", "SELECT o_orderkey, TIMESTAMP '2024-03-01 06:30:00' AS now FROM orders")
def append_stamped(t: Tables):
    place = shared_folder(t.spark)
    writers.append_stamped(t.orders.select("o_orderkey"), place, "2024-03-01 06:30:00")
    return t.spark.read.parquet(place)


@query("mirrored_tables", """
SELECT store, name, id FROM (VALUES ('first'), ('second')) s(store), (SELECT 'orders' AS name, o_orderkey AS id FROM orders UNION ALL SELECT 'part_sanitized', p_partkey FROM part)""")
def mirrored_tables(t: Tables):
    """Due tables into one store, and from there into another; the third table is not due."""
    first, second = shared_folder(t.spark), shared_folder(t.spark)
    frames = {"orders": t.orders.select(F.col("o_orderkey").alias("id")), "part_sanitized": t.part.select(F.col("p_partkey").alias("id")), "nation": t.nation.select(F.col("n_nationkey").alias("id"))}
    modified, as_of = dt.datetime(2024, 1, 9), dt.date(2024, 1, 10)
    due = mirror.copy_tables(list(frames), frames.get, first, [lambda n, df: writers.overwrite(df, f"{second}/{n}")], modified, as_of)
    return union_fill(*[
        t.spark.read.parquet(f"{place}/{n}").select(F.lit(store).alias("store"), F.lit(n).alias("name"), "id") for store, place in (("first", first), ("second", second)) for n in due
    ])


@query("json_array_file", """
SELECT o_orderkey AS id, o_custkey AS customer, 'a "}" {' || o_orderstatus || chr(92) || '" ]' AS note, o_orderpriority || '},{' AS tags, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total FROM orders""")
def json_array_file(t: Tables):
    """All orders in one file that is a single array, as an API returns it."""
    place = shared_folder(t.spark)
    o = t.orders.withColumn("note", F.concat(F.lit('a "}" {'), "o_orderstatus", F.lit('\\" ]')))
    doc = F.struct(
        F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("customer"), F.array(F.col("o_orderpriority"), F.lit("},{")).alias("tags")).alias("data"), "note",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("total"),
    )
    writers.write_json_array(o.select(F.to_json(doc).alias("value")), place)
    back = readers.read_json_array(t.spark, place, "id BIGINT, data STRUCT<customer: BIGINT, tags: ARRAY<STRING>>, note STRING, total DOUBLE")
    return back.select("record.id", "record.data.customer", "record.note", F.array_join("record.data.tags", "").alias("tags"), "record.total")


@query("snapshot_captures", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 1 THEN o_orderstatus END AS stage, CASE WHEN o_orderkey % 4 IN (2, 3) THEN o_totalprice END AS amount,
       CASE o_orderkey % 4 WHEN 1 THEN TIMESTAMP '2024-02-01 08:00:00' WHEN 2 THEN TIMESTAMP '2024-02-01 17:00:00' ELSE TIMESTAMP '2024-02-02 08:00:00' END AS snapshot_time
FROM orders WHERE o_orderkey % 4 <> 0""")
def snapshot_captures(t: Tables):
    """Captures whose columns changed, two of them on one day; the first one is loaded already."""
    place, o = shared_folder(t.spark), t.orders
    columns = {0: ["stage"], 1: [], 2: ["stage", "amount"], 3: ["amount", "stage"]}
    taken = {0: "2024-01-31 08:00:00", 1: "2024-02-01 08:00:00", 2: "2024-02-01 17:00:00", 3: "2024-02-02 08:00:00"}
    for k, names in columns.items():
        rows = o.where(F.col("o_orderkey") % 4 == k).select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("stage"), F.col("o_totalprice").alias("amount"))
        rows.select("id", *names).write.parquet(f"{place}/Opportunity_{k}")
    listed = [(f"Opportunity_{k}", when, f"{place}/Opportunity_{k}") for k, when in taken.items()] + [("Account_1", taken[3], f"{place}/none")]
    captures = t.spark.createDataFrame(listed, "table_name string, creation_time string, path string").withColumn("creation_time", F.col("creation_time").cast("timestamp"))
    loaded = captures.where("table_name = 'Opportunity_0'").select(F.col("creation_time").alias("snapshot_time"))
    return snapshots.load(t.spark, captures, loaded, "^Opportunity_").select("id", "stage", "amount", "snapshot_time")


@query("usage_stored", SQL["usage_account_update"])
def usage_stored(t: Tables):
    """The whole usage sync, step by step from stored tables; its account update."""
    out = usage_sync.store(with_crm_usage(sync_sources(t)), AS_OF, shared_folder(t.spark), portal_product="P", instance_product="I")
    return out["account_update"]


@query("usage_periods_applied", f"SELECT * EXCLUDE (action) FROM ({SQL['usage_period_changes']}) WHERE action <> 'delete'")
def usage_periods_applied(t: Tables):
    """The CRM's usage periods in hash partitions, after the change set was applied to those that it meets."""
    sources, place = with_crm_usage(sync_sources(t)), shared_folder(t.spark)
    keyed.write(sources["crm_usage"], place, ["record_key"])
    usage_sync.apply_periods(sources, place)
    return keyed.read(t.spark, place).select("record_key", "deal_id", "customer_id", "product", "usage", "allotted_usage")
