"""Change sets, incremental loads, audit trail and reshaping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.dates import month_start, to_millis
from revloom.operators import changes, reshape, schema
from revloom.operators.joins import listed
from revloom.plans.field_catalog import run as field_catalog_run
from revloom.queries.registry import Tables, query
from revloom.sources import catalog

# The "before" and "after" of the change queries: each lacks a part of the orders the other has, and low-priority
# prices moved.
BEFORE = "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"
AFTER = """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')"""


def before_after(t: Tables):
    label = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority")
    moved = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice")
    before = t.orders.where("NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')").select("o_orderkey", "o_totalprice", label)
    return before, t.orders.where("NOT (o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')").select("o_orderkey", moved, label)


@query("changeset", f"""
WITH b AS ({BEFORE}), a AS ({AFTER})
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN a.o_orderkey IS NULL THEN 'delete' WHEN b.o_orderkey IS NULL THEN 'insert'
            WHEN a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority THEN 'noop' ELSE 'update' END AS action,
       CASE WHEN a.o_orderkey IS NULL THEN b.o_totalprice ELSE a.o_totalprice END AS o_totalprice,
       CASE WHEN a.o_orderkey IS NULL THEN b.o_orderpriority ELSE a.o_orderpriority END AS o_orderpriority
FROM b FULL JOIN a ON a.o_orderkey = b.o_orderkey""")
def changeset(t: Tables):
    return changes.change_set(*before_after(t), "o_orderkey")


@query("apply_changeset", f"SELECT * FROM ({AFTER})")
def apply_changeset(t: Tables):
    before, after = before_after(t)
    return changes.apply_change_set(before, changes.change_set(before, after, "o_orderkey"), "o_orderkey")


@query("changed_only", f"""
WITH b AS ({BEFORE}), a AS ({AFTER})
SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = a.o_orderkey AND b.o_totalprice = a.o_totalprice AND b.o_orderpriority IS NOT DISTINCT FROM a.o_orderpriority)""")
def changed_only(t: Tables):
    return changes.changed_only(*before_after(t), "o_orderkey", ["o_totalprice", "o_orderpriority"])


@query("append_new_only", f"""
WITH b AS ({BEFORE}), a AS ({AFTER}) SELECT * FROM b UNION ALL SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)""")
def append_new_only(t: Tables):
    before, after = before_after(t)
    return schema.union_fill(before, changes.new_only(after, before, ["o_orderkey"]))


@query("stale_nullout", """
WITH up AS (SELECT o_custkey AS id, count(*) AS n, max(o_totalprice) AS top FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1),
tgt AS (SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS n, c_acctbal AS top FROM customer)
SELECT * FROM up UNION ALL SELECT id, NULL, top FROM tgt WHERE n IS NOT NULL AND id NOT IN (SELECT id FROM up)""")
def stale_nullout(t: Tables):
    o = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp"))
    up = o.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    target = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("n"), F.col("c_acctbal").alias("top"))
    return changes.null_out_stale(target, up, "id", "n", ["n"])


@query("stale_zero", """
WITH up AS (SELECT o_custkey AS id, sum(CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice) END) AS gap FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT c_custkey AS id, coalesce(up.gap, 0.0) AS gap FROM customer LEFT JOIN up ON up.id = c_custkey WHERE up.id IS NOT NULL OR c_acctbal > 0""")
def stale_zero(t: Tables):
    o = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp"))
    up = o.select(F.col("o_custkey").alias("id"), F.when(F.col("o_orderstatus") == "F", F.round("o_totalprice")).alias("gap"))
    return changes.zero_out_stale(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("gap")), up, "id", "gap")


@query("failed_rows", """
WITH r AS (SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'low balance' END AS error FROM customer)
SELECT DISTINCT id, error, o_orderpriority, o_orderstatus FROM r LEFT JOIN orders ON o_custkey = id WHERE error IS NOT NULL""")
def failed_rows(t: Tables):
    r = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 0, "low balance").alias("error"))
    return changes.failed_rows(r, t.orders, ("id", "o_custkey"), "error", ["o_orderpriority", "o_orderstatus"])


def _audit(t: Tables, insert: bool = False):
    before, after = before_after(t)
    results = after.select("o_orderkey", F.when(F.col("o_totalprice") > 400000, F.array(F.lit("too high"))).alias("errors"))
    return changes.audit_trail(before, after, results, "run-1", "why " * 20000, insert=insert, key="o_orderkey")


@query("audit_changeset", f"""
WITH b AS ({BEFORE}), a AS ({AFTER})
SELECT 'before' AS part, 'run-1' AS run_id, o_orderkey, NULL AS errors FROM b
UNION ALL SELECT 'upload', 'run-1', o_orderkey, NULL FROM a WHERE o_orderkey IN (SELECT o_orderkey FROM b)
UNION ALL SELECT 'rejected', 'run-1', o_orderkey, NULL FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL SELECT 'results', 'run-1', o_orderkey, CASE WHEN o_totalprice > 400000 THEN '["too high"]' END FROM a""")
def audit_changeset(t: Tables):
    trail = _audit(t)
    parts = [trail[n].select(F.lit(n).alias("part"), "run_id", "o_orderkey") for n in ("before", "upload", "rejected")]
    return schema.union_fill(*parts, trail["results"].select(F.lit("results").alias("part"), "run_id", "o_orderkey", "errors"))


@query("audit_upsert", f"""
WITH a AS ({AFTER}) SELECT 'run-1' AS run_id, 'sent' AS part, count(*) AS n FROM a UNION ALL SELECT 'run-1', 'notes', 80000""")
def audit_upsert(t: Tables):
    trail = _audit(t, insert=True)
    notes = trail["notes"].select("run_id", F.lit("notes").alias("part"), F.length("notes").cast("bigint").alias("n"))
    return trail["upload"].groupBy("run_id", F.lit("sent").alias("part")).agg(F.count(F.lit(1)).alias("n")).unionByName(notes)


@query("snapshot_watermark", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) > (SELECT max(o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24)) FROM orders WHERE year(o_orderdate) <= 1997 AND o_orderkey % 24 < 12)""")
def snapshot_watermark(t: Tables):
    """Captures by the hour: later ones on the watermark's day are picked up."""
    captures = t.orders.withColumn("taken", F.timestamp_seconds(F.unix_timestamp("o_orderdate") + F.col("o_orderkey") % 24 * 3600))
    loaded = captures.where((F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")) & (F.col("o_orderkey") % 24 < 12))
    mark = changes.watermark(loaded, "taken")
    return changes.after_watermark(captures, "taken", mark).select("o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("json_flatten", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_flatten(t: Tables):
    parsed = reshape.parse_json(t.events, "props", T.StructType.fromDDL("k BIGINT"))
    return schema.flatten(reshape.readable(parsed, "props").select("event_id", "doc")).withColumnRenamed("doc.k", "k")


@query("json_quarantine", """
SELECT event_id, CASE WHEN event_type = 'error' THEN substring(props, 1, 4) ELSE props END AS props, event_type = 'error' AS bad FROM events""")
def json_quarantine(t: Tables):
    cut = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props"))
    e = t.events.select("event_id", cut.alias("props"))
    parsed = reshape.parse_json(e, "props", T.StructType.fromDDL("k BIGINT"))
    good, bad = reshape.readable(parsed, "props"), reshape.unreadable(parsed, "props")
    return schema.union_fill(good.select("event_id", "props", F.lit(False).alias("bad")), bad.select("event_id", "props", F.lit(True).alias("bad")))


ODD_DOCUMENTS = """
WITH d AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '{"VOIDED":' || user_id || ',"a.AVOID":"OBJECT<x>"}' WHEN 1 THEN '[{"VOIDED":1}]' WHEN 2 THEN '7'
           WHEN 3 THEN ' {"OBJECT<":{"VOID":null,"n":[' || event_id || ']}}' WHEN 4 THEN '{"VOID' ELSE '"VOIDED"' END AS doc FROM events)"""


def odd_documents(t: Tables):
    """Objects whose names look like types, beside lists, bare values and broken texts."""
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    kinds = [
        F.concat(F.lit('{"VOIDED":'), user, F.lit(',"a.AVOID":"OBJECT<x>"}')), F.lit('[{"VOIDED":1}]'), F.lit("7"),
        F.concat(F.lit(' {"OBJECT<":{"VOID":null,"n":['), event, F.lit("]}}")), F.lit('{"VOID'), F.lit('"VOIDED"'),
    ]
    return t.events.select("event_id", F.element_at(F.array(*kinds), (F.col("event_id") % 6 + 1).cast("int")).alias("doc_text"))


@query("json_schema_names", ODD_DOCUMENTS + """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(json_extract_string(doc, '$.VOIDED') AS BIGINT) END AS voided, CASE event_id % 6 WHEN 0 THEN 'OBJECT<x>' END AS dotted,
       CASE event_id % 6 WHEN 3 THEN event_id END AS nested FROM d WHERE event_id % 6 IN (0, 3)""")
def json_schema_names(t: Tables):
    docs = odd_documents(t)
    parsed = reshape.readable(reshape.parse_json(docs, "doc_text", reshape.json_schema(docs, "doc_text")), "doc_text")
    doc = F.col("doc")
    return parsed.select("event_id", doc["VOIDED"].alias("voided"), doc["a.AVOID"].alias("dotted"), F.try_element_at(doc["OBJECT<"]["n"], F.lit(1)).alias("nested"))


@query("json_unreadable", ODD_DOCUMENTS + " SELECT event_id FROM d WHERE event_id % 6 NOT IN (0, 3)")
def json_unreadable(t: Tables):
    docs = odd_documents(t)
    return reshape.unreadable(reshape.parse_json(docs, "doc_text", reshape.json_schema(docs, "doc_text")), "doc_text").select("event_id")


@query("json_fields", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, NULL::VARCHAR AS missing FROM events""")
def json_fields(t: Tables):
    return reshape.json_fields(t.events.select("event_id", "props"), "props", {"k": "BIGINT", "missing": "STRING"}).drop("props")


@query("nested_to_text", """
SELECT c_name AS name, c_custkey AS label, '[' || c_nationkey || ',' || c_custkey || ']' AS _keys, '{"a":' || c_nationkey || '}' AS _pair FROM customer""")
def nested_to_text(t: Tables):
    c = t.customer.select(
        F.array("c_nationkey", "c_custkey").alias("keys"), F.col("c_custkey").alias("label"), F.struct(F.col("c_nationkey").alias("a")).alias("pair"),
        F.col("c_name").alias("name"),
    )
    return schema.nested_to_json(c, first=("name", "label"))


@query("unpivot_months", """
SELECT o_custkey, year(o_orderdate)::INTEGER AS "year", m AS month_no, make_date(year(o_orderdate)::INTEGER, m, 1) AS month, count(*) FILTER (month(o_orderdate) = m)::BIGINT AS n
FROM orders, (SELECT unnest(range(1, 13))::INTEGER AS m) GROUP BY ALL""")
def unpivot_months(t: Tables):
    names = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m"))
    wide = o.groupBy("o_custkey", "year").agg(*[F.count(F.when(F.col("m") == i, 1)).alias(f"data.{n}") for i, n in enumerate(names, 1)])
    long = reshape.unpivot_prefix(wide, "data.", "name", "n").withColumn("month", month_start("name", "year"))
    return long.select("o_custkey", "year", F.month("month").alias("month_no"), "month", "n")


@query("unpivot_all_but", """
SELECT c_custkey, k AS name, CASE k WHEN 'c_acctbal' THEN c_acctbal WHEN 'double' THEN c_acctbal * 2 ELSE NULL END AS value
FROM customer, (VALUES ('c_acctbal'), ('double'), ('none')) v(k)""")
def unpivot_all_but(t: Tables):
    c = t.customer.select("c_custkey", "c_acctbal", (F.col("c_acctbal") * 2).alias("double"), F.lit(None).cast("double").alias("none"))
    return reshape.unpivot_except(c, ["c_custkey"], "name", "value")


@query("select_and_drop", """
SELECT s_name AS supplier, s_suppkey FROM supplier""")
def select_and_drop(t: Tables):
    s = schema.drop_matching(t.supplier, r"nation|bal$")
    return schema.first_columns(schema.rename(s, {"s_name": "supplier"}), "supplier")


@query("table_scope", """
SELECT p_partkey AS table_id, p_name || '_sanitized' AS table_name, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (p_partkey % 100) AS creation_time FROM part WHERE regexp_matches(p_name, '^[a-h].*')""")
def table_scope(t: Tables):
    day = F.timestamp_millis(to_millis(F.lit("2024-01-01").cast("timestamp")) + F.col("p_partkey") % 100 * 86400000)
    listed = t.part.select(F.col("p_partkey").alias("table_id"), F.concat("p_name", F.lit("_sanitized")).alias("table_name"), day.alias("creation_time"))
    return catalog.tables_matching(listed, "^[a-h].*sanitized")


@query("freshness", """
SELECT n_nationkey FROM nation WHERE (SELECT max(ts) FROM events WHERE event_type = 'click') > TIMESTAMP '2024-01-20' AND contains(n_name, '_1')""")
def freshness(t: Tables):
    meta = t.events.select(F.col("event_type").alias("table_id"), to_millis("ts").alias("last_modified_time"))
    modified = catalog.last_modified(meta, "click")
    due = catalog.due(F.col("n_name"), modified, dt.date(2024, 1, 27), short=("NATION_1",), mark="_1")
    return t.nation.where(due).select("n_nationkey")


@query("field_catalog", """
WITH cols(name, type) AS (VALUES ('c_custkey','bigint'),('c_name','string'),('c_nationkey','int'),('c_acctbal','double'),('c_mktsegment','string'))
SELECT name, replace(name, '_', ' ') AS label, type, true AS nullable, '{"segments":["AUTOMOBILE","BUILDING","FURNITURE","HOUSEHOLD","MACHINERY"]}' AS "_picklistValues"
FROM cols WHERE (SELECT count(*) FROM customer) > 0""")
def field_catalog(t: Tables):
    values = listed(t.customer.select("c_mktsegment"))
    described = catalog.describe(t.customer).withColumn("picklistValues", F.struct(values.alias("segments")))
    return field_catalog_run({"customer": described})["customer"]
