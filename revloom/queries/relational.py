"""Joins, aggregations, windows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.functions.numbers import null_subtract, per_rate, sum_where
from revloom.operators import aggregates, joins, scan, schema, windows
from revloom.plans.forecast import cumulative_fit
from revloom.queries.registry import Tables, query


@query("missing_lines", """
SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def missing_lines(t: Tables):
    return joins.absent_from(t.orders.select("o_orderkey", "o_totalprice"), t.lineitem, [("o_orderkey", "l_orderkey")])


@query("semi_lines", """
SELECT o_orderkey, o_totalprice FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def semi_lines(t: Tables):
    return joins.present_in(t.orders.select("o_orderkey", "o_totalprice"), t.lineitem, [("o_orderkey", "l_orderkey")])


@query("null_safe_anti", """
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS k FROM orders),
b AS (SELECT DISTINCT user_id AS k FROM events UNION ALL SELECT NULL)
SELECT o_orderkey, k FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k IS NOT DISTINCT FROM a.k)""")
def null_safe_anti(t: Tables):
    a = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    b = t.events.select(F.col("user_id").alias("k")).union(t.region.select(F.lit(None).cast("bigint"))).distinct()
    return joins.absent_from(a, b, ["k"])


@query("inner_chain", """
SELECT r_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def inner_chain(t: Tables):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    o = o.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return o.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("left_with_condition", """
SELECT n_name, count(c_custkey) AS customers, count(*) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING'
AND n_regionkey = 1 GROUP BY n_name""")
def left_with_condition(t: Tables):
    on = (F.col("c_nationkey") == F.col("n_nationkey")) & (F.col("c_mktsegment") == "BUILDING") & (F.col("n_regionkey") == 1)
    return t.nation.join(t.customer, on, "left").groupBy("n_name").agg(F.count("c_custkey").alias("customers"), F.count(F.lit(1)).alias("n"))


@query("full_outer_totals", """
WITH a AS (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
b AS (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS partial FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, open, partial, round(coalesce(open, 0) - coalesce(partial, 0), 2) AS diff FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_totals(t: Tables):
    def total(status, name):
        o = t.orders.where(F.col("o_orderstatus") == status)
        return o.groupBy(F.col("o_custkey").alias("k")).agg(F.round(F.sum("o_totalprice"), 2).alias(name))

    both = total("O", "open").join(total("P", "partial"), "k", "full")
    return both.withColumn("diff", F.round(null_subtract("open", "partial"), 2))


@query("currency_normalise", """
WITH rates AS (SELECT n_nationkey AS iso, CASE WHEN n_nationkey = 3 THEN 0.0 ELSE 0.5 + n_nationkey / 8.0 END AS rate FROM nation WHERE n_name <> 'NATION_7')
SELECT o_orderkey, round(CASE WHEN rate = 0 THEN NULL ELSE o_totalprice / rate END, 4) AS usd,
       CASE WHEN rate = 0 THEN NULL ELSE round(o_totalprice / rate) END AS whole
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN rates ON iso = c_nationkey""")
def currency_normalise(t: Tables):
    rate = F.when(F.col("n_nationkey") == 3, 0.0).otherwise(0.5 + F.col("n_nationkey") / 8.0)
    rates = t.nation.where("n_name <> 'NATION_7'").select(F.col("n_nationkey").alias("iso"), rate.alias("rate"))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    o = joins.left_lookup(o, rates, [("c_nationkey", "iso")], {"rate": "rate"})
    usd = per_rate("o_totalprice", "rate")
    return o.select("o_orderkey", F.round(usd, 4).alias("usd"), F.round(usd).alias("whole"))


@query("currency_twins", """
SELECT c_custkey, c_acctbal, c_mktsegment, round(c_acctbal / (1 + c_nationkey), 6) AS acctbal_x FROM customer""")
def currency_twins(t: Tables):
    c = t.customer.withColumn("rate", 1 + F.col("c_nationkey"))
    out = schema.converted_currency(c, [("c_acctbal", "currency"), ("c_mktsegment", "string")], "rate")
    return out.select("c_custkey", "c_acctbal", "c_mktsegment", F.round("c_acctbal_Converted", 6).alias("acctbal_x"))


@query("ever_flag", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS ever_urgent FROM customer""")
def ever_flag(t: Tables):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return joins.with_presence(t.customer.select("c_custkey"), urgent, ("c_custkey", "o_custkey"), "ever_urgent")


@query("delete_by_subquery", """
SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""")
def delete_by_subquery(t: Tables):
    gone = t.nation.where("n_regionkey = 2")
    return joins.absent_from(t.supplier, gone, [("s_nationkey", "n_nationkey")]).select("s_suppkey", "s_name")


@query("update_from_chain", """
WITH latest AS (SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1)
SELECT c_custkey, CASE WHEN o_orderkey IS NOT NULL AND c_acctbal > 0 THEN o_totalprice ELSE c_acctbal END AS amount,
       CASE WHEN o_orderkey IS NOT NULL AND c_acctbal > 0 THEN o_orderpriority ELSE 'none' END AS label, n_name AS nation
FROM customer LEFT JOIN latest ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def update_from_chain(t: Tables):
    c = t.customer.select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("amount"), F.lit("none").alias("label"), F.lit("?").alias("nation"))
    filled = t.orders.where(F.col("o_orderstatus") == "F")
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    c = joins.update_from(c, filled, [("c_custkey", "o_custkey")], {"amount": "o_totalprice", "label": "o_orderpriority"}, order, only=F.col("amount") > 0)
    c = joins.update_from(c, t.nation, [("c_nationkey", "n_nationkey")], {"nation": "n_name"}, [F.col("n_name")])
    return c.select("c_custkey", "amount", "label", "nation")


@query("related_deal_interval", """
WITH x AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderstatus FROM orders),
m AS (SELECT a.o_orderkey, b.o_orderkey AS nxt, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.d, b.o_orderkey) AS rn
      FROM x a JOIN x b ON a.o_custkey = b.o_custkey AND b.o_orderstatus = 'F' AND b.d > a.d AND b.d < a.d + INTERVAL 12 MONTH)
SELECT x.o_orderkey, m.nxt AS next_order FROM x LEFT JOIN m ON m.o_orderkey = x.o_orderkey AND rn = 1""")
def related_deal_interval(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    filled = t.orders.where(F.col("o_orderstatus") == "F")
    return joins.next_within(o, filled, "o_custkey", "d", "o_orderdate", "o_orderkey", 12, "next_order").select("o_orderkey", "next_order")


@query("id_map_full_outer", """
WITH ac AS (SELECT CAST(o_custkey AS VARCHAR) AS id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END AS account FROM orders WHERE o_orderstatus <> 'F'),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS account FROM customer WHERE c_mktsegment <> 'BUILDING'),
u AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, event_type AS account FROM events
      UNION ALL SELECT CAST(s_suppkey + 1000000 AS VARCHAR), s_name FROM supplier)
SELECT DISTINCT coalesce(CASE WHEN ac.id IN ('5','7') THEN NULL ELSE ac.id END, c.id, u.id) AS id,
       coalesce(CASE WHEN ac.account IN ('P') THEN NULL ELSE ac.account END, c.account, u.account) AS account
FROM ac FULL JOIN c ON ac.id = c.id FULL JOIN u ON u.id = c.id WHERE coalesce(ac.id, c.id, u.id) IS NOT NULL""")
def id_map_full_outer(t: Tables):
    o, c = t.orders.where("o_orderstatus <> 'F'"), t.customer.where("c_mktsegment <> 'BUILDING'")
    ac = o.select(F.col("o_custkey").cast("string").alias("id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("account"))
    cu = c.select(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("account"))
    u = t.events.select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("account")).distinct()
    u = u.union(t.supplier.select((F.col("s_suppkey") + 1000000).cast("string"), "s_name"))
    return joins.id_account_map(ac, cu, u, bad_ids=["5", "7"], bad_accounts=["P"])


@query("tier_lookup", """
WITH tiers AS (SELECT DISTINCT CAST(100 + 40 * n_nationkey AS DOUBLE) AS up_to FROM nation),
spend AS (SELECT o_custkey, CAST(count(*) * 37 + max(CASE WHEN o_custkey = 4 THEN NULL ELSE 0 END) AS DOUBLE) AS v FROM orders GROUP BY 1)
SELECT o_custkey, v, coalesce((SELECT max(up_to) FROM tiers WHERE up_to <= v), (SELECT min(up_to) FROM tiers)) AS up_to FROM spend""")
def tier_lookup(t: Tables):
    tiers = t.nation.select((100.0 + 40.0 * F.col("n_nationkey")).alias("up_to")).distinct()
    gap = F.max(F.when(F.col("o_custkey") != 4, 0))
    spend = t.orders.groupBy("o_custkey").agg((F.count(F.lit(1)) * 37 + gap).cast("double").alias("v"))
    return joins.floor_tier(spend, tiers, "v", "up_to")


@query("tier_lookup_split", """
WITH tiers AS (SELECT DISTINCT p_retailprice * p_size AS up_to FROM part),
x AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, coalesce(up_to, (SELECT min(up_to) FROM tiers)) AS up_to
FROM x ASOF LEFT JOIN tiers ON l_extendedprice >= up_to""")
def tier_lookup_split(t: Tables):
    tiers = t.part.select((F.col("p_retailprice") * F.col("p_size")).alias("up_to")).distinct()
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return joins.floor_tier(lines, tiers, "l_extendedprice", "up_to")


@query("tier_lookup_wide", """
WITH tiers AS (SELECT DISTINCT 9007199254740992 + p_partkey * 3 AS up_to FROM part),
x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 9007199254740991 + o_orderkey END AS v FROM orders)
SELECT o_orderkey, v, coalesce(up_to, (SELECT min(up_to) FROM tiers)) AS up_to FROM x ASOF LEFT JOIN tiers ON v >= up_to""")
def tier_lookup_wide(t: Tables):
    """Whole numbers that doubles cannot tell apart."""
    tiers = t.part.select((F.lit(9007199254740992) + F.col("p_partkey") * 3).alias("up_to")).distinct()
    values = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.lit(9007199254740991) + F.col("o_orderkey")).alias("v"))
    return joins.floor_tier(values, tiers, "v", "up_to")


@query("tier_lookup_listed", """
WITH tiers AS (SELECT CAST(100 + 40 * n_nationkey AS DOUBLE) AS up_to, n_regionkey AS region, n_name AS name FROM nation),
spend AS (SELECT o_custkey, CAST(count(*) * 37 + max(CASE WHEN o_custkey = 4 THEN NULL ELSE 0 END) AS DOUBLE) AS v FROM orders GROUP BY 1),
x AS (SELECT o_custkey, v, coalesce((SELECT max(up_to) FROM tiers WHERE up_to <= v), (SELECT min(up_to) FROM tiers)) AS up_to FROM spend)
SELECT o_custkey, v, up_to, region, name FROM x JOIN tiers USING (up_to)""")
def tier_lookup_listed(t: Tables):
    tiers = t.nation.select((100.0 + 40.0 * F.col("n_nationkey")).alias("up_to"), F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"))
    gap = F.max(F.when(F.col("o_custkey") != 4, 0))
    spend = t.orders.groupBy("o_custkey").agg((F.count(F.lit(1)) * 37 + gap).cast("double").alias("v"))
    return joins.floor_listed(spend, tiers, "v", "up_to", "region", "tier").select("o_custkey", "v", "tier.*")


@query("running_orders", """
SELECT o_orderkey, o_custkey, sum(o_orderkey % 50) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)::BIGINT AS running,
       row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders""")
def running_orders(t: Tables):
    """Running sums of five long series, and a number for every row of the table."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", (F.col("o_orderkey") % 50).alias("v"))
    out = scan.running_sum(o, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "v", "running").withColumn("back", -F.unix_date(F.to_date("o_orderdate")))
    return scan.numbered(out, ["back", "o_orderkey"], "place").select("o_orderkey", "o_custkey", "running", "place")


@query("coverage_spine", """
WITH spine AS (SELECT c_custkey, p.o_orderpriority, y.y FROM customer, (SELECT DISTINCT o_orderpriority FROM orders) p,
               (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) y)
SELECT c_custkey, o_orderpriority, y AS "year" FROM spine s WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = s.c_custkey
AND o.o_orderpriority = s.o_orderpriority AND year(o.o_orderdate) = s.y)""")
def coverage_spine(t: Tables):
    o = t.orders.select("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    lists = {c: o.select(c) for c in ("o_orderpriority", "year")}
    return joins.missing_combinations(t.customer.select("c_custkey"), ["c_custkey"], o, [("c_custkey", "o_custkey")], lists)


@query("zone_lookup", """
WITH z AS (SELECT o_custkey AS id, min(o_orderpriority) AS zone FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT event_id, coalesce(zone, 'UTC') AS zone FROM events LEFT JOIN z ON z.id = user_id""")
def zone_lookup(t: Tables):
    z = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("zone"))
    return joins.lookup_or_default(t.events.select("event_id", "user_id"), z, "user_id", "zone", "UTC").select("event_id", "zone")


@query("yearly_rate", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n, sum(value) AS v FROM events WHERE value > 10 GROUP BY 1, 2)
SELECT user_id, round(avg(n) * 365) AS per_year, count(DISTINCT d) AS days FROM d GROUP BY 1""")
def yearly_rate(t: Tables):
    e = t.events.where("value > 10").select("user_id", F.to_date("ts").alias("d"), F.lit(1).alias("n"))
    mean = aggregates.mean_of_sums(e, ["user_id"], ["d"], "n", "mean")
    days = e.groupBy("user_id").agg(F.count_distinct("d").alias("days"))
    return mean.join(days, "user_id").select("user_id", F.round(F.col("mean") * 365).alias("per_year"), "days")


@query("null_group_sums", """
SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag, round(sum(l_extendedprice), 2) AS total,
       round(coalesce(sum(CASE WHEN l_linestatus = 'X' THEN l_tax END), 0), 2)::DOUBLE AS none, min(l_quantity) AS lo, max(l_quantity) AS hi
FROM lineitem GROUP BY 1""")
def null_group_sums(t: Tables):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return t.lineitem.groupBy(flag.alias("flag")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total"), sum_where("l_tax", F.col("l_linestatus") == "X").cast("double").alias("none"),
        F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"),
    )


@query("sum_by_key", """
SELECT l_suppkey, coalesce(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END), 0)::BIGINT AS quantity FROM lineitem GROUP BY 1""")
def sum_by_key(t: Tables):
    lines = t.lineitem.select("l_suppkey", F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("bigint")).alias("quantity"))
    return aggregates.sum_per(lines, ["l_suppkey"], "quantity")


#: Bytes of a part of the joined texts: small, so that groups have several.
CHUNK_BYTES = 32
#: Parts of a text by the byte at which a value begins.
PARTS = f"""starts AS (SELECT *, sum(octet_length(encode(v)) + 1) OVER (PARTITION BY k ORDER BY v ROWS UNBOUNDED PRECEDING) - octet_length(encode(v)) - 1 AS start FROM held),
parts AS (SELECT k, CAST(start // {CHUNK_BYTES} AS BIGINT) AS part, string_agg(v, ',' ORDER BY v) AS t FROM starts GROUP BY ALL),
every AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)"""


@query("joined_ids", f"""
WITH held AS (SELECT o_custkey AS k, CAST(o_orderkey AS VARCHAR) AS v FROM orders WHERE o_orderstatus <> 'P'), {PARTS}
SELECT k AS o_custkey, coalesce(part, 0) AS part, t AS ids, n AS count FROM every LEFT JOIN parts USING (k)""")
def joined_ids(t: Tables):
    o = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("id"))
    return aggregates.joined_text(o, ["o_custkey"], "id", "ids", chunk_bytes=CHUNK_BYTES)


@query("joined_repeated", f"""
WITH held AS (SELECT o_custkey % 7 AS k, o_orderpriority AS v FROM orders),
starts AS (SELECT *, sum(octet_length(encode(v)) + 1) OVER (PARTITION BY k ORDER BY v ROWS UNBOUNDED PRECEDING) - octet_length(encode(v)) - 1 AS start FROM held)
SELECT k AS "key", CAST(start // 4096 AS BIGINT) AS part, string_agg(v, ',' ORDER BY v) AS priorities, any_value(n) AS count
FROM starts JOIN (SELECT o_custkey % 7 AS k, count(*) AS n FROM orders GROUP BY 1) USING (k) GROUP BY 1, 2""")
def joined_repeated(t: Tables):
    """Few values with many copies each, split over parts."""
    o = t.orders.select((F.col("o_custkey") % 7).alias("key"), "o_orderpriority")
    return aggregates.joined_text(o.withColumnRenamed("o_orderpriority", "p"), ["key"], "p", "priorities", chunk_bytes=4096)


@query("joined_unique", f"""
WITH held AS (SELECT DISTINCT o_custkey AS k, o_orderpriority AS v FROM orders), {PARTS}
SELECT k AS o_custkey, part, t AS priorities, n AS count FROM every JOIN parts USING (k)""")
def joined_unique(t: Tables):
    o = t.orders.select("o_custkey", "o_orderpriority")
    return aggregates.joined_text(o, ["o_custkey"], "o_orderpriority", "priorities", unique=True, chunk_bytes=CHUNK_BYTES)


@query("pivot_months", """
SELECT l_returnflag, round(sum(CASE WHEN year(l_shipdate) = 1996 THEN l_quantity END), 2) AS "1996", round(sum(CASE WHEN year(l_shipdate) = 1997 THEN l_quantity END), 2) AS "1997",
round(sum(CASE WHEN year(l_shipdate) = 1998 THEN l_quantity END), 2) AS "1998" FROM lineitem GROUP BY 1""")
def pivot_months(t: Tables):
    lines = t.lineitem.select("l_returnflag", F.year("l_shipdate").alias("y"), "l_quantity")
    return aggregates.pivot_sum(lines, ["l_returnflag"], "y", [1996, 1997, 1998], "l_quantity")


@query("latest_order_per_customer", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def latest_order_per_customer(t: Tables):
    return windows.latest_per_key(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("with_key_max", """
SELECT event_id, user_id, epoch_us(max(ts) OVER (PARTITION BY user_id)) AS last_us FROM events""")
def with_key_max(t: Tables):
    out = windows.with_key_max(t.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", "last")
    return out.select("event_id", "user_id", F.unix_micros("last").alias("last_us"))


@query("dedupe_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_first(t: Tables):
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    kept = windows.first_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("usage_change_trailing", """
WITH x AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 100 AS v FROM orders),
l AS (SELECT o_custkey, max(d) AS last FROM x GROUP BY 1),
s AS (SELECT o_custkey, last, coalesce(sum(v) FILTER (d >= last - 731 AND d < last - 366), 0)::BIGINT AS earlier_usage,
      coalesce(sum(v) FILTER (d >= last - 366 AND d < last), 0)::BIGINT AS recent_usage FROM x JOIN l USING (o_custkey) GROUP BY 1, 2)
SELECT o_custkey, earlier_usage, recent_usage, last AS last_submission,
       CASE WHEN earlier_usage = 0 AND recent_usage = 0 THEN 0 WHEN earlier_usage = 0 THEN 100
            ELSE round_even(round(100.0 * (recent_usage - earlier_usage) / earlier_usage, 9), 0) END::DOUBLE AS upload_change FROM s""")
def usage_change_trailing(t: Tables):
    o = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d"), (F.col("o_orderkey") % 100).alias("v"))
    return windows.usage_change(o, "o_custkey", "d", "v", recent=365, earlier=730).drop("pct_change")


@query("series_differences", """
SELECT event_id, round(value - lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 4) AS diff FROM events""")
def series_differences(t: Tables):
    e = t.events.select("event_id", "event_type", "ts", "value")
    out = windows.lag_difference(e, ["event_type"], ["ts", "event_id"], {"diff": "value"})
    return out.select("event_id", F.round("diff", 4).alias("diff"))


@query("running_fit", """
WITH d AS (SELECT o_orderpriority AS p, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(o_orderdate AS DATE) AS d, sum(o_orderkey % 50)::BIGINT AS v FROM orders GROUP BY ALL),
r AS (SELECT p, y, d, sum(v) OVER (PARTITION BY p, y ORDER BY d)::BIGINT AS running FROM d),
f AS (SELECT p, y, regr_slope(running, d - DATE '1970-01-01') AS s, regr_intercept(running, d - DATE '1970-01-01') AS i FROM r GROUP BY ALL),
spine AS (SELECT p, y, CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM f)
SELECT p AS priority, y AS "year", d, running, round(i + s * (d - DATE '1970-01-01'), 2) + 0.0 AS predicted, round(running - (i + s * (d - DATE '1970-01-01')), 2) + 0.0 AS diff
FROM spine LEFT JOIN r USING (p, y, d) JOIN f USING (p, y)""")
def running_fit(t: Tables):
    o = t.orders.select(
        F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year"), F.to_date("o_orderdate").alias("d"), (F.col("o_orderkey") % 50).alias("v")
    )
    out = cumulative_fit(o, ["priority", "year"], "d", "v")
    return out.withColumns({"predicted": F.round("predicted", 2) + 0.0, "diff": F.round("diff", 2) + 0.0})


@query("union_fill_distinct", """
SELECT c_nationkey AS nation, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION
SELECT s_nationkey, NULL, s_acctbal FROM supplier""")
def union_fill_distinct(t: Tables):
    c = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return schema.union_distinct(c, s)


@query("ordered_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def ordered_orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last())


@query("conditional_assignment", """
SELECT o_orderkey, CASE WHEN o_orderkey = 5 THEN 'fixed' WHEN o_totalprice > 300000 THEN 'BIG' ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderkey = 5 THEN 0.0 ELSE o_totalprice END AS price, NULL::VARCHAR AS note, 'RO' AS product FROM orders""")
def conditional_assignment(t: Tables):
    o = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"))
    o = schema.assign_where(o, "priority", F.col("price") > 300000, "BIG")
    o = schema.override_by_id(o, "o_orderkey", {5: {"priority": "fixed", "price": 0.0}})
    return schema.constants(schema.typed_nulls(o, {"note": "string"}), {"product": "RO"})
