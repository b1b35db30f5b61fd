"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.functions import dates, keys, numbers, text
from revloom.operators import dims, joins
from revloom.operators.schema import clean_names, prettify
from revloom.queries.registry import Tables, query


@query("scrub_currency", """
WITH x AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 'USD ' WHEN 'O' THEN 'EUR ' ELSE '' END
         || CASE WHEN o_orderpriority = '1-URGENT' THEN '-' ELSE '' END || format('{:,.2f}', o_totalprice) AS t
  FROM orders)
SELECT o_orderkey, t AS amount_text,
       CASE WHEN contains(t, '-') OR t LIKE 'EUR%' THEN NULL ELSE CAST(replace(replace(t, 'USD ', ''), ',', '') AS DOUBLE) END AS usd,
       CASE WHEN contains(t, '-') THEN NULL ELSE CAST(regexp_replace(t, '(USD |EUR |,)', '', 'g') AS DOUBLE) END AS any_currency
FROM x""")
def scrub_currency(t: Tables):
    o = t.orders
    code = F.when(F.col("o_orderstatus") == "F", "USD ").when(F.col("o_orderstatus") == "O", "EUR ").otherwise("")
    sign = F.when(F.col("o_orderpriority") == "1-URGENT", "-").otherwise("")
    o = o.withColumn("amount_text", F.concat(code, sign, F.format_number("o_totalprice", 2)))
    return o.select(
        "o_orderkey", "amount_text", numbers.scrub_usd("amount_text").alias("usd"),
        numbers.scrub_currency("amount_text", ["USD", "EUR", "GBP"]).alias("any_currency"),
    )


@query("format_money", """
SELECT c_custkey, '$' || format('{:,.2f}', c_acctbal) AS balance, '$' || format('{:,.0f}', c_custkey * 1000.0) AS whole FROM customer""")
def format_money(t: Tables):
    return t.customer.select(
        "c_custkey", numbers.format_money("c_acctbal").alias("balance"), numbers.format_money(F.col("c_custkey") * 1000.0, 0).alias("whole")
    )


@query("clean_names", """
SELECT o_orderkey AS order_key, o_orderstatus AS orders_status, o_custkey AS customer_é_2, o_totalprice * 2 AS x_pct FROM orders""")
def clean_names_(t: Tables):
    odd = t.orders.select(
        F.col("o_orderkey").alias("order.key"), F.col("o_orderstatus").alias("order's status"), F.col("o_custkey").alias("customer é.2"),
        (F.col("o_totalprice") * 2).alias("x.pct%"),
    )
    return clean_names(odd)


@query("pretty_names", """
SELECT c_custkey AS "c custkey", c_name AS "Customer", c_mktsegment AS "c mktsegment" FROM customer""")
def pretty_names(t: Tables):
    return prettify(t.customer.select("c_custkey", "c_name", "c_mktsegment"), {"c name": "Customer"})


@query("clean_name_text", r"""
SELECT page_id, regexp_replace(replace(replace(url, '.', '_'), ' ', '_'), '[^\p{L}\p{N}_]', '', 'g') AS name,
       replace(url, 'https://', '') AS bare
FROM pages""")
def clean_name_text(t: Tables):
    return t.pages.select("page_id", text.clean_name_text("url").alias("name"), text.strip_prefix("url", "https://").alias("bare"))


@query("links", """
SELECT c_custkey, 'https://crm.example/r/Account/' || c_custkey || '/view' AS link,
       '=HYPERLINK("https://crm.example/r/Account/' || c_custkey || '/view","' || c_name || '")' AS formula
FROM customer""")
def links(t: Tables):
    url = text.record_link("https://crm.example/r/", "Account", F.col("c_custkey").cast("string"))
    return t.customer.select("c_custkey", url.alias("link"), text.hyperlink(url, "c_name").alias("formula"))


@query("truncate_text", """
SELECT doc_id, md5(CASE WHEN length(text) > 4990 THEN substring(text, 1, 4987) || '...' ELSE text END) AS cut_md5,
       CAST(least(length(text), 4990) AS INTEGER) AS cut_length, md5(substring(text, 1, 49999)) AS notes_md5
FROM documents""")
def truncate_text(t: Tables):
    cut = text.truncate("text", text.FIELD_TEXT_LIMIT)
    return t.documents.select(
        "doc_id", F.md5(cut.cast("binary")).alias("cut_md5"), F.length(cut).alias("cut_length"),
        F.md5(text.trim_notes("text").cast("binary")).alias("notes_md5"),
    )


@query("uuid_in_text", r"""
WITH x AS (SELECT doc_id, md5(text) AS h, source, lang FROM documents),
u AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'none ' || h ELSE source || '-' || substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-'
      || substring(h, 13, 4) || '-' || substring(h, 17, 4) || '-' || substring(h, 21, 12) || ' tail' END AS t FROM x)
SELECT doc_id, nullif(regexp_extract(t, '([A-Fa-f0-9]{8}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{4}-[A-Fa-f0-9]{12})', 1), '') AS uuid FROM u""")
def uuid_in_text(t: Tables):
    h = F.md5(F.col("text").cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    with_id = F.concat_ws("-", "source", F.concat(F.concat_ws("-", *parts), F.lit(" tail")))
    made = F.when(F.col("lang") == "de", F.concat(F.lit("none "), h)).otherwise(with_id)
    return t.documents.select("doc_id", text.uuid_in(made).alias("uuid"))


@query("id_hygiene", """
WITH x AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'o''neil' WHEN 'MACHINERY' THEN 'a b' WHEN 'FURNITURE' THEN 'x/r2w/y'
  WHEN 'HOUSEHOLD' THEN NULL ELSE c_name END AS id FROM customer)
SELECT c_custkey, id IS NOT NULL AND NOT contains(id, '''') AND NOT contains(id, ' ') AND NOT contains(id, '/r2w/') AS clean,
       length(id) = 18 AS record_id FROM x""")
def id_hygiene(t: Tables):
    made = {"BUILDING": "o'neil", "MACHINERY": "a b", "FURNITURE": "x/r2w/y", "HOUSEHOLD": None}
    portal = F.col("c_name")
    for segment, value in made.items():
        portal = F.when(F.col("c_mktsegment") == segment, F.lit(value)).otherwise(portal)
    c = t.customer.withColumn("id", portal)
    return c.select("c_custkey", text.is_clean_id("id").alias("clean"), text.is_record_id("id").alias("record_id"))


@query("tags", """
WITH x AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'Alpha;Beta;Gamma'
  WHEN c_mktsegment = 'FURNITURE' THEN 'Beta' ELSE 'Beta;' || c_mktsegment END AS tags FROM customer)
SELECT c_custkey, CASE WHEN tags IS NULL THEN 'Beta' ELSE tags || ';Beta' END AS added,
       replace(replace(tags, ';Beta', ''), 'Beta', '') AS removed,
       CASE WHEN tags IS NULL THEN NULL ELSE nullif(array_to_string(list_filter(string_split(tags, ';'), lambda e: e <> 'Beta'), ';'), '') END AS removed_exact
FROM x""")
def tags(t: Tables):
    seg = F.col("c_mktsegment")
    made = (
        F.when(seg == "BUILDING", None).when(seg == "MACHINERY", "Alpha;Beta;Gamma").when(seg == "FURNITURE", "Beta")
        .otherwise(F.concat(F.lit("Beta;"), seg))
    )
    return t.customer.withColumn("tags", made).select(
        "c_custkey", text.add_tag("tags", "Beta").alias("added"), text.remove_tag("tags", "Beta").alias("removed"),
        text.remove_tag_exact("tags", "Beta").alias("removed_exact"),
    )


@query("date_parts", """
WITH x AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(o_orderkey % 14 AS INTEGER) AS m,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey % 33 AS INTEGER) END AS d FROM orders)
SELECT o_orderkey, TRY_CAST(printf('%04d-%02d-%02d', y, m, d) AS DATE) AS made FROM x""")
def date_parts(t: Tables):
    parts = F.struct(
        F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 14).alias("month"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey") % 33).alias("dayOfMonth"),
    )
    return t.orders.select("o_orderkey", parts.alias("p")).select("o_orderkey", dates.date_from_parts("p").alias("made"))


@query("calendar", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) >= DATE '1997-06-01' - INTERVAL 36 MONTH AND CAST(o_orderdate AS DATE) <= DATE '1997-06-15' AS started,
       CAST(o_orderdate AS DATE) <= DATE '1997-06-15' AND CAST(o_orderdate AS DATE) + 90 > DATE '1997-06-15' AS active,
       round(year(o_orderdate) + quarter(o_orderdate) / 10.0, 1)::DOUBLE AS quarter,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS month
FROM orders""")
def calendar(t: Tables):
    d = F.to_date("o_orderdate")
    name = F.when(F.col("o_orderstatus") == "P", "Foo").otherwise(F.date_format("o_orderdate", "MMM"))
    return t.orders.select(
        "o_orderkey", ((d >= dates.month_floor_years_before("1997-06-15", 3)) & (d <= dates.day("1997-06-15"))).alias("started"),
        dates.active_on(d, F.date_add(d, 90), "1997-06-15").alias("active"), dates.quarter_with_year(d).cast("double").alias("quarter"),
        dates.month_start(name, F.year("o_orderdate")).alias("month"),
    )


@query("epochs", """
SELECT event_id, epoch_us(ts) // 1000 AS millis, epoch_us(ts) // 1000000 AS seconds,
       CASE WHEN event_type = 'error' THEN 0 ELSE epoch_us(ts) // 1000 END AS repaired
FROM events""")
def epochs(t: Tables):
    e = t.events.withColumn("ms", dates.to_millis("ts"))
    seen = F.when(F.col("event_type") != "error", F.col("ms"))
    return e.select(
        "event_id", dates.to_millis(dates.from_millis("ms")).alias("millis"),
        F.unix_seconds(dates.from_seconds(F.floor(F.col("ms") / 1000).cast("string"))).alias("seconds"),
        dates.to_millis(dates.millis_or_epoch(seen)).alias("repaired"),
    )


@query("record_keys", """
WITH x AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS seg, c_custkey * 100000.0 AS n FROM customer)
SELECT c_custkey, c_name || coalesce(seg, 'NA') || CAST(CAST(n AS BIGINT) AS VARCHAR) AS pasted,
       c_custkey || '-' || coalesce(seg, 'NA') AS dashed,
       sha256('["v' || c_name || '","' || CASE WHEN seg IS NULL THEN 'n' ELSE 'v' || seg END || '"]') AS hashed
FROM x""")
def record_keys(t: Tables):
    c = t.customer.withColumns({
        "seg": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")), "n": F.col("c_custkey") * 100000.0,
    })
    return c.select(
        "c_custkey", keys.text_key("c_name", "seg", keys.count_text("n")).alias("pasted"),
        keys.text_key("c_custkey", "seg", sep="-").alias("dashed"), keys.hash_key("c_name", "seg").alias("hashed"),
    )


@query("ratio_and_rounding", """
WITH x AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN f = 0 AND o = 0 THEN 0.0 WHEN f = 0 THEN 1.0 ELSE round((o - f) / f::DOUBLE, 9) END AS change,
       CASE WHEN f = 0 AND o = 0 THEN 0.0 WHEN f = 0 THEN 100.0 ELSE round_even(round(100.0 * (o - f) / f, 9), 0) END::DOUBLE AS pct,
       round(o / 2.0, 0)::DOUBLE AS half_away, round_even(o / 2.0, 0)::DOUBLE AS half_even
FROM x""")
def ratio_and_rounding(t: Tables):
    status = F.col("o_orderstatus")
    x = t.orders.groupBy("o_custkey").agg(numbers.sum_where(F.lit(1), status == "F").alias("f"), numbers.sum_where(F.lit(1), status == "O").alias("o"))
    change = numbers.ratio_change("o", "f")
    return x.select(
        "o_custkey", F.round(change, 9).alias("change"), numbers.percent(change).alias("pct"),
        F.round(F.col("o") / 2).alias("half_away"), F.bround(F.col("o") / 2).alias("half_even"),
    )


@query("classify_groups", """
WITH d AS (SELECT * FROM (VALUES ('flip','5-LOW'),('flip','1-URGENT'),('urgent','1-URGENT'),('new','2-HIGH')) v(g, val)),
x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS p FROM orders),
d2 AS (SELECT g, val FROM d UNION ALL SELECT 'unknown', NULL)
SELECT o_orderkey, p AS priority, d2.g AS "group" FROM x LEFT JOIN d2 ON p IS NOT DISTINCT FROM d2.val""")
def classify_groups(t: Tables):
    groups = {"priority": {"flip": ["5-LOW", "1-URGENT"], "urgent": ["1-URGENT"], "new": ["2-HIGH"], "unknown": [None]}}
    x = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"))
    return dims.classify(x, "priority", dims.group_rows(t.spark, groups), "priority")


@query("classify_deal_types", """
WITH x AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Term Flip' WHEN '2-HIGH' THEN 'New Logo' WHEN '3-MEDIUM' THEN 'Renewal'
  WHEN '5-LOW' THEN 'Subscription Flip' ELSE 'Other' END AS ty, CASE o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'O' THEN '99-Lost' ELSE 'Nurture' END AS st FROM orders)
SELECT o_orderkey, CASE ty WHEN 'Term Flip' THEN 'flip,term_flip' WHEN 'New Logo' THEN 'new_business' WHEN 'Renewal' THEN 'renewal'
       WHEN 'Subscription Flip' THEN 'flip,maintenance_flip' ELSE '' END AS type_groups,
       CASE st WHEN 'Closed Won' THEN 'won,closed' WHEN '99-Lost' THEN 'lost,closed' ELSE 'junk' END AS stage_groups
FROM x""")
def classify_deal_types(t: Tables):
    types = {"1-URGENT": "Term Flip", "2-HIGH": "New Logo", "3-MEDIUM": "Renewal", "5-LOW": "Subscription Flip"}
    kind = F.coalesce(F.create_map(*[F.lit(x) for p in types.items() for x in p])[F.col("o_orderpriority")], F.lit("Other"))
    stage = F.when(F.col("o_orderstatus") == "F", "Closed Won").when(F.col("o_orderstatus") == "O", "99-Lost").otherwise("Nurture")
    return t.orders.select(
        "o_orderkey", F.array_join(dims.groups_of(kind, dims.DEAL_TYPES), ",").alias("type_groups"),
        F.array_join(dims.groups_of(stage, dims.STAGES), ",").alias("stage_groups"),
    )


@query("row_best", """
SELECT p_partkey, a, b, c, CASE WHEN a IS NULL OR b IS NULL OR c IS NULL THEN NULL ELSE greatest(a, b, c) END AS best,
       CASE WHEN a IS NULL OR b IS NULL OR c IS NULL THEN NULL WHEN a >= b AND a >= c THEN 'A' WHEN b >= c THEN 'B' ELSE 'C' END AS which,
       coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS total
FROM (SELECT p_partkey, p_size % 7 AS a, CASE WHEN p_size = 13 THEN NULL ELSE p_size % 5 END AS b, p_size % 3 AS c FROM part)""")
def row_best(t: Tables):
    s = F.col("p_size")
    p = t.part.select("p_partkey", (s % 7).alias("a"), F.when(s != 13, s % 5).alias("b"), (s % 3).alias("c"))
    return p.withColumns({
        "best": numbers.row_max("a", "b", "c"), "which": numbers.row_argmax(["a", "b", "c"], ["A", "B", "C"]), "total": numbers.row_sum("a", "b", "c"),
    })


@query("in_list_filter", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority LIKE '%H%')
AND o_orderstatus NOT IN ('P', 'it''s') AND lower(o_orderpriority) NOT LIKE '%urgent%'""")
def in_list_filter(t: Tables):
    o = t.orders
    rows = t.spark.sql(f"SELECT o_orderkey, o_orderpriority FROM {{o}} WHERE o_orderstatus NOT IN ({text.sql_in_list(['P', chr(39).join(['it', 's'])])})", o=o)
    kept = joins.present_in(rows, o.where(F.col("o_orderpriority").like("%H%")), ["o_orderpriority"])
    return kept.where(~F.lower("o_orderpriority").like("%urgent%"))
