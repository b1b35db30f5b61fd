"""Jobs on small inputs with results worked out by hand."""

import datetime as dt
import json

from pyspark.sql import functions as F

from revloom.plans import activity, contracts, daily_usage, forecast, install_match, onboarding, reconcile, snapshots, tag_sync, telemetry, usage_sync

D = dt.date


def test_daily_usage(spark, rows):
    hour = 3600000
    start = 1704067200000  # 2024-01-01 00:00 UTC
    use = spark.createDataFrame(
        [("a", start, start + hour, 9, {"x": 2, "y": None}), ("a", start + 6 * hour, start + 7 * hour, 9, {"x": 3, "y": None}), ("b", start, start + hour, 1, {"x": 1}),
         ("o'x", start, start + hour, 1, {"x": 1}), ("a", None, start, 5, {"x": 7})],
        "portal_id string, startMillis long, endMillis long, jobExecutions long, environments map<string,long>",
    )
    out = daily_usage.run({
        "consumption": use, "customers": spark.createDataFrame([("a", "o")], "portal_id string, owner string"),
        "clients": spark.createDataFrame([("b",), ("o'x",)], "customer_code string"), "activity_customers": spark.createDataFrame([(None,)], "customer_id string"),
        "account_map": spark.createDataFrame([("a", "A")], "portal_id string, account_id string"),
        "accounts": spark.createDataFrame([("A", "America/New_York")], "id string, timezone string"), "known_usage": spark.createDataFrame([("old",)], "portal_id string"),
    })
    assert rows(out["usage"].select("portal_id", "environment", "date", "job_executions")) == [
        ("a", "x", D(2023, 12, 31), 2), ("a", "x", D(2024, 1, 1), 3), ("a", "y", D(2023, 12, 31), 0), ("a", "y", D(2024, 1, 1), 0), ("b", "x", D(2024, 1, 1), 1)
    ]
    assert rows(out["all_portal_ids"]) == [("a",), ("b",), ("old",)]
    assert out["customers"].columns == ["portal_id"]


def test_sorted_jobs_are_in_order_across_partitions(spark):
    last = lambda r: [(v is None, v) for v in r]
    fact = spark.range(600).selectExpr(
        "CASE WHEN id % 7 > 0 THEN concat('p', id % 7) ELSE NULL END AS portal_id", "concat('e', id % 5) AS envid", "concat('a', id % 3) AS activity", "CASE WHEN id % 11 > 0 THEN id % 11 END AS month",
        "concat('t', id % 2) AS type")
    tiers = spark.range(600).selectExpr("CASE WHEN id % 13 > 0 THEN concat('o', id % 13) END AS opportunityId", "CASE WHEN id % 9 > 0 THEN id % 9 END AS start", "concat('c', id % 4) AS ContractPeriodId")
    for rows in (activity.sorted_fact(fact.repartition(5)), contracts.sorted_tiers(tiers.repartition(5))):
        got = [last(r) for r in rows.collect()]
        assert len(got) == 600 and all(a <= b for a, b in zip(got, got[1:], strict=False))


def test_contracts_from_json_files(spark, tmp_path, rows):
    date = lambda y, m, d: {"year": y, "month": m, "dayOfMonth": d}
    docs = [
        {"id": 1, "opportunityId": "o1", "customerId": 7, "productId": "p", "usagePeriod": "M", "status": "ACTIVE", "customer": {"portalId": "a"}, "opportunity": {"x": 1},
         "provisionDate": None, "locationCounts": [{"deploymentType": "SAAS"}, {"deploymentType": "PREM"}],
         "contractPeriods": [{"id": "p1", "startDate": date(2023, 1, 1), "endDate": date(2024, 1, 1), "jobTiers": [{"start": 5}, {"start": 0}]},
                             {"id": "p2", "startDate": date(2024, 1, 1), "endDate": date(2025, 1, 1), "jobTiers": [{"start": 9}]}]},
        {"id": 2, "opportunityId": "o2", "customerId": 8, "customer": {"portalId": "b"}, "provisionDate": date(2023, 2, 30), "contractPeriods": []},
    ]
    (tmp_path / "c.json").write_text("\n".join(json.dumps(d) for d in docs))
    schema = """id long, opportunityId string, customerId long, productId string, usagePeriod string, status string, customer struct<portalId:string>, opportunity struct<x:int>,
        provisionDate struct<year:int,month:int,dayOfMonth:int>, locationCounts array<struct<deploymentType:string>>, contractItems array<string>,
        contractPeriods array<struct<id:string,startDate:struct<year:int,month:int,dayOfMonth:int>,endDate:struct<year:int,month:int,dayOfMonth:int>,jobTiers:array<struct<start:long>>>>"""
    contract = spark.read.schema(schema).json(str(tmp_path / "c.json"))
    usage = spark.createDataFrame([(1, [((2023, 1, 1), (2023, 2, 1), 4)]), (2, [])], """contract_id long, usagePeriods array<struct<
        startDate:struct<year:int,month:int,dayOfMonth:int>,endDate:struct<year:int,month:int,dayOfMonth:int>,usage:long>>""")
    product = spark.createDataFrame([("p", "Prod", [], [("k", [1])])], "id string, displayName string, contractItemTypes array<string>, packages array<struct<id:string,items:array<int>>>")
    out = contracts.run({"contracts": contract, "contract_usage": usage, "products": product}, "2024-01-01")
    assert rows(out["contracts"].select("id", "provision_date", "DeploymentType", "human_start", "human_end")) == [
        (1, None, "SAAS", D(2023, 1, 1), D(2025, 1, 1)), (2, None, "Unknown", None, None)
    ]
    assert "opportunity_x" not in out["contracts"].columns and "opportunityId" in out["contracts"].columns
    assert rows(out["contract_periods"].select("id", "active_today")) == [("p1", False), ("p2", True)]
    assert [tuple(r) for r in out["contract_job_tiers"].collect()] == [(0, "p1", "o1"), (5, "p1", "o1"), (9, "p2", "o1")]
    assert rows(contracts.job_tier_table(contract, last_only=True)) == [(9, "p2", "o1")]
    assert rows(out["usage_periods"].select("id", "portal_id", "usage")) == [("1-7-2023-01-01-2023-02-01", "a", 4)]
    assert rows(out["product_packages"]) == [("k", "p")]


def test_telemetry_without_a_schema(spark, rows):
    docs = [
        (1, "a", json.dumps({"version": "1", "creationDate": 60, "auth": {"mode": "m", "authList": [{"u": 1}, {"u": 2}]}, "events": {"sinkCount": "x", "rules": []}, "interfaces": [], "extra": 1})),
        (2, "b", json.dumps({"version": "2", "creationDate": 0, "config": [{"general": {"installedDate": 60}}], "status": {"intervalStartTime": 1}, "interfaces": [{"type": "t"}]})),
        (3, "c", "{broken"), (4, "d", json.dumps({"version": "4"})),
    ]
    source = spark.createDataFrame(docs, "id long, creationDate string, data string")
    parsed = telemetry.new_documents(source, spark.createDataFrame([(4,)], "product_statistics_id long")).persist()
    out = telemetry.nodes(parsed)
    assert rows(out["product_statistics"].select("product_statistics_id", "version", F.unix_seconds("creationDate"))) == [(1, "1", 60), (2, "2", 0)]
    assert "extra" in out["product_statistics"].columns and "sync" not in out
    assert rows(out["auth"]) == [(1, "m")] and out["auth_list"].count() == 2
    assert "event_rules" not in out  # no document says what a rule looks like
    assert rows(out["events"]) == [(1, None)] and rows(out["interfaces"]) == [(2, "t")]
    assert rows(out["config"].select(F.unix_seconds("general_installedDate"))) == [(60,)]
    assert rows(telemetry.quarantine(parsed).select("product_statistics_id")) == [(3,)]
    parsed.unpersist()


def test_reconciliation_balances(spark, rows):
    date = D(2023, 1, 1)
    order = spark.createDataFrame(
        [("o1", "A", None, "P", None, "Sent", date, 10.0, "E", "i1", False), ("o2", "A", None, "P", None, "Draft", date, 7.0, "E", "i2", False),
         ("o3", None, None, None, "Royalty", None, date, 5.0, "?", "i3", False), ("o4", "A", None, "P", None, "Sent", D(2020, 1, 1), 5.0, "E", "i9", False)],
        "id string, account_id string, deal_id string, product string, type string, invoice_status string, effective_date date, amount double, currency string, invoice_id string, test boolean",
    )
    inv = spark.createDataFrame(
        [("i1", "A", "d", None, "Sent", date, 10.0, "E", False), ("i3", None, None, "Royalty", "Sent", date, 4.0, "E", False), ("i9", "A", "d", None, "Sent", date, 1.0, "E", False),
         ("i2", "A", "d", None, "Sent", date, 1.0, "E", None)],
        "id string, account_id string, deal_id string, type string, invoice_status string, billing_start date, amount double, currency string, test boolean",
    )
    out = reconcile.run({
        "orders": order, "invoices": inv, "rates": spark.createDataFrame([("E", 2.0)], "iso_code string, rate double"),
        "accounts": spark.createDataFrame([("A", "R", None)], "id string, region string, segment string"), "deals": spark.createDataFrame([("d", "deal", "P")], "id string, name string, product string"),
    }, "2022-01-01")
    assert rows(out["missing_invoices"].select("id", "value")) == [("i9", 1.0)]
    check = {r.helper: r for r in out["master_check"].collect()}
    a, royalty = check["2023-01-01PContractedRNAA"], check["2023-01-01DefaultSAP - RoyaltyNANANA"]
    assert (a.order_won, a.order_forecast, a.order_n, a.invoice_won, a.invoice_n, a.won_check, a.n_check) == (5.0, 4.0, 2, 5.0, 1, 0.0, 1)
    assert (royalty.order_forecast, royalty.invoice_won, royalty.won_check, royalty.n_check) == (0.0, 2.0, -2.0, 0)


def test_forecast_versions(spark, rows):
    days = [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)]
    data = [(days[0], 10.0, 0.0, 5.0, 9.0, 1.0, 0.5), (days[1], 25.0, 0.0, 5.0, 0.0, 4.0, None), (days[2], 45.0, 99.0, 8.0, 0.0, 9.0, 10.125), (None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    sheet = spark.createDataFrame(data, "order_date date, new_forecast double, new_actual double, expansion_forecast double, expansion_actual double, flips_forecast double, flips_actual double")
    flip = "Flips - Maintenance"
    one = rows(forecast.daily_rates(sheet, "2024-01-02"))
    assert one == [(days[1], flip, 3.0), (days[1], "New", 15.0), (days[2], "Expansion", 3.0)]
    two = rows(forecast.daily_rates(sheet, "2024-01-02", version=2))
    assert two == [(days[0], flip, -0.5), (days[1], flip, 3.0), (days[1], "New", 15.0), (days[2], "Expansion", 3.0), (days[2], flip, 5.0)]


def test_snapshots_with_missing_columns(spark, rows):
    base = "id string, currency string, test boolean, billing_period_1_amount double, type string, snapshot_time timestamp"
    t = dt.datetime
    df = spark.createDataFrame([("1", "E", False, 10.0, "x", t(2024, 1, 1, 9)), ("1", "E", False, 10.0, "x", t(2024, 1, 2)), ("1", "E", False, 10.0, "x", t(2024, 1, 2)), ("2", "E", True, 1.0, "x", t(2024, 1, 3)), ("3", "?", False, 1.0, "x", t(2024, 1, 3))], base)
    out = snapshots.run(df, spark.createDataFrame([("E", 2.0)], "iso_code string, rate double"), t(2024, 1, 1, 1), {"3": {"type": "New"}})
    assert rows(out.select("id", "first_year_value_usd", "software_usd", "type")) == [("1", 5.0, None, "x"), ("1", 5.0, None, "x"), ("3", None, None, "New")]
    later = snapshots.run(df, spark.createDataFrame([("E", 2.0)], "iso_code string, rate double"), t(2024, 1, 1, 9))
    assert rows(later.select("id")) == [("1",), ("3",)]
    assert snapshots.run(df, spark.createDataFrame([("E", 2.0)], "iso_code string, rate double")).count() == 3


def test_install_match(spark, rows):
    payload = spark.createDataFrame([("install", ["1", "setup-ab12cd.exe"]), ("install", ["2", "x-ab12cd.msi"]), ("visit", ["3", "y-ab12cd.msi"]), ("install", ["4"]), ("install", None)], "type string, properties array<string>")
    leads = spark.createDataFrame([(1, "ab12cd", False, True), (2, "setup-", False, True), (3, "ab12cd", True, True), (4, None, False, True), (5, "setup", False, True)], "id int, token string, verified boolean, token_present boolean")
    out = install_match.run({"payload": payload, "leads": leads})
    assert rows(out["matches"].select("id", "install")) == [(1, "setup-ab12cd.exe"), (1, "x-ab12cd.msi"), (5, "setup-ab12cd.exe")]
    assert rows(out["lead_update"]) == [(1, True), (5, True)]


def test_tag_sync(spark, rows):
    accounts = spark.createDataFrame([(1, None, "d", None), (2, "A", "d", None), (3, "A;T", "none", None), (4, "T", None, None), (5, None, "none", "x"), (6, "T;A", "d", None), (7, "A", "none", None)], "id int, areas string, domain string, linked_id string")
    others = spark.createDataFrame([("c1", "d", "Active Account"), ("c2", "d", "Former"), ("c3", None, "Active Account")], "id string, domain string, status string")
    out = tag_sync.run({"accounts": accounts, "customers": others}, "T")
    assert rows(out["candidates"].select("id", "match_count", "matched")) == [(1, 1, True), (2, 1, True), (3, 1, False), (4, 1, False), (5, 1, False), (6, 2, True)]
    found = out["candidates"].where("matched").join(out["domain_ids"], ["scope", "domain"])
    assert rows(found.select("id", "matched_id")) == [(1, "c1"), (2, "c1"), (6, "c1"), (6, "c2")]
    assert rows(out["before"]) == [(1, None), (2, "A"), (3, "A;T"), (4, "T"), (5, None)]
    assert rows(out["account_update"]) == [(1, "T"), (2, "A;T"), (3, "A"), (4, None), (5, None)]


def test_record_key_never_uses_exponents(spark, rows):
    df = spark.createDataFrame([("p", "e", D(2024, 1, 1), 100000.0, "X"), (None, "e", D(2024, 1, 1), None, "X")], "portal_id string, environment string, date date, job_executions double, product string")
    assert rows(usage_sync.record_key(df).select("record_key")) == [("NAe2024-01-01NAX",), ("pe2024-01-01100000X",)]


def test_services_deal_links(spark, rows):
    deal = "id string, account_id string, name string, related_id string, close_date date, services_bookings double, type string, stage string"
    every = spark.createDataFrame([
        ("s1", "A", "s1", None, D(2023, 6, 1), 1.0, "Professional Services", "x"), ("s2", "B", "s2", "d2", D(2023, 6, 1), 2.0, "Professional Services", "x"),
        ("s3", "C", "s3", None, D(2023, 6, 1), 3.0, "Professional Services", "x"), ("r", "D", "r", None, D(2020, 6, 1), 4.0, "Renewal", "x"), ("s4", "D", "s4", None, D(2023, 2, 1), 5.0, "Professional Services", "x"),
    ], deal)
    won = spark.createDataFrame([
        ("d1", "X", "n1", "s1", D(2023, 1, 1)), ("d2", "B", "n2", None, D(2023, 1, 1)), ("d3", "X", "manual", None, D(2023, 1, 1)), ("d4", "D", "n4", "r", D(2023, 1, 1)), ("d5", "D", "n5", None, D(2022, 2, 1)),
    ], "id string, account_id string, name string, related_id string, close_date date")
    won = won.selectExpr("*", "cast(null as string) related_name", "cast(null as string) related_stage", "cast(null as string) related_type", "cast(null as double) related_amount", "cast(null as date) related_close_date")
    out = onboarding.link_services(won, every, {"manual": "s3"})
    assert rows(out.select("id", "related_id", "related_amount", "related_close_date")) == [
        ("d1", "s1", 1.0, D(2023, 6, 1)), ("d2", "s2", 2.0, D(2023, 6, 1)), ("d3", "s3", 3.0, D(2023, 6, 1)), ("d4", "s4", 5.0, D(2020, 6, 1)), ("d5", None, None, None)
    ]


def test_variants_need_no_schema_and_no_second_parse(spark, tmp_path):
    """Children of stored variants: no job while planning, no text parsed, odd documents held to the declared names."""
    docs = [
        (1, '{"a": {"x": 1, "l": [1, 2]}, "n": "7"}'), (2, '{"a": [{"x": "2"}, {"x": "no"}, 5, null], "n": null}'), (3, "[1]"), (4, "{broken"), (5, None), (6, '{"a": [], "n": 1.5}'),
        (7, '{"A": {"x": 9}}'), (8, " {} "), (9, '"text"'),
    ]
    source = spark.createDataFrame(docs, "id bigint, data string")
    parsed = telemetry.new_variants(source, spark.createDataFrame([(1000,)], "id bigint"))
    assert "parseJson" in parsed._jdf.queryExecution().optimizedPlan().toString()
    parsed.select(telemetry.KEY, "doc").write.parquet(str(tmp_path / "v"))
    tables = telemetry.declared(spark.read.parquet(str(tmp_path / "v")), {"doc": ([], {"n": "int"}), "a": (["a"], {"x": "bigint", "l": "json"}), "l": (["a", "l"], {"none": "string"})})
    assert not any("parseJson" in t._jdf.queryExecution().optimizedPlan().toString() for t in tables.values())
    assert sorted(map(tuple, tables["doc"].collect())) == [(1, 7), (2, None), (6, 1), (7, None), (8, None)]
    key = lambda r: (r[0], str(r))
    assert sorted(map(tuple, tables["a"].collect()), key=key) == sorted([(1, 1, "[1,2]"), (2, 2, None), (2, None, None), (2, None, None), (2, None, None)], key=key)
    assert sorted(map(tuple, tables["l"].collect())) == [(1, None), (1, None)]
