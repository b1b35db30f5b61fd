"""What the jobs of the usage chain shuffle: lists and wide rows as they are, and odd rows come out as before."""

import pytest
from pyspark.sql import functions as F

from revloom.functions.dates import date_from_parts, month_start
from revloom.plans import activity, contracts, daily_usage


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()  # as planned, also when df has run


def test_months_are_sorted_without_shuffling_them(spark):
    months = {f"data.{m}": i for i, m in enumerate(["Jan", "Feb", "Foo", "Dec"])}
    keys = [("b", "e", "x", 1999, "t"), ("a", "e", "x", 2001, "t"), ("a", "e", "x", 2000, "u"), ("a", "e", "x", 2000, "t"), (None, "e", "x", 2000, "t"), ("a", "e", "x", None, "t"), ("a", None, "x", 12, "t")]
    wide = spark.createDataFrame([(*k, *months.values()) for k in keys], "portal_id string, envid string, activity string, year int, type string, " + ", ".join(f"`{m}` int" for m in months))
    out = activity.sorted_months(wide)
    order = ["portal_id", "envid", "activity", "month", "type"]
    got, asked = ([[r[c] for c in order] for r in df.collect()] for df in (out, activity.sorted_fact(activity.by_month(wide))))
    assert got == asked and len(got) == len(keys) * len(months)
    text = plan(out)
    assert text.index("Generate") < text.index("Exchange rangepartitioning")


def test_days_are_summed_before_environments_become_rows(spark, no_broadcast):
    hour = 3600000
    used = [("p", 0, hour, 5, 1, None), ("p", hour, 2 * hour, 5, 2, None), ("p", None, hour, 5, 9, 9), ("p", 20 * hour, 21 * hour, 0, None, 4), (None, 0, hour, 1, 1, 1)]
    consumption = spark.createDataFrame(used, "portal_id string, startMillis long, endMillis long, jobExecutions long, dev int, date int")
    zone = spark.createDataFrame([("p", "Asia/Tokyo")], "portal_id string, zone string")
    out = daily_usage.local_days(consumption, zone)
    got = sorted([(r.portal_id, r.environment, str(r.date), r.job_executions) for r in out.collect()], key=repr)
    first, second = "1970-01-01", "1970-01-02"
    assert got == sorted([("p", "dev", first, 3), ("p", "date", first, 0), ("p", "dev", second, 0), ("p", "date", second, 4), (None, "dev", first, 1), (None, "date", first, 1)], key=repr)
    text = plan(out)
    assert text.index("Generate") < text.index("HashAggregate")


def test_usual_dates_need_no_parsing_and_others_are_as_they_were(spark):
    named = [("Jan", "1999"), ("sep", "2000"), ("DEC", "2000"), ("anF", "2000"), ("Feb", "999"), ("Feb", "12345"), ("Feb", "abcd"), (None, "2000"), ("Mar", None), ("March", "2000")]
    df = spark.createDataFrame(named, "n string, y string")
    text = F.concat("n", F.lit("-"), "y", F.lit("-1"))
    out = df.select(month_start("n", "y").alias("d"), F.try_to_timestamp(text, F.lit("MMM-yyyy-d")).cast("date").alias("e"))
    assert out.where("NOT d <=> e").count() == 0 and out.where("d IS NOT NULL").count() == 3
    parts = spark.createDataFrame([((1999, 2, 28),), ((1999, 2, 29),), ((2000, 2, 29),), ((1999, 13, 1),), ((None, 1, 1),), ((1999, 4, 31),)], "p struct<year: int, month: int, dayOfMonth: int>")
    assert [str(r.d) for r in parts.select(date_from_parts("p").alias("d")).collect()] == ["1999-02-28", "None", "2000-02-29", "None", "None", "None"]
    assert "make_date" in plan(parts.select(date_from_parts("p"))).lower()


def test_a_list_of_usage_periods_is_shuffled_whole(spark, no_broadcast):
    day = "struct<year: int, month: int, dayOfMonth: int>"
    periods = [((1999, 1, 1), (1999, 2, 1), 3), ((1999, 2, 1), (1999, 3, 1), 4)]
    usage = spark.createDataFrame([(1, periods), (2, []), (3, None), (None, periods), (9, periods)], f"contract_id long, usagePeriods array<struct<startDate: {day}, endDate: {day}, usage: int>>")
    docs = spark.createDataFrame([(1, "o", 7, ("p",)), (2, "o", 7, ("p",)), (3, "o", 7, ("p",)), (None, "o", 7, ("p",))], "id long, opportunityId string, customerId long, customer struct<portalId: string>")
    out = contracts.usage_period_table(usage, docs)
    assert sorted((r.id, r.usage, r.portal_id) for r in out.collect()) == [("1-7-1999-01-01-1999-02-01", 3, "p"), ("1-7-1999-02-01-1999-03-01", 4, "p")]
    assert plan(out).index("Generate") < plan(out).index("Exchange")
