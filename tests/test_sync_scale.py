"""What the usage sync shuffles and writes: rows move once per step, and odd rows come out as before."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revloom.operators.changes import keep_one, new_only
from revloom.plans import usage_sync
from revloom.sources import writers

DAY = dt.date(1999, 1, 5)
USAGE = "portal_id string, environment string, job_executions double, date date, product string, account_id string, deal_id string"


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


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def test_new_rows_once_are_the_kept_ones_that_are_not_loaded(spark, no_broadcast, rows):
    source = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, None), ("a", 1, "y"), ("b", 1, "x"), (None, 3, "x"), (None, 2, "x"), ("c", None, "x"), ("c", 5, "x"), ("d", 1, "x"), ("d", 1, "x")],
        "record_key string, n int, t string",
    )
    for loaded in ([("b",), ("b",), ("z",)], [(None,), ("a",)], []):
        target = spark.createDataFrame(loaded, "record_key string")
        once = new_only(source, target, ["record_key"], once=True)
        assert rows(once) == rows(new_only(keep_one(source, ["record_key"]), target, ["record_key"])) and once.schema == source.schema
        assert shuffles(once) == 1


def test_daily_changes_move_usage_once_each(spark, no_broadcast, rows):
    used = [("p", "e", 3.0, DAY, "P", "A", "d2"), ("p", "e", 3.0, DAY, "P", "A", "d1"), ("q", "e", None, DAY, "P", None, None), ("r", "e", 1.0, DAY, "P", "A", "d")]
    loaded = spark.createDataFrame([("1", "re1999-01-051P"), ("2", "gone"), ("3", "gone"), ("4", None)], "id string, record_key string")
    out = usage_sync.daily_changes(spark.createDataFrame(used, USAGE), loaded)
    assert shuffles(out["daily_insert"]) == 1 and shuffles(out["daily_delete"]) == 2
    assert [(r.record_key, r.deal_id) for r in out["daily_insert"].sort("record_key").collect()] == [("pe1999-01-053P", "d1"), ("qe1999-01-05NAP", None)]
    assert rows(out["daily_delete"]) == rows(loaded.where("id <> '1'"))


def test_portal_usage_is_shuffled_once(spark, no_broadcast):
    used = spark.createDataFrame([("p", "e", DAY, 1), ("q", "e", DAY, 2), (None, "e", DAY, 3), ("s", "e", DAY, 4)], "portal_id string, environment string, date date, job_executions int")
    mapped = spark.createDataFrame([("p", "A"), ("p", "B"), ("q", None), ("s", "C")], "portal_id string, account_id string")
    deals = spark.createDataFrame([("A", "d1", DAY), ("A", "d2", DAY), ("B", "d3", None), (None, "d4", DAY)], "account_id string, opportunityId string, human_end date")
    out = usage_sync.portal_usage(used, mapped, deals, "1999-06-20", "P")
    found = sorted(((r.portal_id, r.account_id, r.deal_id) for r in out.collect()), key=repr)
    assert found == sorted([("p", "A", "d2"), ("p", "B", "d3"), ("q", None, None), (None, None, None), ("s", "C", None)], key=repr)
    # newest deals, ids and deals for their join, and then usage and ids
    assert plan(out).count("job_executions") and shuffles(out) <= 5


def test_instance_usage_sums_by_id_and_merges_same_names(spark, no_broadcast):
    at = lambda h, d=5: dt.datetime(1999, 1, d, h)
    snapshots = spark.createDataFrame(
        [(1, at(1), 1, 1, None), (1, at(2), 2, None, 4), (2, at(3), 5, 0, 0), (3, at(1), 7, 0, 0), (4, at(1), 1, None, 1), (None, at(1), 9, 9, 9), (9, at(1), 9, 9, 9)],
        "capture_id long, start timestamp, succeeded long, failed int, aborted int",
    )
    captures = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12), (2, 10)], "capture_id long, scheduler_id long")
    schedulers = spark.createDataFrame([(10, 100), (10, 101), (11, 102), (12, 103)], "scheduler_id long, customer_id long")
    customers = spark.createDataFrame([(100, "n", "A"), (101, "n", "A"), (102, None, "B"), (103, "m", None)], "customer_id long, customer_name string, account_id string")
    out = usage_sync.instance_usage(snapshots, captures, schedulers, customers, "1999-06-20", "I")
    found = sorted([(r.portal_id, r.environment, r.job_executions, r.account_id) for r in out.collect()], key=repr)
    # scheduler 10 has two customers of one name, and capture 2 two rows
    assert found == sorted([("NA - n", "JssId - 10", 2.0 * (8 + 10), "A"), (None, "JssId - 11", 7.0, "B"), ("NA - m", "JssId - 12", None, None)], key=repr)
    # two sides of three joins and the sums; there were two more
    assert shuffles(out) <= 7


def test_stored_tables_come_back_whole(spark, tmp_path, rows):
    tables = {f"j/{i}": spark.range(i * 10).select("id", F.md5(F.col("id").cast("string")).alias("t")) for i in range(5)}
    back = writers.stored(tables, f"file://{tmp_path}")
    assert list(back) == list(tables) and all(rows(back[n]) == rows(tables[n]) for n in tables)
    assert any(".zstd." in p.name for p in (tmp_path / "j" / "4").iterdir())
    with pytest.raises(Exception, match="boom"):
        writers.stored({"bad": spark.range(1).select(F.raise_error(F.lit("boom")).alias("x"))}, f"file://{tmp_path}")
