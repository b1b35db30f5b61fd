"""Plans under skew: a key with a third of the rows is split, copies go before the shuffle."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from revloom.operators import aggregates, joins, scan, windows
from revloom.session import BOUNDED, SETTINGS, TRAVELLING, settle

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(spark):
    """A third of the rows under key 0; read by several tasks, so that a split has something to split."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    return spark.range(0, 60000, 1, 8).select("id", key.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def lookups(spark, hot):
    table = spark.range(0, 2000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("x"))
    return {
        "lookup_or_default": joins.lookup_or_default(hot, table, "k", "x", 0),
        "update_from": joins.update_from(hot.withColumn("x", F.lit(0)), table, [("k", "k")], {"x": "x"}, [F.col("x")]),
        "with_presence": joins.with_presence(hot, table, ("k", "k"), "x"),
        "with_key_max": windows.with_key_max(hot, ["k"], "v", "x"),
        "absent_from": joins.absent_from(hot, table.where("k > 5"), ["k"]),
        "present_in": joins.present_in(hot, table, ["k"]),
    }


@pytest.mark.parametrize("name", ["lookup_or_default", "update_from", "with_presence", "with_key_max", "absent_from", "present_in"])
def test_hot_key_is_split(spark, no_broadcast, hot, name):
    df = lookups(spark, hot)[name]
    assert "skew=true" in final_plan(df)
    # the aggregation that follows does not keep the hot key together either
    assert "skew=true" in final_plan(df.groupBy("k", "v").count())


def test_copies_are_dropped_before_the_shuffle(spark, no_broadcast, hot):
    plan = final_plan(joins.present_in(hot.select("id"), hot, [("id", "k")]))
    assert plan.count("HashAggregate") >= 2


def test_hot_lookup_is_whole(spark, no_broadcast, hot):
    table = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    out = joins.left_lookup(hot, table, [("k", "k")], {"x": "x"})
    assert out.count() == 60000 and out.where("x <> k * 2 OR x IS NULL").count() == 0


def rows_per_task(df, *names):
    """The most rows that one window of the executed plan's last exchange holds, by the columns it is dealt by."""
    return df.groupBy(*names).count().agg(F.max("count")).first()[0]


def test_a_hot_minute_is_split(spark):
    """One series, a third of its rows in one second and all in one minute: ranges follow the rows."""
    at = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 60)
    df = spark.range(0, 60000, 1, 8).select(F.lit("one").alias("s"), F.timestamp_seconds(at).alias("t"), "id", F.lit(1).alias("v"))
    assert rows_per_task(scan.ranged(df, ["s", "t", "id"], 16), "_range") < 3 * 60000 / 16
    out = windows.lag_difference(df, ["s"], ["t", "id"], {"x": "v"}, 16)
    assert "Join" not in final_plan(out) and out.where("x = 0").count() == 59999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_range" in plan and "SinglePartition" not in plan.split("Window")[1]


def test_a_hot_value_of_a_floor_lookup_is_split(spark):
    df = spark.range(0, 60000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("v"))
    tiers = spark.range(0, 1000, 7).select(F.col("id").alias("t"))
    out = joins.floor_tier(df, tiers, "v", "t", 16)
    assert out.where("t <> v - v % 7").count() == 0 and out.count() == 60000
    plan = final_plan(out)
    assert "Join" not in plan and "hashpartitioning(_range" in plan and "_share" in plan


def test_a_hot_group_of_a_joined_text_is_split(spark, hot):
    texts = aggregates.joined_text(hot, ["k"], "v", "t", chunk_bytes=4096)
    assert texts.agg(F.max(F.length("t"))).first()[0] <= 4096 + 33 and texts.where("k = 0").count() >= 20000 * 33 // 4096


def test_queries_bring_their_settings_to_a_plain_session(spark):
    plain = spark.newSession()
    plain.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    plain.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    entry.queries()["changeset"](plain, "/root/testdata/sf0.001")
    assert all(plain.conf.get(n) == SETTINGS[n] for n in TRAVELLING)


def test_a_session_gets_bounded_tasks_unless_it_has_its_own(spark):
    old = {n: spark.conf.get(n, None) for n in BOUNDED}
    try:
        for n in BOUNDED:
            spark.conf.unset(n)
        first, second = BOUNDED
        spark.conf.set(first, "20KB")
        settle(spark)
        assert spark.conf.get(first) == "20KB" and spark.conf.get(second) == BOUNDED[second]
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
