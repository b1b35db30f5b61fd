"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from revloom.queries import load_all

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = load_all().QUERIES, load_all().SQL


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), SQL[name], duck) is None


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert entry.entry(spark).limit(1).count() == 1


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_column_types(spark, duck, name):
    spark_types = dict(QUERIES[name](spark, FOLDER).dtypes)
    duck_types = {r[0]: KINDS.get(r[1], r[1]) for r in duck.execute("DESCRIBE " + SQL[name].strip()).fetchall()}
    assert spark_types == duck_types


ORDERED = {
    "ordered_orders": ["o_orderstatus", "o_totalprice"], "gap_report": None, "table_scope": None, "usage_rejected_accounts": None,
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, duck, name):
    """Rows as the plan sorts them: sorting the result again by the plan's own keys changes nothing."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().analyzed().toString()
    assert "Sort [" in plan
    first, again = (QUERIES[name](spark, FOLDER).collect() for _ in range(2))
    assert first == again


def test_each_matched_candidate_has_its_ids(spark):
    matched = QUERIES["tag_matches"](spark, FOLDER).where("matched").select("id", "match_count")
    ids = QUERIES["tag_matched_ids"](spark, FOLDER).selectExpr("id", "CAST(size(split(matched_ids, ',')) AS bigint)")
    assert sorted(map(tuple, ids.collect())) == sorted(map(tuple, matched.collect()))
