"""Column functions, with the NULL, rounding and parsing rules they follow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revloom.functions import dates, keys, numbers, text


def values(spark, ddl, data, *columns):
    df = spark.createDataFrame(data, ddl)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


@pytest.mark.parametrize("raw, usd, any_code", [
    ("USD 2,000.00", 2000.0, 2000.0), ("EUR 15", None, 15.0), ("-", None, None), ("USD -5.00", None, None), ("abc", None, None),
    ("1d", None, None), ("", None, None), (None, None, None), (" 7.5 ", 7.5, 7.5),
])
def test_scrub(spark, raw, usd, any_code):
    got = values(spark, "s string", [(raw,)], numbers.scrub_usd("s"), numbers.scrub_currency("s", ["USD", "EUR"]))
    assert got == [(usd, any_code)]


def test_money_and_null_arithmetic(spark):
    data = [(1234.5, None), (-1234567.891, 2.0), (None, None)]
    got = values(spark, "a double, b double", data, numbers.format_money("a"), numbers.null_subtract("a", "b"), numbers.row_sum("a", "b"))
    assert got == [("$1,234.50", 1234.5, 1234.5), ("$-1,234,567.89", -1234569.891, -1234565.891), (None, 0.0, 0.0)]


def test_ratio_change(spark):
    data = [(0, 0), (5, 0), (-5, 0), (3, 2), (1, 8), (None, 2)]
    got = values(spark, "now long, before long", data, numbers.ratio_change("now", "before"))
    assert got == [0.0, 1.0, 1.0, 0.5, -0.875, None]
    assert values(spark, "x double", [(0.125,), (0.135,), (-0.005,)], numbers.percent("x")) == [12.0, 14.0, 0.0]


def test_per_rate_and_row_best(spark):
    assert values(spark, "a double, r double", [(10.0, 4.0), (1.0, 0.0), (1.0, None)], numbers.per_rate("a", "r")) == [2.5, None, None]
    cols = ["a", "b", "c"]
    got = values(
        spark, "a int, b int, c int", [(1, 1, 0), (0, 2, 2), (None, 1, 1), (-3, -2, -1)], numbers.row_max(*cols), numbers.row_argmax(cols, ["A", "B", "C"])
    )
    assert got == [(1, "A"), (2, "B"), (None, None), (-1, "C")]


def test_clean_name(spark):
    names = {"a.b c": "a_b_c", "it's": "its", "x%": "x", "é": "é", "a-b": "ab", "n_1": "n_1"}
    assert {n: text.clean_name(n) for n in names} == names
    assert values(spark, "s string", [(n,) for n in names], text.clean_name_text("s")) == list(names.values())


def test_ids_links_and_truncation(spark):
    ids = [("o'neil",), ("a b",), ("x/r2w/y",), (None,), ("good-id",), ("tab\tid",)]
    assert values(spark, "s string", ids, text.is_clean_id("s")) == [False, False, False, False, True, True]
    got = values(spark, "s string", [("site-0af1b2c3-1111-2222-3333-444455556666 x",), ("none",), (None,)], text.uuid_in("s"))
    assert got == ["0af1b2c3-1111-2222-3333-444455556666", None, None]
    assert values(spark, "s string", [("abcdefgh",), ("abc",), (None,)], text.truncate("s", 6)) == ["abc...", "abc", None]
    assert values(spark, "s string", [("7",)], text.hyperlink(text.record_link("http://h/r", "Account", "s"), F.lit("n"))) == ['=HYPERLINK("http://h/r/Account/7/view","n")']
    assert text.sql_in_list(["a", "o'b"]) == "'a','o''b'"


def test_tags(spark):
    data = [(None,), ("T",), ("A;T",), ("T;A",), ("A",), ("A;Tx",)]
    got = values(spark, "s string", data, text.add_tag("s", "T"), text.remove_tag("s", "T"), text.remove_tag_exact("s", "T"))
    assert got == [("T", None, None), ("T;T", "", None), ("A;T;T", "A", "A"), ("T;A;T", ";A", "A"), ("A;T", "A", "A"), ("A;Tx;T", "Ax", "A;Tx")]


def test_dates(spark):
    parts = "p struct<year:int, month:int, dayOfMonth:int>"
    got = values(spark, parts, [((2024, 2, 29),), ((2023, 2, 29),), ((None, 1, 1),), (None,)], dates.date_from_parts("p"))
    assert got == [dt.date(2024, 2, 29), None, None, None]
    got = values(spark, "m string, y int", [("Jan", 2024), ("Foo", 2024), (None, 2024)], dates.month_start("m", "y"))
    assert got == [dt.date(2024, 1, 1), None, None]
    got = values(spark, "ms long, z string", [(1704067200000, "America/New_York"), (1704067200000, "Asia/Tokyo")], dates.local_date(dates.from_millis("ms"), "z"))
    assert got == [dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert values(spark, "d date", [(dt.date(2024, 2, 10),)], dates.quarter_with_year("d").cast("double")) == [2024.1]
    got = values(spark, "s date, e date", [(dt.date(2024, 1, 1), dt.date(2024, 2, 1)), (dt.date(2024, 1, 1), None)], dates.active_on("s", "e", "2024-02-01"), dates.active_on("s", "e", "2024-01-01"))
    assert got == [(False, True), (False, False)]
    assert values(spark, "s string", [("x",), (None,), ("86400",)], F.unix_seconds(dates.from_seconds("s"))) == [None, None, 86400]
    assert values(spark, "s string", [("x",), ("2024-01-01 10:00:00",)], dates.parse_or_epoch("s").cast("string")) == ["1970-01-01 00:00:00", "2024-01-01 10:00:00"]
    assert values(spark, "i int", [(1,)], dates.month_floor_years_before("2024-05-17", 3)) == [dt.date(2021, 5, 1)]


def test_keys(spark):
    got = values(spark, "a string, b string, n double", [("1", "23", 1e5), ("12", "3", None), (None, "3", 2.0)], keys.text_key("a", "b", keys.count_text("n")))
    assert got == ["123100000", "123NA", "NA32"]
    hashed = values(spark, "a string, b string", [("1", "23"), ("12", "3"), (None, "NA"), ("NA", None)], keys.hash_key("a", "b"))
    assert len(set(hashed)) == 4
