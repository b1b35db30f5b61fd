"""Instants, calendar dates and periods. "Today" is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from revloom.functions.text import as_col

# Fixed value: stands for "no date" in the date-repair loads.
EPOCH = "1970-01-01 00:00:00"


def day(as_of: dt.date | str) -> Column:
    return F.lit(str(as_of)).cast("date")


def from_millis(c) -> Column:
    """Epoch millis; text is allowed and unreadable text is NULL."""
    return F.timestamp_millis(as_col(c).try_cast("bigint"))


def from_seconds(c) -> Column:
    """Epoch seconds; text is allowed and unreadable text is NULL."""
    return F.timestamp_seconds(as_col(c).try_cast("double"))


def to_millis(ts) -> Column:
    return F.unix_millis(as_col(ts).cast("timestamp"))


def or_epoch(ts) -> Column:
    """The instant, or 1970-01-01 where it is NULL."""
    return F.coalesce(as_col(ts), F.lit(EPOCH).cast("timestamp"))


def parse_or_epoch(c) -> Column:
    return or_epoch(F.try_to_timestamp(as_col(c)))


def millis_or_epoch(c) -> Column:
    return or_epoch(from_millis(c))


def date_from_parts(parts) -> Column:
    """Date of a {year, month, dayOfMonth} struct; NULL when a part is missing or impossible."""
    p = as_col(parts)
    zero, y, m, d = F.lit(0), p["year"].cast("int"), p["month"].cast("int"), p["dayOfMonth"].cast("int")
    # days that every month has need no test, which costs several times as much
    plain = y.between(1, 9999) & m.between(1, 12) & d.between(1, 28)
    return F.when(plain, F.make_date(y, m, d)).otherwise(F.try_make_timestamp(y, m, d, zero, zero, zero).cast("date"))


def month_start(month_name, year) -> Column:
    """First day of a month given as "Jan" and a year; NULL for unknown names."""
    name, digits = as_col(month_name), as_col(year).cast("string")
    text = F.concat(name, F.lit("-"), digits, F.lit("-1"))
    # the usual names and years are looked up, which costs a fraction of reading the text
    at, y = F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), name), digits.try_cast("int")
    plain = (F.length(name) == 3) & (at % 3 == 1) & (F.length(digits) == 4) & (y >= 1000)
    return F.when(plain, F.make_date(y, F.floor(at / 3).cast("int") + 1, F.lit(1))).otherwise(F.try_to_timestamp(text, F.lit("MMM-yyyy-d")).cast("date"))


def local_date(ts, zone) -> Column:
    """Calendar date of an instant in the time zone held by a column."""
    return F.to_date(F.from_utc_timestamp(as_col(ts), as_col(zone)))


def quarter_with_year(d) -> Column:
    """2024-02-10 -> 2024.1"""
    d = as_col(d)
    return F.year(d) + F.quarter(d) / 10


def months_before(as_of, months: int) -> Column:
    return F.add_months(day(as_of), -months)


def month_floor_years_before(as_of, years: int) -> Column:
    """First day of the current month, some years back."""
    return F.add_months(F.trunc(day(as_of), "month"), -12 * years)


def active_on(start, end, as_of) -> Column:
    """start <= as_of < end; FALSE when a bound is NULL."""
    return F.coalesce((as_col(start) <= day(as_of)) & (as_col(end) > day(as_of)), F.lit(False))
