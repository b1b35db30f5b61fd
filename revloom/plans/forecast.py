"""Cumulative forecasts to daily rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.dates import day
from revloom.functions.numbers import null_subtract
from revloom.operators.reshape import unpivot_prefix
from revloom.operators.schema import assign_where
from revloom.operators.windows import daily_difference, fitted_days, running_total

# How the rates are reported.
BOOKING_TYPES = {"new": "New", "expansion": "Expansion", "flip": "Flips - Maintenance"}


def daily_rates(sheet: DataFrame, as_of, *, version: int = 1, series: list[str] = ()) -> DataFrame:
    """One row per day, booking type and non-zero rate.

    sheet: order_date, new_forecast, new_actual, expansion_forecast, expansion_actual, flips_forecast, flips_actual,
    and the `series` columns when it holds several forecasts; rows of one day are summed. A forecast in the past or below its actual is 0.
    Flips lose their actuals: version 1 on every day and never below 0, version 2 on past days only.
    """
    series = list(series)
    amounts = [c for c in sheet.columns if c not in (*series, "order_date")]
    rows = sheet.where(F.col("order_date").isNotNull()).groupBy(*series, F.to_date("order_date").alias("order_date"))
    rows = rows.agg(*[F.sum(c).alias(c) for c in amounts])
    lagged = {"f_new": "new_forecast", "f_expansion": "expansion_forecast", "f_flip": "flips_forecast"}
    rows = daily_difference(rows, series, "order_date", lagged)
    past = F.col("order_date") < day(as_of)
    rows = assign_where(rows, "f_new", (F.col("new_forecast") < F.col("new_actual")) | past, 0.0)
    rows = assign_where(rows, "f_expansion", (F.col("expansion_forecast") < F.col("expansion_actual")) | past, 0.0)
    net = F.bround(null_subtract("f_flip", "flips_actual"), 2)
    if version == 1:
        rows = rows.withColumn("f_flip", F.greatest(net, F.lit(0.0)))
    else:
        rows = assign_where(rows, "f_flip", past, net)
    long = unpivot_prefix(rows.select(*series, "order_date", "f_new", "f_expansion", "f_flip"), "f_", "booking_type", "forecast")
    label = F.create_map(*[F.lit(x) for pair in BOOKING_TYPES.items() for x in pair])
    return long.where(F.col("forecast") != 0).withColumn("booking_type", label[F.col("booking_type")])


def cumulative_fit(bookings: DataFrame, keys: list[str], date: str, amount: str) -> DataFrame:
    """Running total per key (fiscal year and type), its straight-line fit over the year and the residual."""
    total = running_total(bookings, keys, date, amount, "running")
    return fitted_days(total, keys, date, "running")
