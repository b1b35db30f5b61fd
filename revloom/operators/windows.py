"""Latest rows, day-to-day rates and trailing comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revloom.functions.keys import same
from revloom.functions.numbers import percent, ratio_change, sum_where
from revloom.operators import scan


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in `order`.

    Spark turns the row-number filter into a per-partition limit before the shuffle, so a hot key sends
    one row per input partition. `order` should be total: end it with an id.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], time: str, *tiebreak: str) -> DataFrame:
    """Newest row per key, NULL times last, ties to the largest `tiebreak` columns, one after the other."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in (time, *tiebreak)])


def with_key_max(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """The key's largest `value` on every row.

    Aggregated first and joined back: the window form would pull a hot key into one task.
    """
    tops = df.groupBy(*keys).agg(F.max(value).alias(alias))
    l, r = df.alias("l"), tops.alias("r")
    on = same([F.col(f"l.`{k}`") for k in keys], [F.col(f"r.`{k}`") for k in keys])
    return l.join(r, on, "left").select("l.*", f"r.`{alias}`")


def lag_difference(df: DataFrame, series: list[str], order: list[str], values: dict[str, str], ranges: int | None = None) -> DataFrame:
    """Each value minus the one before it in its series, as {new column: value column}.

    The global order of series and `order` is cut into ranges by the number of rows; the last row of a range is carried into the next.
    `order` must be total within a series, or the result depends on which of equal rows comes first.
    """
    lagged = scan.with_previous(df, series, order, list(dict.fromkeys(values.values())), ranges)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in values]
    return lagged.select(*kept, *[(F.col(f"`{c}`") - F.col(f"`_lag_{c}`")).alias(n) for n, c in values.items()])


def daily_difference(df: DataFrame, series: list[str], day: str, values: dict[str, str]) -> DataFrame:
    """As lag_difference, for a table with one row per series and day: a window over a series is bounded by the calendar."""
    before = Window.partitionBy(*(series or [F.lit(0)])).orderBy(day)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in values]
    return df.select(*kept, *[(F.col(f"`{c}`") - F.lag(c).over(before)).alias(n) for n, c in values.items()])


def usage_change(
    df: DataFrame, account: str, date: str, value: str, *, recent: int = 31, earlier: int = 61, buffer: int = 1
) -> DataFrame:
    """Per account: usage of the trailing period, of the one before it, and the change in percent.

    The periods are anchored to the account's own last date D: [D-earlier-buffer, D-recent-buffer) and
    [D-recent-buffer, D). Rows are summed to one per account and day first, so the window over an account is
    bounded by the calendar however many rows a day has.
    """
    daily = df.groupBy(account, date).agg(F.sum(value).alias("_used"))
    last = F.max(date).over(Window.partitionBy(account))
    daily = daily.withColumn("_last", last)
    d = F.col(date)
    start = F.date_sub("_last", earlier + buffer)
    middle = F.date_sub("_last", recent + buffer)
    summed = daily.groupBy(account).agg(
        sum_where("_used", (d >= start) & (d < middle)).alias("earlier_usage"),
        sum_where("_used", (d >= middle) & (d < F.col("_last"))).alias("recent_usage"),
        F.max("_last").alias("last_submission"),
    )
    ratio = ratio_change("recent_usage", "earlier_usage")
    return summed.withColumns({"pct_change": ratio, "upload_change": percent(ratio)})


def running_total(df: DataFrame, keys: list[str], date: str, value: str, alias: str, ranges: int | None = None) -> DataFrame:
    """Cumulative sum per key over days, on a table summed to one row per key and day; a scan over ranges, as the differences are."""
    daily = df.groupBy(*keys, date).agg(F.sum(value).alias(value))
    return scan.running_sum(daily, keys, [date], value, alias, ranges)


def linear_fit(df: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """Least-squares line of `value` over the day number, per key, and the mean day of its rows."""
    x = F.unix_date(F.col(date)).cast("double")
    y = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.date_from_unix_date(F.floor(F.avg(x)).cast("int")).alias("mean_date"),
    )


def fitted_days(df: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """A key's rows and every day of the year around its mean date, with the fitted line and the residual."""
    fit = linear_fit(df, keys, date, value)
    first = F.trunc("mean_date", "year")
    days = fit.select(*keys, F.explode(F.sequence(first, F.date_sub(F.add_months(first, 12), 1))).alias(date))
    spine = df.select(*keys, date, value).unionByName(days, allowMissingColumns=True)
    spine = spine.groupBy(*keys, date).agg(F.max(value).alias(value))
    l, r = spine.alias("l"), fit.alias("r")
    predicted = F.col("r.intercept") + F.col("r.slope") * F.unix_date(F.col(f"l.`{date}`"))
    on = same([F.col(f"l.`{k}`") for k in keys], [F.col(f"r.`{k}`") for k in keys])
    return l.join(r, on, "left").select(
        "l.*", predicted.alias("predicted"), (F.col(f"l.`{value}`") - predicted).alias("diff")
    )
