"""Money text, null-tolerant arithmetic and ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from revloom.functions.text import as_col

# A plain decimal number. Spark's own cast would also take "1d" or "Infinity".
_NUMBER = r"^\s*[+]?(\d+\.?\d*|\.\d+)([eE][+]?\d+)?\s*$"


def _money_text_to_double(raw: Column, bare: Column) -> Column:
    """`bare` as a double; NULL where `raw` holds a minus sign or is no number."""
    return F.when(~F.contains(raw, F.lit("-")) & bare.rlike(_NUMBER), bare.try_cast("double"))


def scrub_usd(c) -> Column:
    """"USD 2,000.00" -> 2000.0. Any "-" makes the value NULL, so negatives are NULL too."""
    c = as_col(c)
    return _money_text_to_double(c, F.regexp_replace(c, "USD |,", ""))


def scrub_currency(c, iso_codes: list[str]) -> Column:
    """`scrub_usd` for every ISO code of the currency table."""
    c = as_col(c)
    pattern = "|".join([f"(?:{'|'.join(sorted(iso_codes))}) ", ","]) if iso_codes else ","
    return _money_text_to_double(c, F.regexp_replace(c, pattern, ""))


def format_money(c, digits: int = 2) -> Column:
    """1234.5 -> "$1,234.50"; a negative keeps its sign after the "$". NULL stays NULL."""
    return F.concat(F.lit("$"), F.format_number(as_col(c).cast("double"), digits))


def null_subtract(a, b) -> Column:
    """a - b with NULL read as 0 on either side."""
    return zero_if_null(a) - zero_if_null(b)


def zero_if_null(c) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def row_sum(*cols) -> Column:
    """Sum across columns of one row, NULLs skipped (0 when all are NULL)."""
    return reduce(lambda x, y: x + y, [zero_if_null(c) for c in cols])


def row_max(*cols) -> Column:
    """Largest of the columns; NULL as soon as one of them is NULL."""
    any_null = reduce(lambda x, y: x | y, [as_col(c).isNull() for c in cols])
    return F.when(~any_null, F.greatest(*[as_col(c) for c in cols]))


def row_argmax(cols: list, labels: list[str]) -> Column:
    """Label of the column holding the row maximum, the first one on ties; NULL as in `row_max`."""
    position = F.array_position(F.array(*[as_col(c) for c in cols]), row_max(*cols))
    return F.try_element_at(F.array(*[F.lit(x) for x in labels]), F.nullif(position, F.lit(0)).cast("int"))


def per_rate(amount, rate) -> Column:
    """Amount over its currency rate; NULL when the rate is missing or 0."""
    return F.try_divide(as_col(amount).cast("double"), as_col(rate).cast("double"))


def ratio_change(now, before) -> Column:
    """(now - before) / before, with anything/0 read as 1 (100 %) and 0/0 as 0."""
    now, before = as_col(now).cast("double"), as_col(before).cast("double")
    return (
        F.when((before == 0) & (now == 0), F.lit(0.0))
        .when(before == 0, F.lit(1.0))
        .otherwise(F.try_divide(now - before, before))
    )


def percent(ratio) -> Column:
    """Ratio as a percentage, rounded half-to-even to whole percents."""
    return F.bround(F.bround(as_col(ratio), 2) * 100, 0)


def sum_where(value, condition: Column) -> Column:
    """Aggregate: sum of `value` over rows meeting `condition`, 0 when there are none."""
    return F.coalesce(F.sum(F.when(condition, as_col(value))), F.lit(0))
