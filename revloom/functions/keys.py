"""Record keys built from several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revloom.functions.text import as_col


def text_key(*cols, sep: str = "") -> Column:
    """Parts pasted together, a NULL part as "NA". Whole-number doubles print as integers.

    Without a separator different parts may give one text ("1"+"23", "12"+"3"); `hash_key` does not.
    """
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("NA")) for c in cols])


def count_text(c) -> Column:
    """A count as key text: 100000, never 1.0E5."""
    return as_col(c).cast("bigint").cast("string")


def hash_key(*cols) -> Column:
    """Collision-safe, null-safe key of typed parts."""
    parts = [F.coalesce(F.concat(F.lit("v"), as_col(c).cast("string")), F.lit("n")) for c in cols]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def same(left: list[Column], right: list[Column]) -> Column:
    """Null-safe equality of two column lists, as a join condition Spark can still hash."""
    cond = left[0].eqNullSafe(right[0])
    for x, y in zip(left[1:], right[1:], strict=True):
        cond = cond & x.eqNullSafe(y)
    return cond
