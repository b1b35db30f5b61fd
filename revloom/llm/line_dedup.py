"""Removal of lines that many sites share, by the spread of each line over distinct sites.

A line's sites are counted by a HyperLogLog sketch that Spark merges before and after the shuffle. Where the estimate is
near the threshold, the sites are counted exactly. Only built-in functions; a line travels as two 64 bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import as_row, folder, own_name, stored

#: log2 of a sketch's registers: a standard error of 1.6 %.
REGISTERS = 12
#: Estimates within this share of the threshold, six standard errors, and at least one, are counted exactly.
NEAR = 0.1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _row_key() -> list[Column]:
    """What tells rows apart, but for a chance of 2^-128 per pair."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2")]


def line_table(docs: DataFrame) -> DataFrame:
    """A row per line that is not blank: k1, k2 (of its row), place (unknown doc_id, doc_id, line number from 0), source, h1, h2 (of the line)."""
    each = docs.select(*_row_key(), "doc_id", "source", F.posexplode(_lines(F.col("text"))).alias("number", "value")).where(F.trim("value") != "")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "number").alias("place")
    return each.select("k1", "k2", place, "source", F.xxhash64("value").alias("h1"), F.xxhash64(F.lit(1), "value").alias("h2"))


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """The lines (h1, h2) that stand on `min_sites` distinct sources or more, with their first place."""
    sketch = F.hll_sketch_agg("source", F.lit(REGISTERS)).alias("sketch")
    counted = lines.groupBy("h1", "h2").agg(sketch, F.min("place").alias("first"), F.count("*").alias("n"))
    margin = max(1, round(NEAR * min_sites))
    # fewer occurrences than that cannot be on so many sites
    likely = counted.where(F.col("n") >= min_sites).select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("about"))
    likely = stored(likely.where(F.col("about") >= min_sites - margin), f"{folder(lines.sparkSession)}/likely")
    near = F.col("about") <= min_sites + margin
    sites = lines.join(likely.where(near).select("h1", "h2"), ["h1", "h2"]).select("h1", "h2", "source").distinct()
    exact = sites.groupBy("h1", "h2").agg(F.count("source").alias("sites")).where(F.col("sites") >= min_sites)
    return likely.where(~near).select("h1", "h2", "first").union(likely.where(near).join(exact, ["h1", "h2"], "left_semi").select("h1", "h2", "first"))


def without_spread_lines(docs: DataFrame, min_sites: int = 10) -> DataFrame:
    """docs with the lines removed that stand on `min_sites` sites (distinct sources) or more, but for their first place.

    docs: doc_id, text, source and any other columns, kept as they are, plus n_lines and n_removed (long), which get an underscore
    behind their names where docs has such columns. The first place
    of a line is the smallest (doc_id, line number), null doc_ids last, so each text stays somewhere; rows equal in doc_id
    keep the line alike. Lines are what line feeds part and are compared as they stand; blank ones are never removed. A null
    source is no site. A null text stays null with 0 lines, an empty one has one blank line; where all lines go, the text is
    empty. Repeated rows are treated alike. An empty table gives no rows.
    """
    place = folder(docs.sparkSession)
    lines = stored(line_table(docs), f"{place}/lines")
    spread = stored(spread_lines(lines, min_sites), f"{place}/spread")
    cut = lines.join(spread, ["h1", "h2"]).where(F.col("place") != F.col("first"))
    cut = stored(cut.groupBy("k1", "k2").agg(F.collect_set("place.number").alias("gone")), f"{place}/cut")
    # documents are dealt by key however little is cut: a plan that follows the size of `cut` would jump with the input
    found = docs.select(as_row(docs).alias("row"), *_row_key()).hint("merge").join(cut, ["k1", "k2"], "left")
    gone = F.col("gone")
    text = F.col("row.text")

    def staying(lines: Column) -> Column:
        """By set difference of line numbers, in time that grows with the lines alone."""
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n")

    # the lines in a list of one, so that they are parted once, and only where some go
    left = F.get(F.transform(F.array(_lines(text)), staying), F.lit(0))
    return found.select(
        *[F.when(gone.isNotNull(), left).otherwise(text).alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias(own_name("n_lines", docs.columns)),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias(own_name("n_removed", docs.columns)),
    )
