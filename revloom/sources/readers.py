"""Landed files, catalog tables and external SQL tables as DataFrames."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.text import extract_or_null
from revloom.operators.schema import clean_names, converted_currency


def jdbc_split(spark: SparkSession, url: str, table: str, column: str, partitions: int, **options: str) -> dict[str, str]:
    """Options that read a table in `partitions` ranges of a whole-number column, whose bounds one aggregate finds."""
    bounds = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}", **options).load().first()
    return split_options(column, bounds[0], bounds[1], partitions)


def split_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Reader options for a range read; none for an empty table. The upper bound is past the last value."""
    if lower is None:
        return {}
    n = max(1, min(partitions, int(upper) - int(lower) + 1))
    return {"partitionColumn": column, "lowerBound": str(int(lower)), "upperBound": str(int(upper) + 1), "numPartitions": str(n)}


def quantile_query(table: str, column: str, partitions: int) -> str:
    """SQL for the first value of each of `partitions` even parts of a table, by window functions that databases share."""
    return f"SELECT MIN({column}) AS border FROM (SELECT {column}, NTILE({partitions}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL) parts GROUP BY part"


def range_predicates(column: str, borders: list) -> list[str]:
    """Conditions that part a table at the borders (dates, times, texts or numbers), each row in one; missing keys are in the first.

    They are compared by the database alone, so its own order of texts holds. Equal borders are one; none give one condition.
    """
    def literal(value) -> str:
        if isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool):
            return str(value)
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, dt.datetime) else str(value)
        return "'" + text.replace("'", "''") + "'"

    cuts = list(dict.fromkeys(literal(b) for b in borders if b is not None))[1:]  # the first part begins with what there is
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_sql_table(
    spark: SparkSession, url: str, table: str, *, key: str | None = None, quantiles: str | None = None, partitions: int | None = None, fetch: int = 10_000,
    **options: str,
) -> DataFrame:
    """External SQL table over JDBC, in parallel, as many ranges as the session shuffles into.

    `key`: a whole-number column, cut into ranges of one width. `quantiles`: a column of dates, times or texts, cut where the
    database finds even parts. A table without either is read by one task.
    """
    options = {"fetchsize": str(fetch), **options}
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if quantiles:
        found = spark.read.format("jdbc").options(url=url, query=quantile_query(table, quantiles, n), **options).load()
        borders = [r[0] for r in found.orderBy("border").collect()]  # one per range
        return spark.read.jdbc(url, table, predicates=range_predicates(quantiles, borders), properties=options)
    split = jdbc_split(spark, url, table, key, n, **options) if key else {}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **split, **options).load()


def read_files(spark: SparkSession, path: str | list[str], fmt: str = "parquet", schema=None, **options: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Lazy SQL over catalog tables and the frames given as {name}."""
    return spark.sql(sql, **tables)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, *, multi_line: bool = True) -> DataFrame:
    """JSON payloads. Keep `multi_line` for one document per file; line-delimited files split better without.

    One large array is read in parallel by `read_json_array`.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


#: Pieces of a file, each up to a closing brace, in one cut; tasks for the cuts of a split.
CUT_PIECES, TASKS_PER_SPLIT = 1 << 15, 8


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType | str, alias: str = "record") -> DataFrame:
    """Records of files that each hold one JSON array of objects, as a struct `alias`, with `file` and their `number` (from 0) in it.

    A file of any size is read by as many tasks as it has splits, and its pieces are dealt to more. It is cut at closing braces. Whether one
    ends a record depends on what came before, so each cut of CUT_PIECES pieces says how many quotes it holds and how deep it leads, for a
    start inside a string and for one outside; summed over the cuts before, that tells where each one starts, and a window over a cut
    does the rest. A record is put together from its pieces, also across cuts. Text behind the last whole record that opens another one is a record too,
    unreadable and therefore NULL; an empty array gives no rows.
    """
    pieces = spark.read.option("lineSep", "}").text(path)
    # a split in cuts of consecutive pieces, so that a window holds a bounded number of them whatever the size of a split
    split, of_file = ["file", "_block", "_cut"], ["_block", "_cut"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_SPLIT * pieces.rdd.getNumPartitions())
    pieces = pieces.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    pieces = pieces.withColumn("_cut", F.expr(f"_id div {CUT_PIECES}")).repartition(tasks, *split)
    bare = F.regexp_replace("value", r"\\.", "")  # without escaped characters, which only strings have
    in_order = Window.partitionBy(*split).orderBy("_id")
    before, upto = in_order.rowsBetween(Window.unboundedPreceding, -1), in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def deeper(inside: Column, text: Column) -> Column:
        """Braces that a piece opens outside strings, less the one behind it if that is no text."""
        outside = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), text)).otherwise(text), '"[^"]*("|$)', "")
        ends_inside = (_quotes(text) + inside.cast("int")) % 2 == 1
        return F.length(outside) - F.length(F.replace(outside, F.lit("{"))) - F.when(ends_inside, 0).otherwise(1)

    # relative to the start of the split: whether an odd number of quotes came before
    odd = (F.coalesce(F.sum(_quotes(F.col("_bare"))).over(before), F.lit(0)) % 2) == 1
    pieces = pieces.withColumn("_bare", bare).withColumn("_odd", odd)
    pieces = pieces.withColumns({"_out": deeper(F.col("_odd"), F.col("_bare")), "_in": deeper(~F.col("_odd"), F.col("_bare"))})
    splits = pieces.groupBy(*split).agg(F.sum(_quotes(F.col("_bare"))).alias("quotes"), F.sum("_out").alias("out"), F.sum("_in").alias("in"))
    earlier = Window.partitionBy("file").orderBy(*of_file).rowsBetween(Window.unboundedPreceding, -1)  # a row per cut
    splits = splits.withColumn("_inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    splits = splits.withColumn("_deep", F.coalesce(F.sum(F.when(F.col("_inside"), F.col("in")).otherwise(F.col("out"))).over(earlier), F.lit(0)))
    known = pieces.join(splits.select(*split, "_inside", "_deep"), split)
    step = F.when(F.col("_inside"), F.col("_in")).otherwise(F.col("_out"))
    known = known.withColumn("_step", step).withColumn("_depth", F.col("_deep") + F.sum("_step").over(upto))
    closes = (_quotes(F.col("_bare")) + (F.col("_inside") != F.col("_odd")).cast("int")) % 2 == 0
    known = known.withColumn("_ends", (closes & (F.col("_depth") == 0)).cast("int")).withColumn("_first", F.coalesce(F.sum("_ends").over(before), F.lit(0)))
    ends = known.groupBy(*split).agg(F.sum("_ends").alias("n")).withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    known = known.join(ends.select(*split, "_before"), split).withColumn("number", F.col("_first") + F.col("_before"))
    whole = known.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_id", "value"))).alias("parts"), F.max("_ends").alias("_ends"))
    text = F.concat(F.array_join(F.col("parts.value"), "}"), F.when(F.col("_ends") == 1, "}").otherwise(""))
    text = F.regexp_replace(text, "^[\\s,\\[\ufeff]+", "")
    whole = whole.select("file", "number", text.alias("_text")).where(F.startswith("_text", F.lit("{")))
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return whole.select("file", "number", F.from_json("_text", kind).alias(alias))


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"')))


def read_json_with_path(spark: SparkSession, path: str, schema, pattern: str, names: list[str], **kw) -> DataFrame:
    """JSON payloads whose request parameters are in the file path: group i of `pattern` becomes column names[i]."""
    df = read_json(spark, path, schema, **kw).select("*", F.col("_metadata.file_path").alias("_path"))
    # paths are percent-encoded: "Job%20Runs" is the activity "Job Runs"
    parts = {n: F.url_decode(extract_or_null("_path", pattern, i + 1)) for i, n in enumerate(names)}
    return df.withColumns(parts).drop("_path")


def read_csv_report(spark: SparkSession, path: str, schema, loaded_at, zone: str = "America/New_York") -> DataFrame:
    """CSV report with a header; `now` is the load time on the clock of `zone`."""
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return df.withColumn("now", F.from_utc_timestamp(F.lit(str(loaded_at)).cast("timestamp"), zone))


def read_range(spark: SparkSession, path: str, schema, required: str) -> DataFrame:
    """Spreadsheet range landed as CSV: header row, rows without the required date dropped."""
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return df.dropna(subset=[required])


def read_object(df: DataFrame, fields: list[tuple[str, str]], *, rates: DataFrame | None = None, clean: bool = True) -> DataFrame:
    """CRM object with all declared fields (name, type) and a converted twin per currency field.

    `rates` holds IsoCode, ConversionRate; rows carry CurrencyIsoCode.
    """
    out = df.select(*[F.col(f"`{n}`") for n, _ in fields])
    if rates is not None and any(kind == "currency" for _, kind in fields):
        rate = rates.select(F.col("IsoCode").alias("CurrencyIsoCode"), F.col("ConversionRate").alias("_rate"))
        out = converted_currency(out.join(rate, "CurrencyIsoCode", "left"), fields, "_rate").drop("_rate")
    return clean_names(out) if clean else out
