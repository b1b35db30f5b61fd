"""History of opportunity snapshots whose columns changed over time."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.numbers import per_rate
from revloom.operators.changes import after_watermark
from revloom.operators.joins import absent_from, left_lookup
from revloom.operators.schema import override_by_id, typed_nulls

#: Schemas read from files at a time.
SCHEMA_READERS = 16

# Converted amounts and what they are made of, and the columns taken as they are.
AMOUNTS = {
    "first_year_value_usd": "billing_period_1_amount", "bookings_usd": "acv_bookings", "software_forecast_usd": "forecast",
    "software_usd": "software_bookings", "expansion_usd": "expansion_amount", "expansion_forecast_usd": "expansion_forecast",
}
PLAIN = [
    "id", "name", "close_date", "stage", "type", "renewal_category", "renewal_type", "expansion_type", "product", "category", "sao_date",
]


def load(spark: SparkSession, captures: DataFrame, loaded: DataFrame | None, pattern: str = ".*", time: str = "snapshot_time") -> DataFrame | None:
    """Rows of the captures that are not loaded yet, each stamped with its creation time; None when there are none.

    captures: the catalog's list (table_name, creation_time, path, and if the catalog knows it, schema as DDL) of stored Parquet
    tables, each a folder of files. Those whose name has the pattern and whose creation time `loaded` (the history, by its `time`
    column) does not hold are read, also several of one day. Captures of one schema are one scan, whatever their number; a
    file's folder says which capture it belongs to. A schema that is not in the list is read from the files by the driver. Columns that a
    capture lacks are NULL; a column has the type of the first capture that has it. The list comes to the driver: it names
    files, not rows.
    """
    due = captures.where(F.col("table_name").rlike(pattern))
    if loaded is not None:
        due = absent_from(due, loaded.select(time).distinct(), [("creation_time", time)], unique=True)
    listed = due.orderBy("creation_time", "table_name").collect()
    if "schema" in captures.columns:
        schemas = [T.StructType.fromDDL(c["schema"]) if c["schema"] else None for c in listed]
    else:
        schemas = [None] * len(listed)
    with ThreadPoolExecutor(SCHEMA_READERS) as readers:
        found = readers.map(lambda c, s: spark.read.parquet(c["path"]).schema if s is None else s, listed, schemas)
        alike: dict[tuple, list[Row]] = {}
        kinds: dict[str, T.DataType] = {}
        for c, schema in zip(listed, found, strict=True):
            fields = tuple((f.name, f.dataType) for f in schema if f.name != time)
            alike.setdefault(fields, []).append(c)
            for name, kind in fields:
                kinds.setdefault(name, kind)
    if not listed:
        return None
    stamps = spark.createDataFrame([(c["path"], c["creation_time"]) for c in listed], "path string, stamp timestamp")
    stamps = stamps.select(_place(F.col("path")).alias("_folder"), F.col("stamp").alias(time)).distinct()
    out = None
    for fields, group in alike.items():
        rows = spark.read.schema(T.StructType([T.StructField(n, k) for n, k in fields])).parquet(*[c["path"] for c in group])
        folder = _place(F.regexp_replace(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), "/[^/]*$", ""))
        rows = rows.select(*[F.col(f"`{n}`").cast(kinds[n]).alias(n) for n, _ in fields], folder.alias("_folder"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    names = [n for n in out.columns if n != "_folder"]
    return out.join(stamps, "_folder").select(*names, time)


def _place(path: Column) -> Column:
    """A path without scheme, host and slashes at its end, by which files and the list agree."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?|/+$", "")


def run(
    snapshots: DataFrame, rates: DataFrame, mark=None, overrides: dict[str, dict[str, object]] | None = None, time: str = "snapshot_time"
) -> DataFrame:
    """Rows of all snapshots dated after the watermark, amounts in USD, manual corrections applied; to be appended.

    snapshots: captures as one frame, as `load` reads them. A column no capture of the
    run has is NULL, as is one that only some have.
    """
    new = after_watermark(snapshots, time, mark)
    missing = {c: "double" for c in AMOUNTS.values() if c not in new.columns}
    missing |= {c: "string" for c in PLAIN if c not in new.columns}
    new = typed_nulls(new, missing) if missing else new
    live = left_lookup(new.where(~F.col("test")), rates, [("currency", "iso_code")], {"_rate": "rate"})
    usd = [per_rate(c, "_rate").alias(name) for name, c in AMOUNTS.items()]
    return override_by_id(live.select(*PLAIN, *usd, time).distinct(), "id", overrides or {})
