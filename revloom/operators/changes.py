"""Incremental loads, change sets and their audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.operators.joins import absent_from, left_lookup, present_in
from revloom.operators.schema import union_fill
from revloom.operators.windows import first_per_key


def new_only(source: DataFrame, target: DataFrame, on: list, *, unique: bool = False, once: bool = False) -> DataFrame:
    """Rows whose key is not loaded yet. `unique`: the target holds every key once.

    `once`: of several rows with a key, which both sides name alike, only the one that `keep_one` takes. Loaded keys go ahead of the rows
    then, and a key whose first row is a loaded one is left out: one shuffle, and copies of both sides are dropped before it.
    """
    if not once:
        return absent_from(source, target, on, unique=unique)
    kinds = {f.name: f.dataType for f in source.schema}
    loaded = target.select(*[F.col(f"`{k}`") for k in on], F.lit(True).alias("_loaded"))
    both = source.withColumn("_loaded", F.lit(False)).unionByName(loaded, allowMissingColumns=True)
    first = keep_one(both, on, [F.col("_loaded").desc(), *_by_all(source, on)])
    return first.where("NOT _loaded").select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in on else F.col(f"`{c}`") for c in source.columns])


def after_watermark(df: DataFrame, time: str, mark) -> DataFrame:
    """Rows with a time after the watermark, to the instant; everything when there is no watermark."""
    return df if mark is None else df.where(F.col(time) > F.lit(mark))


def watermark(target: DataFrame, time: str):
    """Newest loaded time, None for an empty target. One value comes to the driver."""
    return target.agg(F.max(time)).first()[0]


def change_set(before: DataFrame, after: DataFrame, key: str, compare: list[str] | None = None) -> DataFrame:
    """One row per key with `action`: insert, update, noop or delete, and the new values (old ones for a delete).

    One aggregation over both sides together, combined before the shuffle, so a hot key is no hot task. Of several rows of a
    side with the same key the one with the largest compared values counts; NULL is a key like others.
    """
    compare = [c for c in after.columns if c != key] if compare is None else compare
    kinds = {f.name: f.dataType for f in after.schema}

    def side(df: DataFrame, name: str) -> DataFrame:
        values = F.struct(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in compare])
        return df.select(F.col(f"`{key}`").cast(kinds[key]).alias(key), values.alias(name))

    stacked = side(before, "_old").unionByName(side(after, "_new"), allowMissingColumns=True)
    both = stacked.groupBy(key).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    old, new = F.col("_old"), F.col("_new")
    action = (
        F.when(new.isNull(), "delete").when(old.isNull(), "insert")
        .when(new.eqNullSafe(old), "noop").otherwise("update")
    )
    row = F.coalesce(new, old)
    return both.select(key, action.alias("action"), *[row[c].alias(c) for c in compare])


def keep_one(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """First row per key in `order`; without an order by all other columns, so the choice is repeatable."""
    return first_per_key(df, keys, order or _by_all(df, keys))


def _by_all(df: DataFrame, keys: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]


def apply_change_set(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target after the change set. Rows the change set does not name stay."""
    live = changes.where("action <> 'delete'").drop("action")
    return union_fill(absent_from(target, changes, [key], unique=True), live.select(*target.columns))


def changed_only(before: DataFrame, after: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Rows of `after` for which `before` has no row with the same key and values."""
    return absent_from(after, before.select(key, *values), [key, *values])


def null_out_stale(target: DataFrame, upload: DataFrame, key: str, marker: str, clear: list[str]) -> DataFrame:
    """The upload plus the target rows with a `marker` value that it leaves out, their `clear` columns NULL.

    One row per key, by one aggregation over both. Of several upload rows with the same key the one with the largest values
    is sent. Columns that only the upload has are NULL on stale rows.
    """
    others = [c for c in upload.columns if c != key]
    kinds = dict(upload.dtypes)
    sent = upload.select(key, F.struct(*others).alias("_sent"))
    known = F.struct(*[
        F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in target.columns and c not in clear else F.lit(None).cast(kinds[c]).alias(c) for c in others
    ])
    stale = target.where(F.col(marker).isNotNull()).select(key, known.alias("_stale"))
    both = sent.unionByName(stale, allowMissingColumns=True).groupBy(key).agg(F.max("_sent").alias("_sent"), F.max("_stale").alias("_stale"))
    row = F.coalesce("_sent", "_stale")
    return both.select(*[F.col(key) if c == key else row[c].alias(c) for c in upload.columns])


def zero_out_stale(target: DataFrame, upload: DataFrame, key: str, value: str) -> DataFrame:
    """Target keys that are in the upload or hold a positive value, with the upload's sum (0 without one)."""
    stacked = target.select(key, F.col(value).alias("_old"), F.lit(1).alias("_here")).unionByName(
        upload.select(key, F.col(value).alias("_new"), F.lit(1).alias("_sent")), allowMissingColumns=True
    )
    both = stacked.groupBy(key).agg(F.max("_old").alias("_old"), F.sum("_new").alias("_new"), F.max("_here").alias("_here"), F.max("_sent").alias("_sent"))
    used = F.col("_here").isNotNull() & (F.col("_sent").isNotNull() | (F.col("_old") > 0)) & F.col(key).isNotNull()
    return both.where(used).select(key, F.coalesce("_new", F.lit(0.0)).alias(value))


def failed_rows(results: DataFrame, sources: DataFrame, on: tuple[str, str], error: str, keys: list[str]) -> DataFrame:
    """Rejected rows of an upload with the distinct source keys they came from."""
    unique = sources.select(on[1], *keys).distinct()
    return left_lookup(results.where(F.col(error).isNotNull()), unique, [on], {k: k for k in keys})


def audit_trail(
    before: DataFrame, upload: DataFrame, results: DataFrame, run_id: str, notes: str | None = None, *,
    insert: bool = False, key: str = "id",
) -> dict[str, DataFrame]:
    """What a CRM update leaves behind: rows before, rows sent, results per id with errors as text, notes.

    An update may only touch existing rows, so sent rows without a `before` row are refused and listed under
    `rejected`; with `insert` (an upsert) every row is sent.
    """
    stamp = F.lit(run_id).alias("run_id")
    sent = upload if insert else present_in(upload, before, [key])
    refused = upload.limit(0) if insert else absent_from(upload, before, [key])
    spark = before.sparkSession
    errors = results
    if dict(results.dtypes).get("errors", "string") != "string":
        errors = results.withColumn("errors", F.to_json("errors"))
    note_rows = [] if notes is None else [(notes,)]
    text = spark.createDataFrame(note_rows, "notes string").select(stamp, "notes")
    out = {"before": before, "upload": sent, "results": errors, "rejected": refused}
    return {**{name: df.select(stamp, "*") for name, df in out.items()}, "notes": text}
