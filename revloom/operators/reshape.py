"""JSON documents to tables, parents to children, wide to long."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.keys import same
from revloom.operators.schema import clean_names, flatten

BAD = "_corrupt_record"


#: In a variant's schema: a quoted name, or a type that has another name in a table's schema.
_TYPES = re.compile(r"`(?:[^`]|``)*`|OBJECT(?=<)|(?:(?<=: )|(?<=ARRAY<))VOID(?=[,>]|$)")


def json_schema(df: DataFrame, column: str) -> T.StructType:
    """Union schema of the JSON objects in a column, found in one pass over all of them; none give a struct without fields.

    Other documents, lists and bare values among them, have no say: `unreadable` finds them.
    """
    doc = F.try_parse_json(F.when(_is_object(F.col(column)), F.col(column)))
    found = df.agg(F.schema_of_variant_agg(doc)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    table = _TYPES.sub(lambda m: {"OBJECT": "STRUCT", "VOID": "STRING"}.get(m[0], m[0]), found)
    return T.StructType.fromDDL(table[len("STRUCT<"):-1])


def _is_object(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\s*\{"), F.lit(False))


def parse_json(df: DataFrame, column: str, schema: T.StructType, alias: str = "doc") -> DataFrame:
    """The document as a struct next to its text. Take the result through `readable` or `unreadable`.

    Persist it when several tables are made from it: it is the one place where the text is parsed.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return df.withColumn(alias, F.from_json(F.col(column), with_bad, {"columnNameOfCorruptRecord": BAD}))


def readable(parsed: DataFrame, column: str, alias: str = "doc") -> DataFrame:
    """Rows whose text was such a document."""
    return parsed.where(~_broken(column, alias)).withColumn(alias, F.col(alias).dropFields(BAD))


def unreadable(parsed: DataFrame, column: str, alias: str = "doc") -> DataFrame:
    """Rows whose text was none, for quarantine."""
    return parsed.where(_broken(column, alias)).drop(alias)


def _broken(column: str, alias: str) -> Column:
    return F.col(column).isNull() | F.col(alias)[BAD].isNotNull() | ~_is_object(F.col(column))


def json_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Top-level fields {name: type} of a JSON text column as columns."""
    schema = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields.items()))
    doc = F.from_json(F.col(column), schema)
    return df.select("*", doc.alias("_doc")).select(*df.columns, *[F.col("_doc")[n].alias(n) for n in fields])


def child_rows(df: DataFrame, keys: list[Column | str], path: str, alias: str = "item") -> DataFrame:
    """One row per element of a nested list with its parent's keys. Missing or empty lists give no rows.

    The outer form keeps Spark from testing the list's size below the parse, which would parse every text again.
    """
    rows = df.select(*keys, F.posexplode_outer(F.col(path)).alias("_pos", alias))
    return rows.where("_pos IS NOT NULL").drop("_pos")


def child_table(df: DataFrame, keys: list[Column | str], path: str) -> DataFrame:
    """`child_rows` of structs, flattened to columns and with clean names.

    A single struct counts as a list of one; lists left inside become JSON text.
    """
    kind = _type_at(df.schema, path)
    if isinstance(kind, T.ArrayType):
        rows = child_rows(df, keys, path)
    else:
        rows = df.where(F.col(path).isNotNull()).select(*keys, F.col(path).alias("item"))
    names = [c for c in rows.columns if c != "item"]
    return lists_to_text(clean_names(flatten(rows.select(*names, "item.*"))))


def parse_variant(df: DataFrame, column: str, alias: str = "doc") -> DataFrame:
    """The document as a VARIANT next to its text, NULL where the text is no JSON object. Nothing is inferred and no job runs.

    Store or persist it when several tables are made from it: it is the one place where the text is parsed.
    """
    return df.withColumn(alias, F.try_parse_json(F.when(_is_object(F.col(column)), F.col(column))))


def variant_rows(df: DataFrame, keys: list[str], path: list[str], fields: dict[str, str], alias: str = "doc") -> DataFrame:
    """One row per element of the list at `path` of a VARIANT, with its parent's keys and the `fields` {path in it: type}.

    Each name of `path` leads from an element to a list in it; a single object counts as a list of one; missing and empty lists give no rows. A
    field's column is named after its path with "_" for dots; type `json` is the value as JSON text. What cannot be read as its type
    is NULL, and fields that no one declares cost nothing.
    """
    item = alias
    rows = df.select(*keys, F.col(alias))
    for name in path:
        whole = F.try_variant_get(item, f"$.{name}", "variant")
        single = F.try_variant_get(item, f"$.{name}", "map<string,variant>").isNotNull()
        each = F.coalesce(F.try_variant_get(item, f"$.{name}", "array<variant>"), F.when(single, F.array(whole)))
        # the outer form keeps Spark from testing the list's size in a filter of its own
        rows = rows.select(*keys, F.posexplode_outer(each).alias("_pos", "_item")).where("_pos IS NOT NULL").drop("_pos")
        item = "_item"
    return rows.select(*keys, *[variant_field(item, p, kind).alias(p.replace(".", "_")) for p, kind in fields.items()])


def variant_field(variant: str, path: str, kind: str) -> Column:
    if kind == "json":
        return F.to_json(F.try_variant_get(variant, f"$.{path}", "variant"))
    return F.try_variant_get(variant, f"$.{path}", kind)


def lists_to_text(df: DataFrame) -> DataFrame:
    """Remaining array and map columns as JSON text under their own name."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType))]
    return df.withColumns({c: F.to_json(f"`{c}`") for c in nested}) if nested else df


def unpivot_prefix(df: DataFrame, prefix: str, name: str, value: str) -> DataFrame:
    """Columns starting with `prefix` to rows (name without the prefix, value). NULL values stay."""
    wide = [c for c in df.columns if c.startswith(prefix)]
    return _unpivot(df, [c for c in df.columns if c not in wide], {c: c[len(prefix):] for c in wide}, name, value)


def unpivot_except(df: DataFrame, ids: list[str], name: str, value: str) -> DataFrame:
    """Every column but `ids` to rows. NULL values stay."""
    return _unpivot(df, ids, {c: c for c in df.columns if c not in ids}, name, value)


def unpivot_map(df: DataFrame, column: str, name: str, value: str, per: list[str] = ()) -> DataFrame:
    """A map column to rows, as if each of its names had been a column: names a map lacks come with a NULL value.

    The names are those that the maps of all rows have, or with `per`, of the rows with the same values there (NULLs are equal). So an
    empty or a NULL map keeps its rows; only where no row has a name there are none.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    keys = df.select(*per, F.explode(F.map_keys(column)).alias("_name")).distinct().groupBy(*per).agg(F.array_sort(F.collect_list("_name")).alias("_names"))
    if per:
        l, r = df.alias("l"), keys.alias("r")
        named = l.join(r, same([F.col(f"l.`{k}`") for k in per], [F.col(f"r.`{k}`") for k in per])).select("l.*", "r._names")
    else:
        named = df.withColumn("_names", keys.scalar())
    long = named.select(*rest, F.col(column).alias("_map"), F.explode("_names").alias(name))
    return long.withColumn(value, F.try_element_at("_map", F.col(name))).drop("_map")


def _unpivot(df: DataFrame, ids: list[str], wide: dict[str, str], name: str, value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"`{c}`").alias("v")) for c, n in wide.items()])
    kept = [F.col(f"`{c}`") for c in ids]
    return df.select(*kept, F.explode(pairs).alias("_p")).select(
        *kept, F.col("_p.n").alias(name), F.col("_p.v").alias(value)
    )


def _type_at(schema: T.DataType, path: str) -> T.DataType:
    for part in path.split("."):
        schema = schema[part].dataType
    return schema
