"""Telemetry documents to typed parent and child tables, new documents only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.dates import from_millis, from_seconds, millis_or_epoch, parse_or_epoch
from revloom.operators.changes import new_only
from revloom.operators.reshape import child_table, json_schema, lists_to_text, parse_json, parse_variant, readable, unreadable, variant_field, variant_rows
from revloom.operators.schema import clean_names, flatten

KEY = "product_statistics_id"


def repair_dates(table: DataFrame, columns: list[str], millis: bool = False) -> DataFrame:
    """Date columns parsed, from text or from epoch millis; what cannot be read becomes 1970-01-01."""
    fix = millis_or_epoch if millis else parse_or_epoch
    return table.withColumns({c: fix(c) for c in columns})


def _without(schema: T.StructType, *names: str) -> list[str]:
    return [f.name for f in schema if f.name not in names]


def _struct_at(schema: T.StructType, name: str) -> T.StructType | None:
    """Struct type of a field that is a struct or a list of structs; None where the documents have no such field."""
    if name not in schema.names:
        return None
    kind = schema[name].dataType
    kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return kind if isinstance(kind, T.StructType) else None


def _own_fields(docs: DataFrame, doc: str, *children: str) -> DataFrame:
    """The document's own fields without its children, one row per document."""
    names = _without(docs.schema[doc].dataType, *children)
    rows = docs.select(KEY, *[F.col(f"{doc}.`{n}`") for n in names])
    return lists_to_text(clean_names(flatten(rows)))


def _child(docs: DataFrame, path: str, drop: tuple[str, ...] = ()) -> DataFrame | None:
    """Child table at `path`, with `drop` removed from its items; None when the schema has no such child."""
    holder, _, name = path.rpartition(".")
    found = _struct_at(docs.select(f"{holder}.*").schema if holder else docs.schema, name)
    if found is None:
        return None
    item = F.col(path)
    if drop:
        cut = [d for d in drop if d in found.names]
        is_list = isinstance(docs.select(item).schema[0].dataType, T.ArrayType)
        if cut:
            item = F.transform(item, lambda x: x.dropFields(*cut)) if is_list else item.dropFields(*cut)
    return child_table(docs.select(KEY, item.alias("child")), [KEY], "child")


def _converted(table: DataFrame | None, fixes: dict[str, Column]) -> DataFrame | None:
    if table is None:
        return None
    return table.withColumns({n: e for n, e in fixes.items() if n in table.columns})


def new_documents(source: DataFrame, loaded: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Documents not loaded yet, parsed. Persist it: all tables of a family and the quarantine are made from it.

    source: id, creationDate, data (JSON text). Without a schema the union of all documents' fields is used.
    """
    fresh = new_only(source, loaded, [("id", KEY if KEY in loaded.columns else "id")], unique=True)
    return parse_json(fresh, "data", schema or json_schema(fresh, "data")).withColumnRenamed("id", KEY)


def quarantine(parsed: DataFrame) -> DataFrame:
    """Documents that are no readable JSON object."""
    return unreadable(parsed, "data")


def servers(parsed: DataFrame) -> dict[str, DataFrame]:
    """First family (creation in epoch millis): data, server, server domain and gateway rows per document.

    `documents` lists the ids and is to be written last: an interrupted load then simply runs again.
    """
    docs = readable(parsed, "data")
    master = _own_fields(docs, "doc", "serverData", "gatewayData")
    master = _converted(master, {"creationDate": from_millis("creationDate")})
    server_type = _struct_at(docs.schema["doc"].dataType, "serverData")
    domains = None
    if server_type is not None and "domainData" in server_type.names:
        is_list = isinstance(docs.schema["doc"].dataType["serverData"].dataType, T.ArrayType)
        nested = F.col("doc.serverData.domainData")
        deep = is_list and isinstance(server_type["domainData"].dataType, T.ArrayType)
        domains = _child(docs.select(KEY, (F.flatten(nested) if deep else nested).alias("domain")), "domain")
    tables = {
        "data": master,
        "server": _child(docs, "doc.serverData", ("domainData",)),
        "server_domain": domains,
        "gateway": _child(docs, "doc.gatewayData"),
        "documents": docs.select(F.col(KEY).alias("id"), from_millis("creationDate").alias("creationDate")),
    }
    return {n: t for n, t in tables.items() if t is not None}


def nodes(parsed: DataFrame) -> dict[str, DataFrame]:
    """Second family (times in epoch seconds): nine tables. `product_statistics` holds the ids: write it last."""
    docs = readable(parsed, "data")
    master = _own_fields(docs, "doc", "auth", "config", "events", "interfaces", "status", "sync")
    tables = {
        "sync": _child(docs, "doc.sync"),
        "status": _converted(
            _child(docs, "doc.status"),
            {n: from_seconds(n) for n in ("intervalEndTime", "intervalStartTime", "serverStartedTime")},
        ),
        "interfaces": _child(docs, "doc.interfaces"),
        "events": _converted(_child(docs, "doc.events", ("rules",)), {"sinkCount": F.col("sinkCount").try_cast("int")}),
        "event_rules": _nested(docs, "doc.events", "rules"),
        "config": _converted(_child(docs, "doc.config"), {"general_installedDate": from_seconds("general_installedDate")}),
        "auth_list": _nested(docs, "doc.auth", "authList"),
        "auth": _child(docs, "doc.auth", ("authList",)),
        "product_statistics": _converted(master, {"creationDate": from_seconds("creationDate")}),
    }
    return {n: t for n, t in tables.items() if t is not None}


def _nested(docs: DataFrame, path: str, name: str) -> DataFrame | None:
    """Child list `name` of the child at `path`, when the schema has both."""
    top = path.split(".")[-1]
    holder = _struct_at(docs.schema["doc"].dataType, top)
    if holder is None or name not in holder.names:
        return None
    return _child(docs, f"{path}.{name}")


# Documents kept as VARIANT: the caller declares the names, so no pass over the documents looks for them.

def new_variants(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Documents not loaded yet, as VARIANT; `doc` is NULL for those that are no readable JSON object. Store it before use."""
    fresh = new_only(source, loaded, [("id", KEY if KEY in loaded.columns else "id")], unique=True)
    return parse_variant(fresh, "data").withColumnRenamed("id", KEY)


def declared(parsed: DataFrame, tables: dict[str, tuple[list[str], dict[str, str]]]) -> dict[str, DataFrame]:
    """Child tables {name: (path of lists, fields)} of `new_variants`; an empty path is the document itself."""
    docs = parsed.where(F.col("doc").isNotNull())
    out = {}
    for name, (path, fields) in tables.items():
        if path:
            out[name] = variant_rows(docs, [KEY], path, fields)
        else:
            out[name] = docs.select(KEY, *[variant_field("doc", p, kind).alias(p.replace(".", "_")) for p, kind in fields.items()])
    return out
