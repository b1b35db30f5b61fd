"""Column-level operators: names, selection, flattening, unions, conditional assignment."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.functions.numbers import per_rate
from revloom.functions.text import clean_name


def clean_names(df: DataFrame) -> DataFrame:
    """Warehouse-safe column names. Two names that clean to one are an error, not a lost column."""
    cleaned = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, cleaned, strict=True):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both clean to {new!r}")
        seen[new.lower()] = old
    return df.toDF(*cleaned)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Without the columns whose name matches `pattern` anywhere."""
    return df.drop(*[c for c in df.columns if re.search(pattern, c)])


def keep(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[_ref(c) for c in columns])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def prettify(df: DataFrame, special: dict[str, str] | None = None) -> DataFrame:
    """Report headings: "_" becomes a blank, then `special` replaces whole names."""
    spaced = [c.replace("_", " ") for c in df.columns]
    return df.toDF(*[(special or {}).get(c, c) for c in spaced])


def first_columns(df: DataFrame, *names: str) -> DataFrame:
    """`names` to the front, the rest in the order they had."""
    rest = [c for c in df.columns if c not in names]
    return keep(df, [*names, *rest])


def typed_nulls(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items()})


def constants(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


def assign_where(df: DataFrame, column: str, condition: Column, value) -> DataFrame:
    """`column` set to `value` where `condition` is true, untouched where it is false or NULL."""
    value = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def override_by_id(df: DataFrame, id_column: str, overrides: dict[str, dict[str, object]]) -> DataFrame:
    """Manual corrections {id: {column: value}}: a short list held in code or config."""
    changed: dict[str, Column] = {}
    for record_id, values in overrides.items():
        for name, value in values.items():
            kept = changed.get(name, F.col(name))
            changed[name] = F.when(F.col(id_column) == record_id, F.lit(value)).otherwise(kept)
    return df.withColumns(changed) if changed else df


def converted_currency(df: DataFrame, fields: list[tuple[str, str]], rate) -> DataFrame:
    """A `<name>_Converted` twin for every field whose declared type is currency."""
    twins = {f"{name}_Converted": per_rate(_ref(name), rate) for name, kind in fields if kind == "currency"}
    return df.withColumns(twins) if twins else df


def union_fill(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_fill(*frames).distinct()


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs spread into columns named by their path. Arrays and maps stay as they are."""
    columns = [F.col(_path(p)).alias(sep.join(p)) for p in _leaves(df.schema)]
    return df.select(*columns)


def nested_to_json(df: DataFrame, prefix: str = "_", first: tuple[str, ...] = ()) -> DataFrame:
    """Array, map and struct columns as JSON text in `<prefix><name>`, put last; `first` leads."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    plain = [_ref(c) for c in df.columns if c not in nested]
    texts = [F.to_json(_ref(c)).alias(prefix + c) for c in nested]
    out = df.select(*plain, *texts)
    return first_columns(out, *first) if first else out


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for field in schema:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def _path(parts: tuple[str, ...]) -> str:
    return ".".join(f"`{p}`" for p in parts)


def _ref(name: str) -> Column:
    return F.col(f"`{name}`")
