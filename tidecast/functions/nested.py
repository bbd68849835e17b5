"""Nested settings to dotted keys, by a walk over the schema."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def leaves(kind: T.DataType, value: Column, name: str = "") -> Iterator[tuple[str, Column]]:
    """(dotted key, column) of every leaf below a struct, of any depth, in the schema's order.
    Arrays and maps are leaves; a struct without fields has none; a NULL struct has NULL leaves."""
    if not isinstance(kind, T.StructType):
        yield name, value
        return
    for field in kind.fields:
        below = f"{name}.{field.name}" if name else field.name
        yield from leaves(field.dataType, value.getField(field.name), below)


def flattened(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and one column per leaf of the struct ``column``, named by its dotted key."""
    found = leaves(df.schema[column].dataType, F.col(_quoted(column)))
    own = [F.col(_quoted(k)) for k in keep]
    return df.select(*own, *[value.alias(key) for key, value in found])


def setting_rows(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., key, value) with one row per leaf: what is logged of a run's settings. Values are
    text; arrays, maps and empty structs are JSON."""

    def text(kind: T.DataType, value: Column) -> Column:
        return value.cast("string") if isinstance(kind, T.AtomicType) else F.to_json(value)

    kinds = dict(leaves_of(df.schema[column].dataType))
    entries = [
        F.struct(F.lit(key).alias("key"), text(kinds[key], value).alias("value"))
        for key, value in leaves(df.schema[column].dataType, F.col(_quoted(column)))
    ]
    own = [F.col(_quoted(k)) for k in keep]
    if not entries:
        empty = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
        return df.select(*own, F.inline(F.array().cast(T.ArrayType(empty))))
    return df.select(*own, F.inline(F.array(*entries)))


def leaves_of(kind: T.DataType, name: str = "") -> Iterator[tuple[str, T.DataType]]:
    """(dotted key, type) of every leaf of a schema."""
    if not isinstance(kind, T.StructType):
        yield name, kind
        return
    for field in kind.fields:
        yield from leaves_of(field.dataType, f"{name}.{field.name}" if name else field.name)
