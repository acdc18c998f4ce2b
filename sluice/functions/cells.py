"""Typed cells: a decoder for VARIANT cells, put together from the name of a column's type.

Types by name, with the kinds of cell that each takes: numbers (Int8 to Int64, UInt8 to UInt64, Float32, Float64) take numbers and booleans, and fractions lose what stands after the point; String and
FixedString(n) take strings; Date, DateTime and DateTime64(scale) take milliseconds since 1970; Array(T) takes lists, to any depth; Nullable(T) takes a null besides what T takes, LowCardinality(T) what T takes.
Any other name is one of Spark's types, which takes what Spark can cast from the cell's text, or reads the cell as it is for arrays, maps and structs.

A cell that its type cannot take, of which an element cannot be taken, or whose number is out of range decodes to null; `failed` tells these from nulls that were sent.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import types as T

#: Other names of types (fixed values).
ALIASES = {"TINYINT": "Int8", "SMALLINT": "Int16", "INT": "Int32", "INTEGER": "Int32", "BIGINT": "Int64", "FLOAT": "Float32", "DOUBLE": "Float64", "CHAR": "String", "VARCHAR": "String", "TEXT": "String", "BLOB": "String", "BINARY": "FixedString", "TIMESTAMP": "DateTime"}
TIMES = {"Date": "date", "DateTime": "timestamp", "DateTime64": "timestamp"}
WRAPPERS = ("Nullable", "LowCardinality", "Array")


@dataclass(frozen=True)
class Type:
    """name: of the type itself; inner: what a wrapper holds; size: bytes of a fixed string or digits of a second; spark: its Spark type."""

    name: str
    spark: str
    inner: Type | None = None
    size: int | None = None

    @property
    def nullable(self) -> bool:
        return self.name == "Nullable" or (self.name == "LowCardinality" and self.inner.nullable)


@cache
def type_of(text: str) -> Type:
    m = re.fullmatch(r"\s*(\w+)\s*(?:\((.*)\))?\s*", text, re.S)
    name, inside = (ALIASES.get(m[1], m[1]), m[2]) if m else ("", None)
    if name in WRAPPERS and inside:
        inner = type_of(inside)
        return Type(name, f"array<{inner.spark}>" if name == "Array" else inner.spark, inner)
    if name in T.INTEGERS:
        return Type(name, T.INTEGERS[name][0])
    if name in T.FLOATS:
        return Type(name, T.FLOATS[name])
    if name == "String":
        return Type(name, "string")
    if name == "FixedString" and inside and int(inside) > 0:
        return Type(name, "binary", size=int(inside))
    if name in TIMES:
        return Type(name, TIMES[name], size=int((inside or "3").split(",")[0]) if name == "DateTime64" else None)
    return Type("", text.strip())


def null_cell(cell: Column) -> Column:
    """A null that was sent, or a cell that is not there."""
    return cell.isNull() | F.is_variant_null(cell)


def decode(cell: Column, t: Type) -> Column:
    """The cell as a value of the type; null if it is null or cannot be taken."""
    kind = F.schema_of_variant(cell)
    get = lambda spark: F.try_variant_get(cell, "$", spark)
    if t.name in ("Nullable", "LowCardinality"):
        return decode(cell, t.inner)
    if t.name == "Array":
        items = get("array<variant>")
        return F.when(kind.startswith("ARRAY") & ~F.exists(items, lambda x: failed(x, t.inner)), F.transform(items, lambda x: decode(x, t.inner)))
    number = kind.isin("BIGINT", "BOOLEAN", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    if t.name in T.INTEGERS:
        exact = get("decimal(38,9)")
        whole = F.when(kind.isin("BIGINT", "BOOLEAN"), get("decimal(38,0)")).otherwise(F.when(exact >= 0, F.floor(exact)).otherwise(F.ceil(exact)).try_cast("decimal(38,0)"))
        return F.when(number, T.cast_number(whole, t.name))
    if t.name in T.FLOATS:
        return F.when(number, get("double").cast(t.spark))
    if t.name == "String":
        return F.when(kind == "STRING", get("string"))
    if t.name == "FixedString":
        return F.when(kind == "STRING", T.cast_fixed_string(get("string"), t.size))
    if t.name in TIMES:
        ms = get("bigint")
        return F.when(kind == "BIGINT", T.ms_to_date(ms) if t.name == "Date" else T.ms_to_datetime(ms) if t.name == "DateTime" else T.ms_to_datetime64(ms, t.size))
    return get(t.spark) if re.match(r"(?i)(array|map|struct)\s*<", t.spark) else get("string").try_cast(t.spark)


def failed(cell: Column, t: Type) -> Column:
    """Whether the type cannot take the cell; a null fails types that are not nullable."""
    value = decode(cell, t)
    return (~null_cell(cell) & value.isNull()) if t.nullable else (null_cell(cell) | value.isNull())
