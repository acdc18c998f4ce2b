"""Casts of message cells to column types, as column expressions. A value that cannot be cast gives null; callers send such rows to the dead letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spark type and bits of each integer type; unsigned ones are one size up.
INTEGERS = {"Int8": ("tinyint", 8, True), "Int16": ("smallint", 16, True), "Int32": ("int", 32, True), "Int64": ("bigint", 64, True), "UInt8": ("smallint", 8, False), "UInt16": ("int", 16, False), "UInt32": ("bigint", 32, False), "UInt64": ("decimal(20,0)", 64, False)}
FLOATS = {"Float32": "float", "Float64": "double"}


def cast_number(col: Column, kind: str, overflow: str = "reject") -> Column:
    """overflow: reject (null) or wrap (modulo 2^bits)."""
    if kind in FLOATS:
        return col.try_cast(FLOATS[kind])
    spark_type, bits, signed = INTEGERS[kind]
    whole = F.when(col.try_cast("double").isNotNull(), F.expr("1")).isNotNull()
    n = F.when(whole, col.try_cast("decimal(38,0)"))
    low, high = (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1) if signed else (0, 2**bits - 1)
    lit = lambda x: F.expr(f"cast('{x}' as decimal(38,0))")
    if overflow == "wrap":
        m = F.pmod(n, lit(2**bits))
        n = F.when(m > lit(high), m - lit(2**bits)).otherwise(m) if signed else m
    return F.when(n.between(lit(low), lit(high)), n).try_cast(spark_type)


def cast_fixed_string(col: Column, n: int) -> Column:
    """Right-padded with NUL to n bytes; longer strings give null."""
    raw = F.encode(col, "UTF-8")
    return F.when(F.octet_length(raw) <= n, F.concat(raw, F.substring(F.lit(b"\0" * n), F.lit(1), F.lit(n) - F.octet_length(raw))))


def ms_to_date(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / 86_400_000).cast("int"))


def ms_to_datetime(ms: Column) -> Column:
    return F.timestamp_seconds(F.floor(ms / 1000))


def ms_to_datetime64(ms: Column, scale: int = 3) -> Column:
    step = 10 ** (3 - min(scale, 3))
    return F.timestamp_millis((F.floor(ms / step) * step).cast("long"))


def cast_array(col: Column, inner, depth: int = 1) -> Column:
    """inner: the cast of one element; depth: array levels above it."""
    return F.transform(col, inner if depth == 1 else lambda x: cast_array(x, inner, depth - 1))


def required_null(cols: list[str]) -> Column:
    """Whether any column that may not be null is null."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull()
    return bad


def row_bytes(fixed: dict[str, int], strings: list[str]) -> Column:
    """Bytes of a row: type widths of fixed-size cells that are set, and octets of strings."""
    total = F.lit(0)
    for c, w in fixed.items():
        total = total + F.when(F.col(c).isNotNull(), w).otherwise(0)
    for c in strings:
        total = total + F.coalesce(F.octet_length(c), F.lit(0))
    return total.cast("long")
