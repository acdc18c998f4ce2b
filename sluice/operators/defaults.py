"""Default filling and schema evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.types import cast_fixed_string
from .binding import Col, Schema, insertable


def type_default(c: Col) -> Column:
    """What a column without a default holds where no value was sent: null if it may, else an empty text, list or fixed string of zeros, 1970 or 0."""
    t = c.decoder
    while t.name == "LowCardinality":
        t = t.inner
    spark = c.spark.lower()
    if t.nullable:
        return F.lit(None).cast(spark)
    if spark.startswith("array"):
        return F.array().cast(spark)
    if spark == "string":
        return F.lit("")
    if spark == "binary":
        return F.lit(bytes(t.size or 0))
    if spark in ("date", "timestamp"):
        return F.lit("1970-01-01").cast(spark)
    return F.lit(0).cast(spark)


def default_of(c: Col) -> Column:
    if c.kind != "default" or c.expr is None:
        return type_default(c)
    return cast_fixed_string(F.expr(c.expr), c.decoder.size) if c.decoder.size and c.spark == "binary" else F.expr(c.expr).cast(c.spark)


def fill_defaults(df: DataFrame, schema: Schema, absent: str | None = "absent") -> DataFrame:
    """Absent columns get their default, else the type's; a null that was sent stays. `absent` lists a row's absent columns; columns the DataFrame lacks are absent in all rows."""
    cols = []
    for c in insertable(schema):
        if c.name not in df.columns:
            cols.append(default_of(c).alias(c.name))
        elif absent in df.columns:
            cols.append(F.when(F.array_contains(absent, c.name), default_of(c)).otherwise(F.col(c.name)).alias(c.name))
        else:
            cols.append(F.col(c.name))
    keep = [x for x in df.columns if x != absent and x not in {c.name for c in schema}]
    return df.select(*keep, *cols)


def derive(df: DataFrame, schema: Schema) -> DataFrame:
    """Materialized columns at write, alias columns in views."""
    for c in schema:
        if c.kind in ("materialized", "alias"):
            df = df.withColumn(c.name, F.expr(c.expr).cast(c.spark))
    return df


def schema_text(schema: Schema) -> str:
    return ",".join(f"{c.name} {c.type}" for c in schema)


def schema_hash(schema: Schema) -> Column:
    """Names and types; default expressions do not count."""
    return F.md5(F.lit(schema_text(schema)))


def classify_schema(messages: DataFrame, versions: DataFrame) -> DataFrame:
    """current, stale or unknown, by the (few) versions of each table: tbl, schema_hash, version."""
    latest = versions.groupBy("tbl").agg(F.max("version").alias("latest"))
    known = messages.join(versions, ["tbl", "schema_hash"], "left").join(latest, "tbl", "left")
    return known.withColumn("state", F.when(F.col("version").isNull(), "unknown").when(F.col("version") == F.col("latest"), "current").otherwise("stale"))


def migrate(df: DataFrame, latest: Schema) -> DataFrame:
    """Rows of an older schema in the latest: new columns get their defaults, columns of another type are cast, columns that the latest lacks go, and
    materialized columns that the rows do not have are derived."""
    own = {c.name for c in latest}
    have = lambda c: c.name in df.columns
    filled = [(F.col(c.name).cast(c.spark) if have(c) else default_of(c)).alias(c.name) for c in insertable(latest)]
    made = [F.col(c.name).cast(c.spark).alias(c.name) for c in latest if c.kind == "materialized" and have(c)]
    return derive(df.select(*[x for x in df.columns if x not in own], *filled, *made), [c for c in latest if c.kind == "materialized" and not have(c)])


def union_versions(parts: list[DataFrame], latest: Schema) -> DataFrame:
    """Messages of several schema versions in one block."""
    out = migrate(parts[0], latest)
    for p in parts[1:]:
        out = out.unionByName(migrate(p, latest))
    return out
