"""Schema binding: which cells of a message go to which columns, and what is wrong with a message.

A table may have several versions of its schema. A message is bound by the version that its schema_hash names, or by the latest if it names none; its cells
are decoded to the types of the latest, in whose columns all rows end up.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells as T


@dataclass(frozen=True)
class Col:
    """type: a name that functions.cells knows, or one of Spark's; kind: ordinary, default, materialized or alias; expr: SQL of the default or of the derived column."""

    name: str
    type: str
    kind: str = "ordinary"
    expr: str | None = None
    nullable: bool = False

    @property
    def decoder(self) -> T.Type:
        t = T.type_of(self.type)
        return T.Type("Nullable", t.spark, t) if self.nullable and not t.nullable else t

    @property
    def spark(self) -> str:
        return T.type_of(self.type).spark


Schema = list[Col]
#: schema_hash to schema, oldest first; the last is the latest.
Versions = dict[int, Schema]


def latest(schema: Schema | Versions) -> Schema:
    return schema if isinstance(schema, list) else list(schema.values())[-1]


def schema_json(schema: Schema | Versions) -> str:
    """Versions as text, to be kept with the steps that used them."""
    return json.dumps([[k, [asdict(c) for c in s]] for k, s in ([(None, schema)] if isinstance(schema, list) else schema.items())])


def schema_of_json(text: str) -> Schema | Versions:
    versions = {k: [Col(**c) for c in s] for k, s in json.loads(text)}
    return versions[None] if None in versions else versions


def insertable(schema: Schema) -> Schema:
    return [c for c in schema if c.kind in ("ordinary", "default")]


def names_of(schema: Schema) -> Column:
    return F.array(*[F.lit(c.name) for c in insertable(schema)]).cast("array<string>")


def own_names(schema: Schema | Versions) -> Column:
    """The insertable columns of a message's own version."""
    if isinstance(schema, list):
        return names_of(schema)
    out = F
    for version, s in schema.items():
        out = out.when(F.col("schema_hash") == version, names_of(s))
    return out.otherwise(names_of(latest(schema)))


def insert_shape(messages: DataFrame, sql: str = "sql") -> DataFrame:
    """Column names and the number of placeholders of the INSERT texts, as plain expressions: no join, no shuffle."""
    head = F.regexp_extract(sql, r"(?is)^\s*insert\s+into\s+[^\s(]+\s*\(([^)]*)\)\s*values", 1)
    names = F.filter(F.transform(F.split(head, ","), lambda x: F.trim(F.translate(x, "`", ""))), lambda x: x != "")
    marks = F.regexp_count(F.regexp_extract(sql, r"(?is)\bvalues\s*\((.*)\)\s*;?\s*$", 1), F.lit(r"\?"))
    return messages.withColumns({"names": names, "placeholders": marks.cast("int")})


def targets(schema: Schema | Versions) -> Column:
    """The columns that the cells go to, by list if there is one, else by position over the first insertable columns of the message's version."""
    return F.when(F.size("names") > 0, F.col("names")).otherwise(F.slice(own_names(schema), F.lit(1), F.greatest(F.col("placeholders"), F.lit(0))))


def bind(rows: DataFrame, schema: Schema | Versions) -> DataFrame:
    return rows.withColumn("bound", targets(schema))


def project(bound: DataFrame, schema: Schema | Versions, keep: list[str], cells: str = "cells") -> DataFrame:
    """Bound rows in table order, of the latest version. A column that is not bound is left null here and marked absent in `absent`."""
    place = lambda c: F.array_position("bound", c.name)
    now = latest(schema)
    cols = [F.when(place(c) > 0, T.decode(F.get(F.col(cells), (place(c) - 1).cast("int")), c.decoder)).alias(c.name) for c in insertable(now)]
    absent = F.array_except(names_of(now), F.col("bound"))
    return bound.select(*keep, *cols, absent.alias("absent"))


def reorder(df: DataFrame, schema: Schema) -> DataFrame:
    return df.select(*[c.name for c in schema if c.name in df.columns])


def message_problem(schema: Schema | Versions, rows: str = "rows", bound: str = "bound") -> Column:
    """The first thing that is wrong with a message of several rows, or null: its binding, the width of any row, a cell that its column's type
    cannot take, or a null for a column that must have a value. One bad row fails the message. bound: see `bind`."""
    own, now = own_names(schema), latest(schema)
    binding = (
        F.when(F.size(F.array_except("names", F.array_union(own, names_of(now)))) > 0, "unknown_column")
        .when((F.size("names") > 0) & (F.size("names") != F.col("placeholders")), "placeholder_mismatch")
        .when((F.size("names") == 0) & (F.col("placeholders") > F.size(own)), "placeholder_mismatch")
        .when(F.exists(rows, lambda r: F.size(r) != F.col("placeholders")), "row_arity")
    )
    return F.coalesce(binding, *[cell_problem(c, rows, bound) for c in insertable(now)])


def checked(problem: Column) -> Column:
    """The problem as the output of a generator: a filter on it stays above, so what it is made of, the decoded envelope first, is made once a message and not once for each place that names it."""
    return F.explode(F.array(problem))


def cell_problem(c: Col, rows: str, bound: str) -> Column:
    """What is wrong with the first bad cell that a message has for a column, or null."""
    at, t = F.array_position(bound, c.name), c.decoder

    def fault(r: Column) -> Column:
        cell = F.get(r, (at - 1).cast("int"))
        return F.when(T.null_cell(cell), F.lit(None if t.nullable else "null_into_required").cast("string")).when(T.decode(cell, t).isNull(), "bad_cell")

    return F.when(at > 0, F.get(F.filter(F.transform(rows, fault), lambda x: x.isNotNull()), F.lit(0)))


def coverage(schema: Schema, bound: str = "bound") -> tuple[Column, Column]:
    """Does the bound set leave columns with a default, or without one, uncovered?"""
    names = lambda kind: F.array(*[F.lit(c.name) for c in insertable(schema) if c.kind == kind]).cast("array<string>")
    return F.size(F.array_except(names("default"), F.col(bound))) > 0, F.size(F.array_except(names("ordinary"), F.col(bound))) > 0
