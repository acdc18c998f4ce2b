import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from sluice.functions import cells
from sluice.operators.binding import Col
from sluice.streaming import loader

UTC = datetime.timezone.utc
MS = 1_700_000_000_387

#: type, cell, value; None: the type cannot take the cell.
CASES = [
    ("Int8", "-128", -128), ("Int8", "128", None), ("UInt8", "255", 255), ("UInt8", "-1", None), ("Int16", "true", 1), ("Int32", "1.9", 1), ("Int32", "-1.9", -1), ("Int64", '"1"', None), ("Int64", "null", None),
    ("UInt64", str(2**64 - 1), decimal.Decimal(2**64 - 1)), ("UInt64", str(2**64), None), ("Float32", "0.5", 0.5), ("Float64", "3", 3.0), ("Float64", '"3"', None), ("String", '"é"', "é"), ("String", "1", None), ("String", "[]", None),
    ("FixedString(4)", '"é"', b"\xc3\xa9\0\0"), ("FixedString(4)", '"abcde"', None), ("Date", str(MS), datetime.date(2023, 11, 14)), ("Date", '"2023-11-14"', None), ("DateTime", str(MS), MS // 1000 * 1000), ("DateTime('UTC')", "1.5", None),
    ("DateTime64", str(MS), MS), ("DateTime64(1, 'America/Phoenix')", str(MS), MS // 100 * 100), ("Array(UInt32)", "[1, 2]", [1, 2]), ("Array(UInt32)", "[1, null]", None), ("Array(UInt32)", "[1, -2]", None), ("Array(UInt32)", "3", None), ("Array(UInt32)", "[]", []),
    ("Array(Array(Nullable(String)))", '[["a", null], []]', [["a", None], []]), ("Array(Nullable(Array(Int8)))", "[[1], null]", [[1], None]), ("LowCardinality(String)", '"x"', "x"), ("LowCardinality(Nullable(FixedString(2)))", '"x"', b"x\0"), ("TINYINT", "7", 7), ("TEXT", '"t"', "t"),
    ("bigint", '"12"', 12), ("bigint", '"x"', None), ("string", "1.5", "1.5"), ("array<int>", "[1,2]", [1, 2]), ("date", '"2024-02-29"', datetime.date(2024, 2, 29)),
]


def plain(v):
    if isinstance(v, datetime.datetime):
        return round(v.replace(tzinfo=UTC).timestamp() * 1000)
    return bytes(v) if isinstance(v, bytearray) else v


def test_each_type(spark):
    df = spark.createDataFrame([(i, c) for i, (_, c, _) in enumerate(CASES)], "i int, j string").withColumn("v", F.parse_json("j"))
    for i, (name, _, want) in enumerate(CASES):
        t = cells.type_of(name)
        got = df.where(F.col("i") == i).select(cells.decode(F.col("v"), t).alias("x"), cells.failed(F.col("v"), t).alias("bad")).first()
        assert (plain(got["x"]), got["bad"]) == (want, want is None), (name, i)


def test_nulls(spark):
    df = spark.createDataFrame([("null",)], "j string").withColumn("v", F.parse_json("j"))
    for name, bad in (("Nullable(Int8)", False), ("LowCardinality(Nullable(String))", False), ("Int8", True), ("Array(Int8)", True), ("string", True)):
        assert df.select(cells.failed(F.col("v"), cells.type_of(name))).first()[0] is bad


EVERY = [Col("id", "Int64"), *[Col(f"c{k}", t) for k, t in enumerate("Int8 UInt8 Int16 UInt16 Int32 UInt32 UInt64 Float32 Float64 String FixedString(5) Date DateTime DateTime64(3) Nullable(Int32) LowCardinality(String) Array(UInt32) Array(Array(Nullable(String)))".split())], Col("note", "FixedString(3)", "default", "'ab'"), Col("gone", "Array(Date)")]
LOG = "zone string, topic string, part long, pos long, tbl string, ts timestamp, payload string"
VALUES = [1, 200, -5, 60000, -7, 4_000_000_000, 2**63, 0.25, 1e100, "text", "fixed", MS, MS, MS, None, "low", [1, 2], [["a", None]]]


def message(pos, row, cols):
    sql = f"insert into t ({', '.join(cols)}) values ({', '.join('?' * len(cols))})"
    return "A", "x", 0, pos, "t", datetime.datetime(2024, 1, 1), json.dumps({"shard": "s", "table": "t", "schema_hash": 1, "sql": sql, "rows": [row]})


def test_every_type_through_the_loader(spark, tmp_path):
    """A table with a column of every type; cells of a wrong kind or out of range make their messages dead letters."""
    cols = ["id", *[f"c{k}" for k in range(len(VALUES))]]
    bad = {1: ("c0", 300), 2: ("c9", 5), 3: ("c10", "too long"), 4: ("c11", "2024-01-01"), 5: ("c16", [1, None]), 6: ("c8", None), 7: ("c6", 2**64)}
    rows = [message(0, [0, *VALUES], cols)] + [message(p, [p, *[v if f"c{k}" != c else x for k, v in enumerate(VALUES)]], cols) for p, (c, x) in bad.items()]
    loader.write_batch(spark.createDataFrame(rows, LOG), 0, str(tmp_path), {"t": EVERY}, loader.Limits(rows=0))
    got = loader.loaded(spark, str(tmp_path), "t", origin=False).collect()
    want = [0, 1, 200, -5, 60000, -7, 4_000_000_000, decimal.Decimal(2**63), 0.25, 1e100, "text", b"fixed", datetime.date(2023, 11, 14), MS // 1000 * 1000, MS, None, "low", [1, 2], [["a", None]], b"ab\0", []]
    assert [[plain(v) for v in r] for r in got] == [want]
    errors = {r["pos"]: r["error"] for r in loader.dead_letters(spark, str(tmp_path)).collect()}
    assert errors == {p: "null_into_required" if p == 6 else "bad_cell" for p in bad}


@pytest.mark.parametrize("name", ["FixedString(0)", "Nullable()"])
def test_unknown_names_are_sparks(name):
    assert cells.type_of(name).name == ""
