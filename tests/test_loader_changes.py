"""Resets inside a poll, schemas that change in mid-stream, and buffers that close while no messages come."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from sluice import registry
from sluice.operators.binding import Col
from sluice.streaming import loader

LOG = "zone string, topic string, part long, pos long, tbl string, ts timestamp, payload string"
V1 = [Col("id", "Int64"), Col("kind", "String")]
V2 = [*V1, Col("level", "Int32", "default", "3"), Col("twice", "bigint", "materialized", "id * 2")]
V3 = [Col("kind", "String"), Col("id", "Int64"), Col("level", "Int64", "default", "4"), Col("tags", "Array(String)"), Col("twice", "bigint", "materialized", "id * 2")]
T0 = datetime.datetime(2024, 1, 1)


def message(pos, row, version=1, cols=None, tbl="click", zone="A", ts=None):
    names = f" ({', '.join(cols)})" if cols else ""
    sql = f"insert into t{names} values ({', '.join('?' * len(row))})"
    return zone, "x", 0, pos, tbl, ts or T0 + datetime.timedelta(seconds=pos), json.dumps({"shard": "s", "table": tbl, "schema_hash": version, "sql": sql, "rows": [row]})


def write(spark, root, seq, messages, tables, limits=loader.Limits(rows=3), **options):  # noqa: B008
    loader.write_batch(spark.createDataFrame(messages, LOG).coalesce(1), 2 * seq, root, tables, limits, **options)


def simple(pos, zone="A"):
    return message(pos, [pos, "k"], zone=zone)


@pytest.mark.parametrize("broken", [None, "buffers", "rows", "ledger"])
def test_reset_inside_a_batch(spark, tmp_path, broken):
    """Every message once, in its epoch; an epoch's open buffer closes as it stands. With broken, the second batch fails before a write and runs again."""
    root, tables, fail = str(tmp_path), {"click": V1}, [broken]

    def lost(name):
        if fail == [name]:
            fail.clear()
            raise RuntimeError("lost before a write")

    batches = [[0, 1, 2, 3, 4], [5, 6, 0, 1, 2], [3, 4, 5, 6, 7, 8]]
    for k, b in enumerate(batches):
        try:
            write(spark, root, k, [simple(p) for p in b], tables, resets=True, before_step=lost if k == 1 else None)
        except RuntimeError:
            write(spark, root, k, [simple(p) for p in b], tables, resets=True)
    loader.flush(spark, registry.log_schema(LOG), root, tables)
    got = sorted((r["_epoch"], r["_pos"]) for r in loader.loaded(spark, root, "click").collect())
    assert got == [(0, p) for p in range(7)] + [(1, p) for p in range(9)]
    ledger = sorted((r["block_no"], r["epoch"], r["begin_pos"], r["end_pos"], r["cnt"]) for r in loader.ledger(spark, root).collect())
    assert ledger == [(0, 0, 0, 4, 5), (1, 0, 5, 6, 2), (2, 1, 0, 8, 9)]


def test_several_resets_and_partitions(spark, tmp_path):
    """Two resets in one batch, one of them of a table that has no messages after it; arrival given by a column; another cluster keeps its epoch; a zero right after a zero is no reset."""
    root, tables = str(tmp_path), {"click": V1, "view": V1}
    write(spark, root, 0, [simple(0), message(1, [1, "v"], tbl="view"), simple(0, "B")], tables, resets=True)
    arrived = [simple(2), simple(0), simple(0), simple(1), simple(0), simple(1, "B"), simple(5)]
    rows = [(*m, k) for k, m in enumerate(arrived)]
    loader.write_batch(spark.createDataFrame(rows[::-1], LOG + ", arrival long"), 2, root, tables, loader.Limits(rows=9), resets=True)
    loader.flush(spark, registry.log_schema(LOG), root, tables)
    got = sorted((r["_zone"], r["_epoch"], r["_pos"]) for r in loader.loaded(spark, root, "click").collect())
    assert got == [("A", 0, 0), ("A", 0, 2), ("A", 1, 0), ("A", 1, 1), ("A", 2, 0), ("A", 2, 5), ("B", 0, 0), ("B", 0, 1)]
    ledger = sorted((r["zone"], r["tbl"], r["block_no"], r["epoch"], r["begin_pos"], r["end_pos"]) for r in loader.ledger(spark, root).collect())
    assert ledger == [("A", "click", 0, 0, 0, 2), ("A", "click", 1, 1, 0, 1), ("A", "click", 2, 2, 0, 5), ("A", "view", 0, 0, 1, 1), ("B", "click", 0, 0, 0, 1)]


def test_schema_change_in_an_open_buffer(spark, tmp_path):
    """The third batch adds a column with a default: the open buffer holds rows of both, an old writer may go on, and a message with an unknown hash is bound by the latest."""
    root, old, new = str(tmp_path), {"click": {1: V1}}, {"click": {1: V1, 2: V2}}
    write(spark, root, 0, [message(0, [0, "a"])], old, loader.Limits(rows=9))
    write(spark, root, 1, [message(1, [1, "b"])], old, loader.Limits(rows=9))
    write(spark, root, 2, [message(2, [2, "c", 7], 2), message(3, [3, "d"], 1), message(4, [4, "e", 8], 99), message(5, [5, 6], 2, ["id", "level"]), message(6, [6, "x", 7], 1)], new, loader.Limits(rows=9))
    assert [(r["begin_pos"], r["cnt"]) for r in loader.open_buffers(spark, root).collect()] == [(0, 6)]
    loader.flush(spark, registry.log_schema(LOG), root, new)
    rows = loader.loaded(spark, root, "click", origin=False)
    assert rows.columns == ["id", "kind", "level", "twice"]
    assert sorted(map(tuple, rows.collect())) == [(0, "a", 3, 0), (1, "b", 3, 2), (2, "c", 7, 4), (3, "d", 3, 6), (4, "e", 8, 8), (5, "", 6, 10)]
    assert {r["pos"]: r["error"] for r in loader.dead_letters(spark, root).collect()} == {6: "placeholder_mismatch"}
    assert loader.ledger(spark, root).count() == 1
    # A later version reorders, widens and adds; all that is stored follows.
    write(spark, root, 4, [message(7, ["f", 7, 2**40, ["t"]], 3), message(8, [8, "g"], 1)], {"click": {1: V1, 2: V2, 3: V3}}, loader.Limits(rows=0))
    rows = loader.loaded(spark, root, "click", origin=False)
    assert rows.columns == ["kind", "id", "level", "tags", "twice"] and dict(rows.dtypes)["level"] == "bigint"
    assert sorted(map(tuple, rows.where("id in (0, 2, 7, 8)").collect())) == [("a", 0, 3, [], 0), ("c", 2, 7, [], 4), ("f", 7, 2**40, ["t"], 14), ("g", 8, 4, [], 16)]


def test_catalog_is_asked_once_a_batch(spark, tmp_path):
    """A step that runs again has the schemas that it had, whatever the catalog says by then."""
    asked = []

    def catalog():
        asked.append(1)
        return {"click": {1: V1} if len(asked) < 2 else {1: V1, 2: V2}}

    root, first = str(tmp_path), [message(0, [0, "a"]), message(1, [1, "b", 5], 2)]

    def lost(name):
        if name == "ledger":
            raise RuntimeError("lost before a write")

    with pytest.raises(RuntimeError):
        write(spark, root, 0, first, catalog, loader.Limits(rows=0), before_step=lost)
    write(spark, root, 0, first, catalog, loader.Limits(rows=0))
    assert len(asked) == 1 and [tuple(r) for r in loader.loaded(spark, root, "click", origin=False).collect()] == [(0, "a")]
    write(spark, root, 1, [message(2, [2, "c", 5], 2)], catalog, loader.Limits(rows=0))
    assert len(asked) == 2 and sorted(map(tuple, loader.loaded(spark, root, "click", origin=False).collect())) == [(0, "a", 3, 0), (2, "c", 5, 4)]


def test_idle_buffers_close_by_ticks(spark, tmp_path):
    """A buffer closes once ticks are more than `idle` seconds after the first tick that saw it."""
    root, limits = str(tmp_path), loader.Limits(rows=99, idle=5)
    empty = spark.createDataFrame([], LOG)
    for k, (at, messages) in enumerate([(0, [simple(0)]), (4, [simple(1)]), (6, []), (20, [])]):
        rows = spark.createDataFrame(messages, LOG) if messages else empty
        tick = spark.createDataFrame([(T0 + datetime.timedelta(seconds=at),)], "tick timestamp")
        loader.write_batch(rows.unionByName(tick, allowMissingColumns=True), 2 * k, root, {"click": V1}, limits)
        assert loader.ledger(spark, root).count() == (k >= 2)
    assert [(r["begin_pos"], r["end_pos"]) for r in loader.ledger(spark, root).collect()] == [(0, 1)]


def test_idle_stream(spark, tmp_path):
    """A stream that gets one file and then nothing closes its buffer by the heartbeat."""
    spark.createDataFrame([simple(p) for p in range(3)], LOG).coalesce(1).write.parquet(str(tmp_path / "log"))
    log = loader.with_heartbeat(spark.readStream.schema(LOG).parquet(str(tmp_path / "log")))
    root = str(tmp_path / "root")
    q = loader.start_loader(log, {"click": V1}, root, str(tmp_path / "checkpoint"), loader.Limits(rows=99, idle=1), trigger={"processingTime": "1 second"})
    try:
        until = time.time() + 90
        while time.time() < until and not loader.ledger(spark, root).count():
            time.sleep(2)
    finally:
        q.stop()
    assert [(r["begin_pos"], r["end_pos"], r["cnt"]) for r in loader.ledger(spark, root).collect()] == [(0, 2, 3)]
    assert loader.loaded(spark, root, "click").agg(F.sum("id")).first()[0] == 3
