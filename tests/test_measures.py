"""What the loader records of its steps."""

import json
import time
from datetime import datetime

import pytest

from sluice import registry
from sluice.operators.binding import Col
from sluice.streaming import loader, measures

LOG = "zone string, topic string, part long, pos long, tbl string, ts timestamp, payload string"
TABLES = {"click": [Col("id", "Int64")]}


def message(pos, tbl="click", cell=1):
    body = {"shard": "s", "table": tbl, "schema_hash": 1, "sql": "insert into click values (?)", "rows": [[cell]]}
    return "A", "t", 0, pos, tbl, datetime.fromtimestamp(1_700_000_000 + pos), json.dumps(body)


def test_steps_as_they_ran(spark, tmp_path):
    """A step that breaks off twice counts once, with two retries; one that is delivered again after it counts isn't a retry; lag runs to the step that closes a block."""
    root, failures = str(tmp_path), ["buffers", "ledger"]

    def lost(name):
        if failures and failures[0] == name:
            raise RuntimeError(failures.pop(0))

    def step(k, messages, **more):
        loader.write_batch(spark.createDataFrame(messages, LOG), 2 * k, root, TABLES, loader.Limits(rows=3), **more)

    assert measures.throughput(spark, root).count() == 0 and measures.lag(spark, root).count() == 0 and measures.tries(spark, root).count() == 0
    began = time.time_ns() // 1000
    first = [message(p) for p in range(5)]
    step(0, first)
    middle = time.time_ns() // 1000
    second = [message(5), message(6, "nowhere"), message(7, cell="x"), message(8)]
    for _ in range(2):
        with pytest.raises(RuntimeError):
            step(1, second, before_step=lost)
    step(1, second)
    step(1, second)
    loader.flush(spark, registry.log_schema(LOG), root, TABLES)
    ended = time.time_ns() // 1000
    rows = {r["seq"]: r for r in measures.throughput(spark, root).collect()}
    assert {k: (r["messages"], r["rejected"], r["retries"]) for k, r in rows.items()} == {0: (5, 0, 0), 2: (2, 2, 2)}
    assert rows[0]["bytes"] == sum(len(m[-1]) for m in first) and all(0 < r["seconds"] < (ended - began) / 1e6 for r in rows.values())
    assert sorted(tuple(r) for r in measures.failures(spark, root).collect()) == [("click", "bad_cell", 1), ("nowhere", "unknown_table", 1)]
    assert [tuple(r) for r in measures.repeated(spark, root).collect()] == [("click", 7, 4)]
    lags = sorted((r["begin_pos"], r["lag_us"] + r["first_us"]) for r in measures.lag(spark, root).collect())
    assert [b for b, _ in lags] == [0, 5] and began < lags[0][1] < middle < lags[1][1] < ended
