import json
import time
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from sluice import registry
from sluice.functions import metrics as M
from sluice.operators import blocks as K
from sluice.operators import commit as C
from sluice.sources import log as L
from sluice.streaming import loader, store

META = "zone string, topic string, part long, tbl string, begin_pos long, end_pos long, cnt long"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(same_as_sql, name):
    same_as_sql(name)


def test_synthetic_log(spark, sf_dir):
    rows = registry.QUERIES["synthetic_log"](spark, sf_dir)
    assert rows.groupBy("part", "pos").count().where("count > 1").count() == 0


def test_metadata_text(spark):
    """Both versions, an empty table among others, back and forth; tables stand by name."""
    meta = spark.createDataFrame([("A", "t", 3, "orders", 120, 188, 40), ("A", "t", 3, "clicks", 97, 96, 0), ("A", "t", 3, "views", 101, 150, 25), ("A", "t", 5, "orders", 7, 7, 1)], META)
    v0 = {r["part"]: r["metadata"] for r in C.meta_to_string(meta).collect()}
    assert v0 == {3: "clicks,97,96,orders,120,188,views,101,150", 5: "orders,7,7"}
    v1 = C.meta_to_string(meta, 1, "west-2", 90)
    assert {r["part"]: r["metadata"] for r in v1.collect()}[3] == "1,,west-2,clicks,97,96,0,orders,120,188,40,views,101,150,25,,90"
    assert sorted(tuple(r)[2:] for r in C.meta_from_string(v1).collect()) == [(3, 90, "clicks", 97, 96, 0), (3, 90, "orders", 120, 188, 40), (3, 90, "views", 101, 150, 25), (5, 90, "orders", 7, 7, 1)]
    parsed = C.meta_from_string(C.meta_to_string(meta)).collect()
    assert {(r["reference"], r["cnt"]) for r in parsed} == {(-1, 0)} and len(parsed) == 4
    assert {r["part"]: r["commit_pos"] for r in C.commit_offset(meta).collect()} == {3: 97, 5: 7}


def test_replay_actions(spark):
    """Offsets before the commit, before a table's range, in it, and after it; an empty range applies nothing again; force consumes all."""
    meta = spark.createDataFrame([("A", "t", 0, "orders", 20, 24, 3), ("A", "t", 0, "views", 22, 29, 4), ("A", "t", 0, "clicks", 26, 25, 0), ("B", "t", 0, "orders", 0, 90, 91)], META)
    rows = [("A", "t", 0, tbl, p) for p, tbl in ((18, "views"), (20, "orders"), (21, "views"), (23, "clicks"), (24, "orders"), (25, "orders"), (27, "clicks"), (29, "views"), (30, "views"), (31, "new"))]
    log = spark.createDataFrame(rows, "zone string, topic string, part long, tbl string, pos long")
    got = {r["pos"]: r["action"] for r in C.classify(log, meta).collect()}
    assert got == {18: "abnormal_before_begin", 20: "replay_append", 21: "skip_before_begin", 23: "skip_already_applied", 24: "replay_append", 25: "consume", 27: "consume", 29: "replay_append", 30: "consume", 31: "consume"}
    assert {r["action"] for r in C.classify(log, meta, True).collect()} == {"consume"}


def test_clusters_with_equal_partitions(spark):
    """Zones and topics whose partitions have the same number keep their own blocks, commits, gaps, lags and start offsets."""
    sources = [("A", "t"), ("A", "u"), ("B", "t")]
    rows = [(z, t, 0, "orders", p) for k, (z, t) in enumerate(sources) for p in range(10 * k, 10 * k + 10 + k)]
    log = spark.createDataFrame(rows, "zone string, topic string, part long, tbl string, pos long").selectExpr("*", "'x' as payload", "timestamp_micros(pos) as ts")
    meta = C.commit_metadata(K.block_ranges(K.cut_rows(log, 6)))
    got = {(r["zone"], r["topic"]): (r["begin_pos"], r["end_pos"], r["cnt"]) for r in meta.collect()}
    assert got == {("A", "t"): (6, 9, 4), ("A", "u"): (16, 20, 5), ("B", "t"): (26, 31, 6)}
    assert {r["zone"]: json.loads(r["offsets"]) for r in L.starting_offsets(meta).collect()} == {"A": {"t": {"0": 6}, "u": {"0": 16}}, "B": {"t": {"0": 26}}}
    assert C.rebuild_blocks(log, meta).count() == 15
    assert [(r["zone"], r["topic"]) for r in C.replay_gap(log.where("not (topic = 'u' and pos < 18)"), meta).collect()] == [("A", "u")]
    ends = log.groupBy(*L.SOURCE).agg((F.max("pos") + 1).alias("end_pos"))
    assert {(r["zone"], r["topic"]): r["lag"] for r in M.consumer_lag(ends, C.commit_offset(meta)).collect()} == {("A", "t"): 4, ("A", "u"): 5, ("B", "t"): 6}


def test_conflict_of_two_owners(spark):
    """The owner that was away finds another text than its own last one; taking over the first time is none, nor is a commit in another zone."""
    rows = [("A", "t", 0, k, o, f"{o}{k}") for k, o in enumerate("xxyyxxy")] + [("B", "t", 0, 0, "y", "y0"), ("B", "t", 0, 1, "y", "y1")]
    history = spark.createDataFrame(rows, "zone string, topic string, part long, seq long, owner string, written string")
    assert sorted((r["zone"], r["seq"], r["owner"], r["expected"], r["found"]) for r in C.commit_conflicts(history).collect()) == [("A", 4, "x", "x1", "y3"), ("A", 6, "y", "y3", "x5")]


def test_overlaps_with_any_earlier_range(spark):
    """A range is compared with all earlier ones, and one that stands again is reported as often if it overlaps another."""
    rows = [(0, "a", 0, 0, 100), (0, "a", 1, 10, 20), (0, "a", 2, 10, 20), (0, "a", 3, 101, 120), (0, "b", 0, 0, 5), (0, "b", 1, 0, 5), (1, "a", 0, 50, 60), (0, "a", 4, 90, 130)]
    ranges = spark.createDataFrame([("A", "t", *r) for r in rows] + [("B", "t", *r) for r in rows[:1]] + [("A", "u", 0, "b", 7, 3, 9)], "zone string, topic string, part long, tbl string, block_no long, begin_pos long, end_pos long")
    assert sorted((r["part"], r["tbl"], r["block_no"]) for r in C.overlaps(ranges).collect()) == [(0, "a", 1), (0, "a", 2), (0, "a", 3), (0, "a", 4)]


def test_offset_audit_after_resets(spark):
    offsets = [0, 1, 2, 3, 0, 1, 2, 3, 4, 2, 3, 6, 0, 0]
    log = spark.createDataFrame([("A", "t", 0, p, k) for k, p in enumerate(offsets)], "zone string, topic string, part long, pos long, arrival_seq long")
    got = sorted((r["arrival_seq"], r["anomaly"]) for r in C.offset_anomalies(log).collect())
    assert [x for _, x in got] == ["ok"] * 4 + ["reset"] + ["ok"] * 4 + ["rewind"] * 2 + ["gap", "reset", "rewind"]
    epochs = sorted((r["arrival_seq"], r["epoch"]) for r in C.epoch_of(log).collect())
    assert [e for _, e in epochs] == [0] * 4 + [1] * 8 + [2] * 2


LOG = "zone string, topic string, part long, pos long, tbl string, ts timestamp, payload string"


def message(zone, pos, tbl="click", cells=("1", "a", "2.5")):
    sql = "insert into simple (id, kind, score) values (?, ?, ?)"
    return zone, "events", 0, pos, tbl, datetime(2024, 1, 1, 0, 0, pos % 60), json.dumps({"shard": "s", "table": tbl, "schema_hash": 1, "sql": sql, "rows": [list(cells)]})


def load(spark, root, steps, limits=loader.Limits(rows=3), **options):  # noqa: B008
    for k, messages in enumerate(steps):
        loader.write_batch(spark.createDataFrame(messages, LOG), 2 * k, root, registry.TABLES, limits, **options)
    loader.flush(spark, registry.log_schema(LOG), root, registry.TABLES)
    return loader.loaded(spark, root, "click")


def test_two_clusters_of_equal_offsets(spark, tmp_path):
    rows = load(spark, str(tmp_path), [[message(z, p) for z in "AB" for p in range(5)]])
    assert rows.count() == 10 and rows.select("_zone", "_pos").distinct().count() == 10


def test_offsets_delivered_again(spark, tmp_path):
    rows = load(spark, str(tmp_path), [[message("A", p) for p in range(5)], [message("A", p) for p in (3, 4, 5, 5)]])
    assert sorted(r["_pos"] for r in rows.collect()) == list(range(6))
    ledger = loader.ledger(spark, str(tmp_path))
    assert sorted((r["begin_pos"], r["end_pos"], r["cnt"]) for r in ledger.collect()) == [(0, 4, 5), (5, 5, 1)]


def test_reset_starts_an_epoch(spark, tmp_path):
    rows = load(spark, str(tmp_path), [[message("A", p) for p in range(3)], [message("A", p) for p in range(2)]], resets=True)
    assert sorted((r["_epoch"], r["_pos"]) for r in rows.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_dead_letters(spark, tmp_path):
    bad = [message("A", 1, None), message("A", 2, "nowhere"), message("A", 3, cells=("x", "a", "1")), message("A", 4, cells=("1", "a")), message("A", 5, cells=(None, "a", "1")), ("A", "events", 0, 6, "click", datetime(2024, 1, 1), "no json")]
    rows = load(spark, str(tmp_path), [[message("A", 0), *bad, message("A", 7, cells=("9", "k", None))]])
    assert sorted((r["id"], r["score"], r["status"], r["doubled"]) for r in rows.na.fill(-1.0).collect()) == [(1, 2.5, "normal", 2), (9, -1.0, "normal", 18)]
    got = {r["pos"]: r["error"] for r in loader.dead_letters(spark, str(tmp_path)).collect()}
    assert got == {1: "no_table_header", 2: "unknown_table", 3: "bad_cell", 4: "row_arity", 5: "null_into_required", 6: "bad_envelope"}


@pytest.mark.parametrize("broken", [None, "buffers", "rows", "ledger", "mark"])
def test_exactly_once(spark, tmp_path, broken):
    """A stream that is lost before one of its writes, and started again, loads every message once, in the same blocks."""
    for k in range(3):
        df = spark.createDataFrame([message(z, p, t) for z in "AB" for p in range(4 * k, 4 * k + 4) for t in ["click" if p % 2 else "view"]], LOG)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        time.sleep(1.1)  # files come in order of their times
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "checkpoint")
    failures = [broken] if broken else []

    def fail(batch_id, name):
        if batch_id == 1 and failures == [name]:
            failures.clear()
            raise RuntimeError("lost before a write")

    start = lambda: loader.start_loader(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log")), registry.TABLES, root, checkpoint, loader.Limits(rows=3), before_step=fail)
    try:
        start().awaitTermination()
    except Exception:
        assert broken
        start().awaitTermination()
    loader.flush(spark, registry.log_schema(LOG), root, registry.TABLES)
    got = sorted((r["_zone"], r["_pos"]) for t in ("click", "view") for r in loader.loaded(spark, root, t).collect())
    assert got == [(z, p) for z in "AB" for p in range(12)]
    ledger = loader.ledger(spark, root).collect()
    assert sorted((r["zone"], r["tbl"], r["begin_pos"], r["end_pos"]) for r in ledger) == sorted((z, t, a + (t == "click"), b + (t == "click")) for z in "AB" for t in ("click", "view") for a, b in ((0, 6), (8, 10)))
    assert len({r["block_id"] for r in ledger}) == len(ledger)


def test_new_checkpoint_loads_nothing_twice(spark, tmp_path):
    spark.createDataFrame([message("A", p) for p in range(5)], LOG).coalesce(1).write.parquet(str(tmp_path / "log"))
    for name in ("one", "two"):
        loader.start_loader(spark.readStream.schema(LOG).parquet(str(tmp_path / "log")), registry.TABLES, str(tmp_path / "root"), str(tmp_path / name)).awaitTermination()
    loader.flush(spark, registry.log_schema(LOG), str(tmp_path / "root"), registry.TABLES)
    assert loader.loaded(spark, str(tmp_path / "root"), "click").count() == 5


def test_taken_over(spark, tmp_path):
    """A loader that another takes the root from, in the middle of a step, ends; every message counts once."""
    spark.createDataFrame([message("A", p) for p in range(4)], LOG).coalesce(1).write.parquet(str(tmp_path / "log"))
    root = str(tmp_path / "root")
    start = lambda name, **more: loader.start_loader(spark.readStream.schema(LOG).parquet(str(tmp_path / "log")), registry.TABLES, root, str(tmp_path / name), **more)
    start("one").awaitTermination()
    spark.createDataFrame([message("A", p) for p in range(4, 9)], LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    taken = []

    def take(batch_id, name):  # all tables of the step are written, only the mark is missing
        if name == "mark" and not taken:
            taken.append(True)
            start("two").awaitTermination()

    with pytest.raises(Exception, match="Fenced"):
        start("one", before_step=take).awaitTermination()
    with pytest.raises(Exception, match="Fenced"):
        start("one").awaitTermination()
    loader.flush(spark, registry.log_schema(LOG), root, registry.TABLES)
    assert sorted(r["_pos"] for r in loader.loaded(spark, root, "click").collect()) == list(range(9))
    assert store.marks(spark, root) == {0: True, 2: False, 4: True, 5: True}


def test_a_step_is_settled_once(spark, tmp_path):
    root = str(tmp_path)
    assert store.settle(spark, root, 0, "one") and not store.settle(spark, root, 0, "two") and not store.settle(spark, root, 0, "")
    assert store.owner_of(spark, root, 0) == "one" and store.counting(spark, root) == [0]
    assert [p.name for p in (tmp_path / "marks").glob("_*")] == []
