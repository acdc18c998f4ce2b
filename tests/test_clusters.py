"""Several clusters in one stream, and where they start again."""

import json
import time
from datetime import datetime

from pyspark.sql import functions as F

from sluice import registry
from sluice.operators.binding import Col
from sluice.sources import log as L
from sluice.streaming import loader

FILE = "topic string, part long, pos long, tbl string, ts timestamp, payload string"
TABLES = {"click": [Col("id", "Int64"), Col("kind", "String")]}
KAFKA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int, headers array<struct<key string, value binary>>"


def lines(part, offsets, kind):
    """A log file's rows: ids are offsets, kinds name the cluster."""
    body = lambda p: json.dumps({"shard": "s", "table": "click", "schema_hash": 1, "sql": "insert into click values (?, ?)", "rows": [[p, kind]]})
    return [("t", part, p, "click", datetime(2024, 1, 1), body(p)) for p in offsets]


def put(spark, folder, form, *rows):
    spark.createDataFrame([r for x in rows for r in x], FILE).coalesce(1).write.mode("append").format(form).save(str(folder))


def test_two_clusters_in_one_stream(spark, tmp_path):
    """A JSON and a Parquet log with equal topics, partitions and offsets, each with its own offsets in the stream; both go on after new files come, and again under a new checkpoint."""
    east, west, root = tmp_path / "east", tmp_path / "west", str(tmp_path / "root")
    variants = [{"zone": "east", "format": "json", "path": str(east), "schema": FILE, "maxFilesPerTrigger": 1}, {"zone": "west", "format": "parquet", "path": str(west), "schema": FILE, "maxFilesPerTrigger": 1}]

    def load(checkpoint):
        stream = L.read_log(spark, variants, True, loader.start_offsets(spark, root))
        loader.start_loader(stream, TABLES, root, str(tmp_path / checkpoint), loader.Limits(rows=3)).awaitTermination()

    assert loader.start_offsets(spark, root) == {}
    put(spark, east, "json", lines(0, range(5), "east"), lines(1, range(2), "east"))
    put(spark, west, "parquet", lines(0, range(3), "west"))
    load("one")
    assert {z: json.loads(x) for z, x in loader.start_offsets(spark, root).items()} == {"east": {"t": {"0": 5, "1": 2}}, "west": {"t": {"0": 3}}}
    time.sleep(1.1)  # files come in order of their times
    put(spark, west, "parquet", lines(0, range(3, 9), "west"), lines(2, range(1), "west"))
    load("one")
    put(spark, east, "json", lines(0, range(5, 7), "east"))
    load("two")
    loader.flush(spark, registry.log_schema("zone string, " + FILE), root, TABLES)
    got = sorted((r["_zone"], r["_part"], r["_pos"], r["id"], r["kind"]) for r in loader.loaded(spark, root, "click").collect())
    assert got == [(z, part, p, p, z) for z, part, n in (("east", 0, 7), ("east", 1, 2), ("west", 0, 9), ("west", 2, 1)) for p in range(n)]
    assert {z: json.loads(x) for z, x in loader.start_offsets(spark, root).items()} == {"east": {"t": {"0": 7, "1": 2}}, "west": {"t": {"0": 9, "2": 1}}}


def test_kafka_records(spark):
    """The table is the header `table`; records without it, or without any headers, have none and go to the side."""
    rows = [(None, b"{}", "t", 3, k, datetime(2024, 1, 1), 0, h) for k, h in enumerate([[("x", b"1"), ("table", b"click")], [("x", b"1")], [], None])]
    log = L.from_kafka(spark.createDataFrame(rows, KAFKA)).withColumn("zone", F.lit("east"))
    ok, bad = L.route(log)
    assert [(r["topic"], r["part"], r["pos"], r["tbl"], r["payload"]) for r in ok.collect()] == [("t", 3, 0, "click", "{}")]
    assert sorted(r["pos"] for r in bad.collect()) == [1, 2, 3]


def test_read_options():
    kafka = {"zone": "east", "kafka.bootstrap.servers": "a:1", "subscribe": "t", "startingOffsets": "earliest"}
    plain = {"kafka.bootstrap.servers": "a:1", "subscribe": "t", "includeHeaders": "true"}
    assert L.read_options(kafka) == plain | {"startingOffsets": "earliest"}
    assert L.read_options(kafka, {"west": "{}", "east": '{"t":{"0":5}}'}) == plain | {"startingOffsets": '{"t":{"0":5}}'}
    assert L.read_options({"zone": "east", "format": "json", "path": "/x", "schema": FILE, "maxFilesPerTrigger": 1}, {"east": "{}"}) == {"maxFilesPerTrigger": "1"}
