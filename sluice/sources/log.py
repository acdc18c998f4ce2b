"""The message log: zone, topic, part, pos (offset), tbl, ts, payload, value, arrival_seq."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Order values that share a chunk when rows are numbered; a hot key is numbered chunk by chunk.
CHUNK = 65_536
#: A partition of the log, and one table of it. Clusters and topics number their partitions each for themselves.
SOURCE = ["zone", "topic", "part"]
KEY = [*SOURCE, "tbl"]
LOG_COLUMNS = ["zone", "topic", "part", "pos", "tbl", "ts", "payload", "value", "arrival_seq"]


def numbered(df: DataFrame, keys: list[str], order: str, name: str, chunk: int = CHUNK) -> DataFrame:
    """Row numbers from 0 within keys, by a unique integer order column. Counts of chunks are summed first, so a key
    with a third of all rows is spread over as many tasks as it has chunks."""
    df = df.withColumn("chunk_", F.floor(F.col(order) / chunk))
    counts = df.groupBy(*keys, "chunk_").agg(F.count("*").alias("n_"))
    before = counts.withColumn("before_", F.coalesce(F.sum("n_").over(Window.partitionBy(*keys).orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n_")
    inside = F.row_number().over(Window.partitionBy(*keys, "chunk_").orderBy(order)) - 1
    return df.withColumn("inside_", inside).join(before, [*keys, "chunk_"]).withColumn(name, F.col("before_") + F.col("inside_")).drop("chunk_", "before_", "inside_")


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log derived from the events table: two clusters with two topics each, all with partitions of the same numbers."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    log = events.select(
        F.when(F.floor(F.col("user_id") / 2) % 2 == 0, "A").otherwise("B").alias("zone"),
        F.when(F.floor(F.col("user_id") / 4) % 3 == 0, "audit").otherwise("events").alias("topic"),
        (F.col("user_id") % 2).cast("long").alias("part"),
        F.col("event_type").alias("tbl"),
        F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))).alias("ts"),  # an instant, whatever the session's zone
        F.col("props").alias("payload"),
        "value",
        F.col("event_id").alias("arrival_seq"),
    )
    return numbered(log, SOURCE, "arrival_seq", "pos").select(*LOG_COLUMNS)


def from_kafka(raw: DataFrame) -> DataFrame:
    """Kafka's records (with headers) as log rows; the table stands in the header `table`, and is null where there is none."""
    header = F.get(F.filter("headers", lambda h: h["key"] == "table"), 0)["value"].cast("string")
    return raw.select("topic", F.col("partition").cast("long").alias("part"), F.col("offset").alias("pos"), F.col("timestamp").alias("ts"), header.alias("tbl"), F.col("value").cast("string").alias("payload"))


def read_options(variant: dict, offsets: dict[str, str] | None = None) -> dict[str, str]:
    """The reader's options for a cluster. offsets: the startingOffsets of each zone, as a loader's folder gives them; a zone that has none starts as the variant says."""
    options = {k: str(v) for k, v in variant.items() if k not in ("zone", "format", "path", "schema")}
    if variant.get("format", "kafka") == "kafka":
        options["includeHeaders"] = "true"
        if offsets and variant["zone"] in offsets:
            options["startingOffsets"] = offsets[variant["zone"]]
    return options


def read_log(spark: SparkSession, variants: list[dict], streaming: bool = False, offsets: dict[str, str] | None = None) -> DataFrame:
    """The log of several clusters: one source for each variant, all of one shape, with the variant's zone. A variant has zone, format (kafka, parquet, json or orc;
    files have the columns of a log but zone), path and schema for files, and the options of its reader. A stream keeps the offsets of each source in its checkpoint;
    offsets: where Kafka sources start when that is lost or new, see `loader.start_offsets`. Files start anew then, and the loader drops what it has."""
    parts = []
    for v in variants:
        form = v.get("format", "kafka")
        reader = (spark.readStream if streaming else spark.read).format(form).options(**read_options(v, offsets))
        if "schema" in v:
            reader = reader.schema(v["schema"])
        df = from_kafka(reader.load()) if form == "kafka" else reader.load(v["path"])
        parts.append(df.withColumn("zone", F.lit(v["zone"])))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def with_poll_batch(log: DataFrame, n: int) -> DataFrame:
    """Bounded polls; a stream uses maxOffsetsPerTrigger instead."""
    return log.withColumn("poll", F.floor(F.col("pos") / n).cast("long"))


def starting_offsets(meta: DataFrame) -> DataFrame:
    """Kafka's startingOffsets JSON for each cluster: by topic, the smallest begin of each partition, earliest (-2) where there is none."""
    first = meta.groupBy(*SOURCE).agg(F.coalesce(F.min("begin_pos"), F.lit(-2)).alias("p"))
    parts = first.groupBy("zone", "topic").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("part", "p")))).alias("parts"))
    topics = F.map_from_entries(F.array_sort(F.collect_list(F.struct("topic", "parts")), lambda a, b: F.when(a["topic"] < b["topic"], -1).otherwise(1)))
    return parts.groupBy("zone").agg(F.to_json(topics).alias("offsets"))


def route(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with a destination table, and those without, which go to a side table."""
    ok = F.col("tbl").isNotNull() & (F.col("tbl") != "")
    return log.where(ok), log.where(~ok | F.col("tbl").isNull()).withColumn("error", F.lit("no_table_header"))


ENVELOPE = "shard string, `table` string, schema_hash bigint, sql string, rows array<array<variant>>"


def decode(log: DataFrame, payload: str = "payload", keep: bool = False) -> DataFrame:
    """JSON envelopes to columns, with cells as VARIANT; an envelope that cannot be read gives null in `rows`. keep: the payload stays."""
    out = log.withColumn("e_", F.from_json(payload, ENVELOPE)).select(*log.columns, "e_.shard", F.col("e_.table").alias("envelope_table"), "e_.schema_hash", "e_.sql", "e_.rows")
    return out if keep else out.drop(payload)


def explode_rows(decoded: DataFrame) -> DataFrame:
    """One row for each row of a message; messages without rows give none."""
    rest = [c for c in decoded.columns if c != "rows"]
    return decoded.select(*rest, F.posexplode("rows").alias("row_in_msg", "cells"))


def synthetic_log(spark: SparkSession, like: DataFrame, tables: int, parts: int, seed: int = 7) -> DataFrame:
    """A seeded log of as many messages as `like` has rows."""
    h = F.abs(F.xxhash64("arrival_seq", F.lit(seed)))
    base = like.select("arrival_seq").withColumn("part", h % parts).withColumn("tbl", F.concat(F.lit("table"), (F.shiftright(h, 8) % tables).cast("string")))
    return numbered(base, ["part"], "arrival_seq", "pos")
