"""The exactly-once loader: from a stream of messages to tables, block by block.

A micro-batch is one poll. It is routed to tables, decoded, bound and filled with defaults; what cannot be goes to the dead letters
as whole messages. The rows of each (zone, topic, part, tbl) gather in a buffer that lasts over batches and closes, after a poll, when it
is over a limit of rows, bytes, message time or processing time. A closed buffer is a block: its offset range gives its id, and readers see a block's rows
once the ledger has it.

Every step is a pure function of the step before, the batch's messages, which Spark's offset log fixes before the batch runs, and the schemas that it has looked up.
A step first writes these schemas, its buffers and the last offset of each partition (the intent), then rows and dead letters, then the ledger, each under
the step's number, and last the mark that lets it count; a batch that runs again reads the schemas it had and overwrites the same folders with the same rows, or does nothing if it counts.
A loader with a new checkpoint takes the root over: it makes the step void that a loader before it may be in, and begins after it. That loader then ends with Fenced, and nothing that it
wrote in that step is read. A flush is no loader: it may not run beside one. Rows are written as they come, with the
number of their buffer, so no buffer is held in memory, and there is a folder for a step, not for a block.

Messages at or under the last offset of their (zone, topic, part) are dropped: they are loaded already. With resets=True, an offset 0 that arrives after larger
ones starts a new epoch instead, in which offsets count anew, wherever in a batch it stands; the buffers of the epoch that it ends close as they are. Of messages with equal offsets of an epoch
in a batch the first by time, then table and payload counts. As in the source of such a log, the offsets of a partition have to come in order over batches; inside a batch they may come
in any order, but with resets=True rows have to stand in the order of their arrival, or have it in a column `arrival`. An empty batch changes nothing but the time triggers; null tables are dead letters.

A table may have several versions of its schema, and a catalog that is called once a batch may add one at any time. Messages are bound by the version that they name, and written in the latest;
a buffer that is open at the change takes rows of both, and readers see all rows in the latest schema, with the defaults of columns that older rows lack.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.binding import Schema, Versions, insert_shape, insertable, latest, message_problem, project, schema_json, schema_of_json, targets
from ..operators.blocks import block_id
from ..operators.commit import epoch_of
from ..operators.defaults import derive, fill_defaults, migrate
from ..sources.log import KEY, SOURCE, decode, explode_rows, starting_offsets
from . import store

COUNTS = "cnt long, bytes long, begin_pos long, end_pos long, first_us long, last_us long"
#: Rows of a step: the latest buffer of each key, and earlier ones that the step closed. opened_us: processing time; done: closed by an earlier step.
BUFFERS = f"zone string, topic string, part long, tbl string, epoch long, block_no long, {COUNTS}, opened_us long, closed boolean, done boolean"
POSITIONS = "zone string, topic string, part long, epoch long, last_pos long"
LEDGER = f"block_id string, zone string, topic string, part long, tbl string, epoch long, block_no long, {COUNTS}, loaded_us long"
#: What a step has seen of each table of a partition; error: null for good messages. When a step, or a broken off try at it, began.
MEASURES = "zone string, topic string, part long, tbl string, error string, messages long, bytes long, first_us long, last_us long, loaded_us long"
ATTEMPTS = "step long, began_us long"
DEAD = "zone string, topic string, part long, pos long, tbl string, error string, payload string"
SCHEMAS = "tbl string, schema string"
#: Columns that a loaded table has besides its own.
ORIGIN = {"zone": "_zone", "topic": "_topic", "part": "_part", "epoch": "_epoch", "pos": "_pos", "row_in_msg": "_row", "block_no": "_block_no"}
ORIGIN_TYPES = "_zone string, _topic string, _part long, _epoch long, _pos long, _row int, _block_no long"
Tables = dict[str, Schema | Versions]


class Fenced(RuntimeError):
    """Another loader has taken the root over."""


def names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


@dataclass(frozen=True)
class Limits:
    """A buffer over any of them closes after the poll: messages, payload bytes, seconds between its first message and the newest of its partition, and
    seconds of processing time since it was opened, which need a heartbeat in the stream."""

    rows: int | None = 100_000
    size: int | None = 10 << 20
    seconds: float | None = None
    idle: float | None = None

    def over(self, cnt: Column, size: Column, age_us: Column, idle_us: Column) -> Column:
        micros = lambda s: None if s is None else int(s * 1_000_000)
        out = F.lit(False)
        for value, limit in ((cnt, self.rows), (size, self.size), (age_us, micros(self.seconds)), (idle_us, micros(self.idle))):
            if limit is not None:
                out = out | F.coalesce(value > limit, F.lit(False))
        return out


def with_heartbeat(log: DataFrame, seconds: int = 1) -> DataFrame:
    """A streaming log with a `tick` row every so many seconds, so that batches run, and idle buffers close, while no messages come. Ticks are part of the
    offset log like messages: a batch that runs again has the same."""
    rate = log.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.col("value") % seconds == 0)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in log.schema]
    return log.withColumn("tick", F.lit(None).cast("timestamp")).unionByName(rate.select(*empty, F.col("timestamp").alias("tick")))


def sequenced(batch: DataFrame, positions: DataFrame, resets: bool) -> DataFrame:
    """One message for each offset that is new to its partition and epoch, with its epoch."""
    state = positions.select(*SOURCE, F.col("epoch").alias("epoch_"), F.col("last_pos").alias("last_"))
    rest = [c for c in batch.columns if c not in (*SOURCE, "pos", "arrival")]
    if resets:
        order = F.col("arrival") if "arrival" in batch.columns else F.monotonically_increasing_id()
        mark = batch.select(*SOURCE, "pos", *rest, order.cast("long").alias("order_"))
        # What a partition has reached stands before the batch, like a message.
        reached = positions.join(batch.select(*SOURCE).distinct(), SOURCE, "left_semi").where("last_pos >= 0").select(*SOURCE, F.col("last_pos").alias("pos"), F.lit(-1).cast("long").alias("order_"))
        batch = epoch_of(mark.unionByName(reached, allowMissingColumns=True), "order_").where("order_ >= 0").withColumnRenamed("epoch", "more_")
    else:
        batch = batch.withColumn("more_", F.lit(0).cast("long"))
    first = [c for c in ("ts", "tbl", "payload") if c in rest] + [c for c in rest if c not in ("ts", "tbl", "payload")]
    one = batch.groupBy(*SOURCE, "more_", "pos").agg(F.min(F.struct(*first)).alias("m_")).select(*SOURCE, "more_", "pos", "m_.*")
    # State has a row a partition. Sent to all tasks, it leaves the messages spread by offset; a join by SOURCE would gather a partition in one task, and all that follows with it.
    both = one.join(F.broadcast(state), SOURCE, "left").withColumn("epoch", F.coalesce("epoch_", F.lit(0)) + F.col("more_"))
    return both.where((F.col("more_") > 0) | (F.col("pos") > F.coalesce("last_", F.lit(-1)))).drop("more_", "epoch_", "last_")


def latest_buffers(step: DataFrame) -> DataFrame:
    """The buffer of each key that a step leaves."""
    rest = [c for c in names(BUFFERS) if c not in KEY]
    return step.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "block_no").alias("b")).select(*KEY, "b.*")


def grown(buffers: DataFrame, fresh: DataFrame, limits: Limits, flush: bool, tick_us: int | None = None) -> DataFrame:
    """Buffers after a poll. A key's open buffer takes the messages of its own epoch; each later epoch in the poll, and messages after a closed buffer, begin the next number.
    What is over a limit closes, and so does every buffer of an epoch that its partition has left."""
    good = fresh.where("error is null") if "error" in fresh.columns else fresh
    us = F.unix_micros("ts")
    now = good.groupBy(*KEY, F.col("epoch").alias("n_epoch")).agg(F.count("*").alias("n_cnt"), F.sum(F.octet_length("payload")).cast("long").alias("n_bytes"), F.min("pos").alias("n_begin_pos"), F.max("pos").alias("n_end_pos"), F.min(us).alias("n_first_us"), F.max(us).alias("n_last_us"))
    of_key = Window.partitionBy(*KEY)
    now = now.withColumns({"nth_": F.row_number().over(of_key.orderBy("n_epoch")), "head_": F.min("n_epoch").over(of_key)})
    clock = fresh.groupBy(*SOURCE).agg(F.max(us).alias("clock_us"), F.max("epoch").alias("at_epoch"))
    both = buffers.join(now, KEY, "full").join(clock, SOURCE, "left").withColumn("tick_", F.lit(tick_us).cast("long"))
    goes_on = F.coalesce(~F.col("closed") & (F.col("epoch") == F.col("head_")), F.lit(False))
    takes = goes_on & (F.col("nth_") == 1)
    add = lambda c: (F.col(f"n_{c}") + F.when(takes, F.col(c)).otherwise(0)).cast("long").alias(c)
    start = lambda c, f: F.when(takes, f(F.col(c), F.col(f"n_{c}"))).otherwise(F.col(f"n_{c}")).alias(c)
    number = F.coalesce(F.col("block_no") + F.col("nth_") - goes_on.cast("long"), F.col("nth_") - 1).cast("long").alias("block_no")
    opened = F.coalesce(F.when(takes, F.col("opened_us")), "tick_").alias("opened_us")
    touched = both.where("n_epoch is not null").select(*KEY, F.col("n_epoch").alias("epoch"), number, add("cnt"), add("bytes"), start("begin_pos", F.least), start("end_pos", F.greatest), start("first_us", F.least), start("last_us", F.greatest), opened, F.lit(False).alias("done"), "clock_us", "at_epoch", "tick_")
    left = both.where(F.col("block_no").isNotNull() & (F.col("n_epoch").isNull() | (~F.col("closed") & ~goes_on & (F.col("nth_") == 1))))
    left = left.select(*KEY, "epoch", "block_no", *names(COUNTS), F.coalesce("opened_us", "tick_").alias("opened_us"), F.col("closed").alias("done"), "clock_us", "at_epoch", "tick_")
    over = limits.over(F.col("cnt"), F.col("bytes"), F.greatest("clock_us", "last_us") - F.col("first_us"), F.col("tick_") - F.col("opened_us"))
    closes = F.col("done") | F.lit(flush) | F.coalesce(F.col("at_epoch") > F.col("epoch"), F.lit(False)) | over
    return touched.unionByName(left).withColumn("closed", closes).select(*names(BUFFERS))


@lru_cache(maxsize=256)
def checks(app: str, schema: str) -> tuple[Column, Column]:
    """(bound columns, problem) of messages for a schema. Expressions are built once for a session's application, not once a batch."""
    parsed = schema_of_json(schema)
    return targets(parsed), message_problem(parsed)


def prepared(fresh: DataFrame, tables: Tables) -> DataFrame:
    """Messages with their envelope, INSERT shape, `bound` columns and `error`: what is wrong with a message as a whole, or null. All of it is narrow. Tables of equal schemas share their checks."""
    alike: dict[str, list[str]] = {}
    for t, schema in tables.items():
        alike.setdefault(schema_json(schema), []).append(t)
    bound = F.lit(None).cast("array<string>")
    error = F.when(F.col("tbl").isNull() | (F.col("tbl") == ""), "no_table_header").when(~F.col("tbl").isin(*tables), "unknown_table").when(F.col("rows").isNull() | F.col("sql").isNull(), "bad_envelope")
    for schema, group in alike.items():
        to, problem = checks(fresh.sparkSession.sparkContext.applicationId, schema)
        bound = F.when(F.col("tbl").isin(*group), to).otherwise(bound)
        error = error.when(F.col("tbl").isin(*group), problem)
    return insert_shape(decode(fresh, keep=True)).withColumn("bound", bound).withColumn("error", error)


def table_rows(good: DataFrame, name: str, schema: Schema | Versions) -> DataFrame:
    """The rows of a table's good messages, in its latest schema, after their origin."""
    now = latest(schema)
    rows = explode_rows(good.where(F.col("tbl") == name)).withColumnsRenamed(ORIGIN)
    filled = fill_defaults(project(rows, schema, list(ORIGIN.values())), now)
    return derive(filled, [c for c in now if c.kind == "materialized"])


def schemas_of(spark: SparkSession, root: str, seq: int, tables: Tables | Callable[[], Tables]) -> Tables:
    """The schemas of a step: those that it looked up when it first ran."""
    if seq in store.steps(spark, root, "schemas"):
        return {r["tbl"]: schema_of_json(r["schema"]) for r in store.get(spark, root, "schemas", SCHEMAS, seq).collect()}
    now = tables() if callable(tables) else tables
    store.put(spark.createDataFrame([(t, schema_json(s)) for t, s in now.items()], SCHEMAS).coalesce(1), root, "schemas", seq)
    return now


def now_us() -> int:
    return time.time_ns() // 1000


def own_step(spark: SparkSession, root: str, seq: int, owner: str) -> None:
    """A settled step has to be the owner's."""
    if (by := store.owner_of(spark, root, seq)) != owner:
        raise Fenced(f"step {seq} of {root} is {f'of {by}' if by else 'void'}, not of {owner}")


def write_batch(batch: DataFrame, seq: int, root: str, tables: Tables | Callable[[], Tables], limits: Limits = Limits(), resets: bool = False, flush: bool = False, before_step=None, owner: str = "-") -> None:  # noqa: B008
    """One step of an owner. tables: schemas by table, or a catalog that gives them, called once. before_step(name): called before each of the writes `buffers`, `positions`, `rows`, `dead`, `ledger`, `mark`; tests fail there."""
    spark, said = batch.sparkSession, before_step or (lambda _: None)
    settled = store.marks(spark, root)
    if seq in settled:
        own_step(spark, root, seq, owner)
        return
    spark.createDataFrame([(seq, now_us())], ATTEMPTS).coalesce(1).write.mode("append").parquet(f"{root}/attempts")
    prior = max((s for s, ok in settled.items() if ok and s < seq), default=None)
    tables = schemas_of(spark, root, seq, tables)
    tick_us = None
    if "tick" in batch.columns:
        tick_us = batch.agg(F.max(F.unix_micros("tick"))).first()[0]
        batch = batch.where("tick is null").drop("tick")
    buffers, positions = (store.get(spark, root, t, s, prior) for t, s in (("buffers", BUFFERS), ("positions", POSITIONS)))
    fresh = prepared(sequenced(batch, positions, resets), tables).persist()
    try:
        new = fresh.groupBy(*SOURCE).agg(F.max("epoch").alias("n_epoch"), F.max_by("pos", F.struct("epoch", "pos")).alias("n_pos"))
        said("buffers")
        said("positions")
        store.put_all({
            "buffers": grown(latest_buffers(buffers), fresh, limits, flush, tick_us),
            "positions": positions.join(new, SOURCE, "full").select(*SOURCE, F.coalesce("n_epoch", "epoch").alias("epoch"), F.coalesce("n_pos", "last_pos").alias("last_pos")),
        }, root, seq)
        mine = store.get(spark, root, "buffers", BUFFERS, seq)
        good = fresh.where("error is null").join(F.broadcast(mine.select(*KEY, "epoch", "block_no")), [*KEY, "epoch"])
        # Tables without messages in the batch get no folder in this step.
        present = {r["tbl"] for r in fresh.where("error is null").select("tbl").distinct().collect()}
        said("rows")
        said("dead")
        store.put_all({f"tables/{t}": table_rows(good, t, s) for t, s in tables.items() if t in present} | {"dead": fresh.where("error is not null").select(*names(DEAD))}, root, seq)
        said("ledger")
        loaded_us = F.lit(now_us()).alias("loaded_us")
        us = F.unix_micros("ts")
        store.put_all({
            "ledger": mine.where("closed and not done").withColumn("block_id", block_id()).select(*names(LEDGER)[:-1], loaded_us),
            "measures": fresh.groupBy(*KEY, "error").agg(F.count("*").alias("messages"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).cast("long").alias("bytes"), F.min(us).alias("first_us"), F.max(us).alias("last_us")).select("*", loaded_us),
        }, root, seq)
        said("mark")
        if not store.settle(spark, root, seq, owner):
            own_step(spark, root, seq, owner)
    finally:
        fresh.unpersist()


def flush(spark: SparkSession, log_schema, root: str, tables: Tables) -> None:
    """Close all open buffers, after the last step and before the next."""
    last = store.counting(spark, root)
    if last:
        write_batch(spark.createDataFrame([], log_schema), last[-1] | 1, root, tables, flush=True)


def first_step(spark: SparkSession, root: str, checkpoint: str) -> int:
    """Where the steps of this checkpoint begin: after all that are there when it is first used, and the one that a loader before it may be in."""
    at = f"{root}/runs"
    schema = "checkpoint string, base long"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    known = spark.read.schema(schema).parquet(at) if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) else spark.createDataFrame([], schema)
    mine = known.where(F.col("checkpoint") == checkpoint).first()
    if mine:
        return mine["base"]
    base = max([-2, *store.marks(spark, root)]) // 2 + 1
    while not known.isEmpty() and not store.settle(spark, root, 2 * base, ""):
        base = max(store.marks(spark, root)) // 2 + 1
    base += not known.isEmpty()
    spark.createDataFrame([(checkpoint, base)], schema).coalesce(1).write.mode("append").parquet(at)
    return base


def start_loader(log: DataFrame, tables: Tables | Callable[[], Tables], root: str, checkpoint: str, limits: Limits = Limits(), resets: bool = False, trigger: dict | None = None, before_step=None):  # noqa: B008
    """Start the stream; trigger: e.g. {"availableNow": True} or {"processingTime": "1 second"}. One checkpoint owns a root at a time: the last that was new."""
    base = first_step(log.sparkSession, root, checkpoint)
    step = lambda df, batch_id: write_batch(df, 2 * (base + batch_id), root, tables, limits, resets, False, before_step and (lambda name: before_step(batch_id, name)), checkpoint)
    return log.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The blocks that are loaded."""
    return store.every(spark, root, "ledger", LEDGER)


def start_offsets(spark: SparkSession, root: str) -> dict[str, str]:
    """Kafka's startingOffsets of each cluster: right after the last offset that a step of the folder has taken. A row for each cluster."""
    last = store.counting(spark, root)
    at = store.get(spark, root, "positions", POSITIONS, last[-1] if last else None)
    return {r["zone"]: r["offsets"] for r in starting_offsets(at.select(*SOURCE, (F.col("last_pos") + 1).alias("begin_pos"))).collect()}


def open_buffers(spark: SparkSession, root: str) -> DataFrame:
    last = store.counting(spark, root)
    return store.get(spark, root, "buffers", BUFFERS, last[-1] if last else None).where("not closed")


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """The dead letters of finished steps."""
    return store.every(spark, root, "dead", DEAD)


def stored_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows of finished steps, in the latest schema that a step has had. Steps of one schema are read together; rows of older ones are migrated."""
    known = store.every(spark, root, "schemas", SCHEMAS).where(F.col("tbl") == name)
    spans: list[list] = []  # [schema, first step, last step]
    for r in known.select("seq", "schema").orderBy("seq").collect():  # a row a step
        if spans and spans[-1][0] == r["schema"]:
            spans[-1][2] = r["seq"]
        else:
            spans.append([r["schema"], r["seq"], r["seq"]])
    if not spans:
        raise ValueError(f"no step has had a table {name}")
    schemas, out = [latest(schema_of_json(text)) for text, _, _ in spans], None
    for k, (own, (_, low, high)) in enumerate(zip(schemas, spans, strict=True)):
        ddl = ", ".join([ORIGIN_TYPES, *[f"`{c.name}` {c.spark}" for c in [*insertable(own), *[c for c in own if c.kind == "materialized"]]]])
        rows = store.every(spark, root, f"tables/{name}", ddl).where(F.col("seq").between(low, high)).drop("seq")
        for later in schemas[k + 1 :]:  # a column keeps the default that it had when it was added
            rows = migrate(rows, later)
        out = rows if out is None else out.unionByName(rows)
    return out


def loaded(spark: SparkSession, root: str, name: str, origin: bool = True) -> DataFrame:
    """The rows of a table that stand in blocks of the ledger. Rows of a step that was broken off belong to no such block."""
    keys = [o for c, o in ORIGIN.items() if c not in ("pos", "row_in_msg")]
    blocks = ledger(spark, root).where(F.col("tbl") == name).select(*[F.col(c).alias(o) for c, o in ORIGIN.items() if o in keys], "begin_pos", "end_pos")
    out = stored_rows(spark, root, name).join(blocks, keys).where(F.col("_pos").between(F.col("begin_pos"), F.col("end_pos"))).drop("begin_pos", "end_pos")
    return out if origin else out.drop(*ORIGIN.values())
