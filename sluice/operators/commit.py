"""Commit metadata, replay and offset audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.log import CHUNK, KEY, SOURCE


def commit_metadata(ranges: DataFrame) -> DataFrame:
    """The last block range of every table in every partition."""
    last = F.max_by(F.struct("begin_pos", "end_pos", "cnt"), "block_no").alias("m")
    return ranges.groupBy(*KEY).agg(last).select(*KEY, "m.*")


def commit_offset(meta: DataFrame) -> DataFrame:
    """Where a successor starts, and the last offset that the metadata names; -1 for none."""
    return meta.groupBy(*SOURCE).agg(F.coalesce(F.min("begin_pos"), F.lit(-1)).alias("commit_pos"), F.coalesce(F.max("end_pos"), F.lit(-1)).alias("max_pos"))


def with_empty_markers(meta: DataFrame, tables: DataFrame, last: DataFrame) -> DataFrame:
    """(begin, end) = (last + 1, last) for tables of a partition that have nothing to replay."""
    every = tables.join(last, SOURCE)
    got = every.join(meta, KEY, "left")
    return got.select(*KEY, F.coalesce("begin_pos", F.col("last_pos") + 1).alias("begin_pos"), F.coalesce("end_pos", "last_pos").alias("end_pos"), F.coalesce("cnt", F.lit(0)).alias("cnt"))


def first_seen_markers(log: DataFrame) -> DataFrame:
    return log.groupBy(*KEY).agg(F.min("pos").alias("begin_pos")).select(*KEY, "begin_pos", (F.col("begin_pos") - 1).alias("end_pos"), F.lit(0).cast("long").alias("cnt"))


def meta_to_string(meta: DataFrame, version: int = 0, replica: str = "no_replica_id", reference: int = -1) -> DataFrame:
    """One line for each partition, tables by name."""
    fields = ["tbl", "begin_pos", "end_pos"] + ["cnt"] * (version == 1)
    entries = F.array_sort(F.collect_list(F.struct(*fields)))
    text = F.array_join(F.transform(entries, lambda e: F.concat_ws(",", *[e[f].cast("string") for f in fields])), ",")
    if version == 1:
        text = F.concat(F.lit(f"1,,{replica},"), text, F.lit(f",,{reference}"))
    return meta.groupBy(*SOURCE).agg(text.alias("metadata"))


def meta_from_string(df: DataFrame, col: str = "metadata") -> DataFrame:
    """Both versions, told apart by `,,`; version 0 has no counts and the reference -1."""
    v1 = F.col(col).contains(",,")
    bits = F.split(col, ",,")
    body = F.split(F.when(v1, F.regexp_replace(bits[1], r"^[^,]*,", "")).otherwise(F.col(col)), ",")
    width = F.when(v1, 4).otherwise(3)
    keep = [c for c in df.columns if c != col]
    each = df.withColumn("v1_", v1).withColumn("reference", F.when(v1, bits[2].cast("long")).otherwise(F.lit(-1))).withColumn("body_", body).withColumn("w_", width)
    each = each.where(F.length(col) > 0).select(*keep, "v1_", "reference", "body_", "w_", F.explode(F.sequence(F.lit(0), (F.size("body_") / F.col("w_")).cast("int") - 1)).alias("i_"))
    at = lambda k: F.get("body_", (F.col("i_") * F.col("w_") + k).cast("int"))
    return each.select(*keep, "reference", at(0).alias("tbl"), at(1).cast("long").alias("begin_pos"), at(2).cast("long").alias("end_pos"), F.when(F.col("v1_"), at(3).cast("long")).otherwise(F.lit(0)).alias("cnt"))


def merge_meta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of `new` overwrite those of `old`."""
    cols = ["begin_pos", "end_pos", "cnt"]
    n = new.select(*KEY, *[F.col(c).alias(f"new_{c}") for c in cols])
    both = old.join(n, KEY, "full")
    return both.select(*KEY, *[F.when(F.col("new_begin_pos").isNotNull(), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def replay_plan(meta: DataFrame) -> DataFrame:
    return commit_offset(meta).withColumn("state", F.when((F.col("max_pos") >= 0) & (F.col("commit_pos") <= F.col("max_pos")), "REPLAY").otherwise("CONSUME"))


def classify(log: DataFrame, meta: DataFrame, force_consume: bool = False) -> DataFrame:
    """What a successor does with each message that it gets. It asks for the committed offset on; a message before it, which a log that was cut or
    rewound may send, is abnormal and is consumed under that name."""
    if force_consume:
        return log.withColumn("action", F.lit("consume"))
    at = commit_offset(meta).select(*SOURCE, "commit_pos")
    m = meta.select(*KEY, F.col("begin_pos").alias("m_begin"), F.col("end_pos").alias("m_end"))
    rows = log.join(at, SOURCE, "left").join(m, KEY, "left")
    action = (
        F.when(F.col("pos") < F.col("commit_pos"), "abnormal_before_begin")
        .when(F.col("m_begin").isNull() | (F.col("m_begin") > F.col("m_end")) & (F.col("pos") > F.col("m_end")), "consume")
        .when(F.col("m_begin") > F.col("m_end"), "skip_already_applied")
        .when(F.col("pos") < F.col("m_begin"), "skip_before_begin")
        .when(F.col("pos") <= F.col("m_end"), "replay_append")
        .otherwise("consume")
    )
    return rows.withColumn("action", action)


def rebuild_blocks(log: DataFrame, meta: DataFrame) -> DataFrame:
    """Exactly the committed blocks: rows of each saved range."""
    m = meta.select(*KEY, "begin_pos", "end_pos")
    return log.join(m, KEY).where(F.col("pos").between(F.col("begin_pos"), F.col("end_pos")))


def replay_gap(log: DataFrame, meta: DataFrame) -> DataFrame:
    """Saved ranges whose start is no longer in the log."""
    first = log.groupBy(*SOURCE).agg(F.min("pos").alias("first_pos"))
    return meta.where("begin_pos <= end_pos").join(first, SOURCE, "left").where(F.col("first_pos").isNull() | (F.col("first_pos") > F.col("begin_pos"))).select(*KEY, "begin_pos", "first_pos")


def _before(df: DataFrame, keys: list[str], order: str, value: Column, how, name: str, chunk: int = CHUNK) -> DataFrame:
    """`how` (F.max or F.sum) of value over the rows before, by keys and order. Chunks are summed up first, so a hot key is spread over its chunks."""
    df = df.withColumn("value_", value).withColumn("chunk_", F.floor(F.col(order) / chunk))
    sums = df.groupBy(*keys, "chunk_").agg(how("value_").alias("v_"))
    prior = sums.select(*keys, "chunk_", how("v_").over(Window.partitionBy(*keys).orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)).alias("before_"))
    inside = how("value_").over(Window.partitionBy(*keys, "chunk_").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    both = df.withColumn("inside_", inside).join(prior, [*keys, "chunk_"])
    joined = F.greatest("inside_", "before_") if how is F.max else F.coalesce("inside_", F.lit(0)) + F.coalesce("before_", F.lit(0))
    return both.withColumn(name, joined).drop("value_", "chunk_", "inside_", "before_")


def followed(log: DataFrame, order: str = "arrival_seq", chunk: int = CHUNK) -> DataFrame:
    """The log with `epoch`, how many resets there were in the partition up to a message, and `last`, the highest offset before it in its epoch (null at an epoch's first message).
    A reset is an offset 0 right after an offset above 0: after a zero nothing is above 0 until one is. order: a unique integer order of arrival.

    Each chunk of a partition is read in order by itself; its resets, last offset and highest offset are all that later chunks need."""
    local = Window.partitionBy(*SOURCE, "chunk_").orderBy(order)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    df = log.withColumn("chunk_", F.floor(F.col(order) / chunk))
    df = df.withColumn("lag_", F.lag("pos").over(local))
    df = df.withColumn("e_", F.sum(((F.col("pos") == 0) & (F.col("lag_") > 0)).cast("long")).over(local)).withColumn("e_", F.coalesce("e_", F.lit(0)).cast("long"))
    # Epochs only grow, so the highest (epoch, offset) before a message is the highest offset of the latest epoch before it.
    df = df.withColumn("top_", F.max(F.struct(F.col("e_").alias("e"), F.col("pos").alias("p"))).over(before))
    ends = df.groupBy(*SOURCE, "chunk_").agg(F.min_by("pos", order).alias("head_"), F.max_by("pos", order).alias("tail_"), F.max("e_").alias("resets_"), F.max(F.struct(F.col("e_").alias("e"), F.col("pos").alias("p"))).alias("high_"))
    chunks = Window.partitionBy(*SOURCE).orderBy("chunk_")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("begins_", F.coalesce(((F.col("head_") == 0) & (F.lag("tail_").over(chunks) > 0)).cast("long"), F.lit(0)))
    ends = ends.withColumn("base_", (F.coalesce(F.sum(F.col("resets_") + F.col("begins_")).over(earlier), F.lit(0)) + F.col("begins_")).cast("long"))
    shifted = lambda s: F.when(s.isNotNull(), F.struct((s["e"] + F.col("base_")).alias("e"), s["p"].alias("p")))
    ends = ends.withColumn("carry_", F.max(shifted(F.col("high_"))).over(earlier)).select(*SOURCE, "chunk_", "base_", "carry_")
    both = df.join(ends, [*SOURCE, "chunk_"]).withColumn("epoch", F.col("e_") + F.col("base_")).withColumn("top_", F.greatest(shifted(F.col("top_")), "carry_"))
    return both.withColumn("last", F.when(F.col("top_.e") == F.col("epoch"), F.col("top_.p"))).drop("chunk_", "lag_", "e_", "top_", "base_", "carry_")


def epoch_of(log: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """The log with `epoch`, see `followed`."""
    return followed(log, order).drop("last")


def offset_anomalies(log: DataFrame, order: str = "arrival_seq") -> DataFrame:
    """reset, rewind, gap or ok, for each message in arrival order. A reset makes its offset the last one known."""
    last = F.col("last")
    kind = F.when(last.isNull(), F.when(F.col("epoch") > 0, "reset").otherwise("ok")).when(F.col("pos") <= last, "rewind").when(F.col("pos") > last + 1, "gap").otherwise("ok")
    return followed(log, order).withColumn("anomaly", kind).drop("last", "epoch")


def dedup_log(log: DataFrame) -> DataFrame:
    """The first arrival of every offset."""
    first = log.groupBy(*SOURCE, "pos").agg(F.min("arrival_seq").alias("arrival_seq"))
    return log.join(first, [*SOURCE, "pos", "arrival_seq"], "left_semi")


def commit_conflicts(history: DataFrame) -> DataFrame:
    """history: SOURCE, seq, owner, written: who committed what to a partition, in order. Commits that find another text than the one that their owner
    wrote last; an owner's first commit takes what it finds."""
    turn = Window.partitionBy(*SOURCE).orderBy("seq")
    rows = history.withColumn("found", F.lag("written").over(turn)).withColumn("expected", F.lag("written").over(Window.partitionBy(*SOURCE, "owner").orderBy("seq")))
    return rows.where(F.col("expected") != F.col("found"))


def overlaps(ranges: DataFrame) -> DataFrame:
    """Blocks that overlap an earlier, different range of the same table and partition, with the end of the farthest such range. A range that stands again is no overlap with itself, but with all others."""
    key = [*KEY, "begin_pos", "end_pos"]
    prior = Window.partitionBy(*KEY).orderBy("begin_pos", "end_pos").rowsBetween(Window.unboundedPreceding, -1)
    once = ranges.select(*key).distinct().withColumn("prior_end", F.max("end_pos").over(prior)).where(F.col("begin_pos") <= F.col("prior_end"))
    return ranges.join(once, key)


def completeness(ranges: DataFrame) -> DataFrame:
    """Offsets that the blocks cover, against the rows in them."""
    per = ranges.groupBy(*SOURCE).agg((F.max("end_pos") + 1).alias("covered"), F.sum("cnt").alias("cnt"))
    return per.agg(F.sum("covered").alias("covered"), F.sum("cnt").alias("loaded"))


def edge_blocks(ranges: DataFrame, first: bool) -> DataFrame:
    pick = F.min_by if first else F.max_by
    return ranges.groupBy(*KEY).agg(pick(F.struct("begin_pos", "end_pos", "cnt"), "block_no").alias("x")).select(*KEY, "x.*")


def assignments(ledger: DataFrame, most: int = 100) -> DataFrame:
    """The last `most` entries of each partition's history."""
    w = Window.partitionBy(*SOURCE).orderBy(F.desc("begin_pos"), "tbl")
    return ledger.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most)


def counts_from_reference(log: DataFrame, meta: DataFrame) -> DataFrame:
    """n: how many messages of its table and partition there are from the reference offset up to a message. Under version 1 the saved metadata (KEY, end_pos, cnt,
    reference) has the count up to the saved end, so a message that is replayed leaves it as it is, and counting goes on after the end; without saved
    metadata the reference is the partition's first offset."""
    m = meta.select(*KEY, F.col("end_pos").alias("m_end"), F.col("cnt").alias("m_cnt"), F.col("reference").alias("m_ref"))
    rows = log.join(m, KEY, "left").where(F.col("m_ref").isNull() | (F.col("pos") >= F.col("m_ref")))
    counted = F.when(F.col("m_end").isNull() | (F.col("pos") > F.col("m_end")), 1).otherwise(0)
    out = _before(rows, KEY, "pos", counted, F.sum, "n_")
    return out.withColumn("n", (F.col("n_") + counted + F.coalesce("m_cnt", F.lit(0))).cast("long")).drop("n_", "m_end", "m_cnt", "m_ref")
