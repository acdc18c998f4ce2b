"""Block formation: where the rows of one table in one partition (KEY) are cut into blocks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.log import KEY, numbered, with_poll_batch


def cut_rows(log: DataFrame, rows: int, keys: list[str] = KEY, order: str = "pos") -> DataFrame:
    """Fixed-size blocks of `rows` messages (block_by_rows, block_by_messages)."""
    return numbered(log, keys, order, "nth_").withColumn("block_no", F.floor(F.col("nth_") / rows).cast("long")).drop("nth_")


def poll_summary(log: DataFrame, poll: int, size: str = "octet_length(payload)") -> DataFrame:
    """Rows, bytes and times of each (KEY, poll): what the cut needs, smaller than the log by about the poll size."""
    return with_poll_batch(log, poll).groupBy(*KEY, "poll").agg(
        F.count("*").alias("rows"), F.sum(F.expr(size)).cast("long").alias("bytes"), F.min("pos").alias("begin_pos"), F.max("pos").alias("end_pos"), F.min(F.unix_micros("ts")).alias("first_us"), F.max(F.unix_micros("ts")).alias("last_us")
    )


def greedy_cut(summary: DataFrame, rows: int | None = None, size: int | None = None, seconds: int | None = None) -> DataFrame:
    """block_no of each poll: a block closes after the poll that takes it over a limit. A closed block resets the counters, so each KEY
    walks its polls once, in order; the summary, not the log, is what one task holds."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        block, n, b, start, out = 0, 0, 0, None, []
        pdf = pdf.sort_values("poll")
        for r in pdf.itertuples():
            n, b, start = n + r.rows, b + r.bytes, r.first_us if start is None else start
            out.append(block)
            if (rows is not None and n > rows) or (size is not None and b > size) or (seconds is not None and r.last_us - start > seconds * 1_000_000):
                block, n, b, start = block + 1, 0, 0, None
        return pdf.assign(block_no=out)[[*KEY, "poll", "block_no", "rows", "bytes", "begin_pos", "end_pos"]]

    return summary.groupBy(*KEY).applyInPandas(walk, "zone string, topic string, part long, tbl string, poll long, block_no long, rows long, bytes long, begin_pos long, end_pos long")


def block_ranges(blocks: DataFrame) -> DataFrame:
    """begin, end, count and message times of each block."""
    return blocks.groupBy(*KEY, "block_no").agg(F.min("pos").alias("begin_pos"), F.max("pos").alias("end_pos"), F.count("*").alias("cnt"), F.sum(F.octet_length("payload")).cast("long").alias("bytes"), F.min(F.unix_micros("ts")).alias("first_us"), F.max(F.unix_micros("ts")).alias("last_us"))


def block_id() -> Column:
    """Identity of a block: the same range of a (zone, topic, part, tbl), in the same epoch of its offsets, has the same id."""
    return F.md5(F.concat_ws("|", "zone", "topic", "part", "tbl", "epoch", "begin_pos", "end_pos"))
