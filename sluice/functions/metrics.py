"""Monitoring as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.log import SOURCE


def throughput(log: DataFrame, window: str = "1 day") -> DataFrame:
    at = F.window("ts", window)["start"]
    return log.groupBy("zone", "topic", "tbl", F.unix_seconds(at).alias("window_s")).agg(F.count("*").alias("messages"), F.sum(F.octet_length("payload")).cast("long").alias("bytes"))


def histogram(df: DataFrame, col: str, bounds: list[float]) -> DataFrame:
    """Cumulative counts by upper bound; the last bucket is the overflow, with a null bound."""
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    place = F.size(F.filter(edges, lambda b: b < F.col(col).cast("double")))
    counts = df.where(F.col(col).isNotNull()).groupBy(place.alias("bucket")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(len(bounds) + 1).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select("bucket", F.get(edges, F.col("bucket")).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"))
    return full.withColumn("cumulative", F.sum("n").over(Window.orderBy("bucket")))


def default_bounds() -> list[float]:
    """Latency bounds in microseconds, 300 us to 4 s: each decade at fixed steps (fixed values)."""
    return [300, 450, 600, 750, 900, 1000, 1250, 1500, 1750, 2000, 3000, 4000, 6000, 8000, 10000, 15000, 25000, 50000, 100000, 200000, 350000, 500000, 750000, 1000000, 2000000, 3000000, 4000000]


def extended_bounds() -> list[float]:
    return [*default_bounds(), 6750000, 10125000, 15187500, 20250000]


def pow2_bounds(n: int = 32) -> list[float]:
    return [2.0**k for k in range(n)]


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag of each topic of a cluster: the sum of its partitions' lags that are not negative, -1 if there is none."""
    lag = F.col("end_pos") - F.col("commit_pos")
    rows = ends.join(committed, SOURCE, "left").withColumn("lag", lag)
    return rows.groupBy("zone", "topic").agg(F.coalesce(F.sum(F.when(F.col("lag") >= 0, F.col("lag"))), F.lit(-1)).alias("lag"))


def replication_status(status: DataFrame) -> DataFrame:
    """Per table: flags, queue sizes, how far the log pointer is behind, seconds since the last queue update."""
    return status.select("tbl", "is_leader", "is_readonly", "queue_size", (F.col("log_max_index") - F.col("log_pointer")).alias("behind"), (F.col("now_s") - F.col("last_queue_update_s")).alias("queue_age_s"))


def table_totals(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and bytes of each table; bytes of its text column, null as 0."""
    out = None
    for name, (df, text) in tables.items():
        one = df.agg(F.count("*").alias("total_rows"), F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0)).cast("long").alias("total_bytes")).select(F.lit(name).alias("tbl"), "total_rows", "total_bytes")
        out = one if out is None else out.unionByName(one)
    return out


def load_lag(blocks: DataFrame, loaded_us: Column) -> DataFrame:
    """lag_us of each loaded block: from its oldest message to its load. Blocks without a load time have none and are left out."""
    return blocks.withColumn("lag_us", loaded_us - F.col("first_us")).where(F.col("lag_us").isNotNull())
