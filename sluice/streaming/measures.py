"""What the loader has recorded of its own work: throughput, failures, tries and lag of real steps. Only steps that count are measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .loader import ATTEMPTS, MEASURES, ledger


def seen(spark: SparkSession, root: str) -> DataFrame:
    """Messages, bytes and message times of each table of a partition and step (seq), by error; error is null for good messages."""
    return store.every(spark, root, "measures", MEASURES)


def tries(spark: SparkSession, root: str) -> DataFrame:
    """seq, began_us (the first try's begin), retries: how often a step that counts was begun again, by whatever loader."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/attempts")
    known = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    begun = spark.read.schema(ATTEMPTS).parquet(f"{root}/attempts") if known else spark.createDataFrame([], ATTEMPTS)
    counting = spark.createDataFrame([(s,) for s in store.counting(spark, root)], "seq long")
    return begun.join(counting, F.col("step") == F.col("seq")).groupBy("seq").agg(F.min("began_us").alias("began_us"), (F.count("*") - 1).alias("retries"))


def throughput(spark: SparkSession, root: str) -> DataFrame:
    """Each step's good messages, rejected ones, bytes, retries, and seconds from its first try to the writing of its ledger. Steps without messages are left out."""
    good = F.col("error").isNull()
    steps = seen(spark, root).groupBy("seq").agg(F.sum(F.when(good, F.col("messages")).otherwise(0)).alias("messages"), F.sum(F.when(good, 0).otherwise(F.col("messages"))).alias("rejected"), F.sum("bytes").alias("bytes"), F.max("loaded_us").alias("loaded_us"))
    return steps.join(tries(spark, root), "seq").select("seq", "messages", "rejected", "bytes", "retries", ((F.col("loaded_us") - F.col("began_us")) / 1_000_000).alias("seconds"))


def failures(spark: SparkSession, root: str) -> DataFrame:
    """Rejected messages by table and error."""
    return seen(spark, root).where("error is not null").groupBy("tbl", "error").agg(F.sum("messages").alias("n"))


def repeated(spark: SparkSession, root: str) -> DataFrame:
    """For each table, the good messages of all steps, and how many of them were loaded in vain before, once for each retry of their step."""
    both = seen(spark, root).where("error is null").join(tries(spark, root).select("seq", "retries"), "seq")
    return both.groupBy("tbl").agg(F.sum("messages").alias("messages"), F.sum(F.col("messages") * F.col("retries")).alias("repeated"))


def lag(spark: SparkSession, root: str) -> DataFrame:
    """Each loaded block with lag_us: from its oldest message to the writing of the ledger that has it."""
    return ledger(spark, root).withColumn("lag_us", F.col("loaded_us") - F.col("first_us"))
