"""Helpers that the corpus operators share: the shared folder, staged tables, word splitting and folds."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space, after A-Z are lower-cased.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def own_folder() -> str:
    return tempfile.mkdtemp(prefix="sluice-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset, a single machine gets a folder of its own; a cluster has to set it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return own_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def run_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sluice-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage is cut, and a lost executor costs nothing that is written."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for t in tables:
        remove(t.sparkSession, t.staged_at)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has staged; to be called once its results are written elsewhere."""
    remove(spark, f"{shared_dir(spark)}/sluice-{spark.sparkContext.applicationId}")


def whole_text(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """work on batches; at its end the Python worker gives back the memory that it no longer uses. Spark keeps workers for later stages, where it would count beside what the JVM takes."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
            trim(0)

    return run


def fold(column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def words(text: str) -> list[str]:
    return WORD.findall(text.translate(ASCII_LOWER))


def one_label(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """One 0/1 label for each id: repeated rows count once, the larger label wins, null ids and labels take no part."""
    return labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col)).agg(F.max(label).cast("int").alias(label))


def labelled_texts(documents: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """doc_id, text, label of the documents in `ids` (bounded). Of texts that repeat an id the one of the smallest hash counts, so the rows
    are as many as the ids and the same in every run; tasks settle repeats before the shuffle."""
    rows = documents.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", label).agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", F.col(label).alias("label"))
