"""The loader's folder: numbered steps of Parquet tables. A step that runs again overwrites what it wrote before.

root/<table>/seq=N. Steps of the stream have even numbers, flushes the odd numbers between them. A step counts once root/marks/N names its owner;
an empty mark makes it void for ever. A mark is made by a rename that fails where there is one, so of two loaders one settles a step.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Independent tables of a step that are written side by side.
WRITERS = 4


@cache
def own_folder() -> str:
    return tempfile.mkdtemp(prefix="sluice-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a single machine gets one of its own where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return own_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def steps(spark: SparkSession, root: str, table: str) -> list[int]:
    """The numbers of the finished steps that `table` has, in order; one call lists them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/seq=*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(int(s.getPath().getParent().getName()[4:]) for s in found or [])


def marks(spark: SparkSession, root: str) -> dict[int, bool]:
    """The settled steps: whether each counts, or is void. One call lists them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/marks/[0-9]*")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return {int(s.getPath().getName()): s.getLen() > 0 for s in found or []}


def counting(spark: SparkSession, root: str) -> list[int]:
    """The steps that count, in order."""
    return sorted(s for s, ok in marks(spark, root).items() if ok)


def owner_of(spark: SparkSession, root: str, seq: int) -> str:
    """Who settled a step; empty for a void one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/marks/{seq}")
    opened = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def settle(spark: SparkSession, root: str, seq: int, owner: str) -> bool:
    """Let a step count as the owner's, or make it void with an empty owner; False where it is settled already."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    fresh, mark = fs.Path(f"{root}/marks/_{uuid.uuid4().hex}"), fs.Path(f"{root}/marks/{seq}")
    files = fresh.getFileSystem(conf)
    out = files.create(fresh, True)
    out.write(bytearray(owner.encode()))
    out.close()
    rename = getattr(fs, "Options$Rename")
    try:
        fs.FileContext.getFileContext(conf).rename(fresh, mark, spark.sparkContext._gateway.new_array(rename, 0))
    except Py4JJavaError as e:
        files.delete(fresh, False)
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def put(rows: DataFrame, root: str, table: str, seq: int) -> None:
    rows.write.mode("overwrite").parquet(f"{root}/{table}/seq={seq}")


def put_all(tables: dict[str, DataFrame], root: str, seq: int) -> None:
    """Several tables of a step, WRITERS of them side by side. The first failure is raised once those beside it have ended."""
    failures: list[BaseException] = []

    def write(name: str) -> None:
        try:
            put(tables[name], root, name, seq)
        except BaseException as e:  # noqa: BLE001
            failures.append(e)

    names = list(tables)
    for at in range(0, len(names), WRITERS):
        threads = [InheritableThread(target=write, args=(n,), session=tables[n].sparkSession) for n in names[at : at + WRITERS]]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if failures:
            raise failures[0]


def get(spark: SparkSession, root: str, table: str, schema: str, seq: int | None) -> DataFrame:
    """One step of a table; an empty table for None."""
    return spark.createDataFrame([], schema) if seq is None else spark.read.schema(schema).parquet(f"{root}/{table}/seq={seq}")


def every(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """All steps of a table that count, with their number in `seq`. Between them only void ones are left out, one for each change of owner."""
    settled = marks(spark, root)
    last = max((s for s, ok in settled.items() if ok), default=None)
    if last is None or not steps(spark, root, table):
        return spark.createDataFrame([], f"{schema}, seq long")
    rows = spark.read.schema(f"{schema}, seq long").parquet(f"{root}/{table}").where(F.col("seq") <= last)
    void = [s for s, ok in settled.items() if not ok and s < last]
    return rows.where(~F.col("seq").isin(void)) if void else rows
