"""A corpus pipeline: toxicity, near duplicates, secrets, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; what it returns is written as Parquet in the
shared folder and read again. All stages but the last return the columns of documents. Null and empty texts are kept by
every filter; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import jaccard, mixing, pieces, secrets, toxicity
from sluice.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(spark, model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return jaccard.kept_documents(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced; n_chars follows the text, and stays where the text is null."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text."""
    return pieces.encoded(docs.select("doc_id", "source", "text")).select("doc_id", "source", "pieces.*")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets), ("mixing", mix_sources), ("encoding", encode)]

#: A trained model decides the first stage, which SQL cannot express; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
