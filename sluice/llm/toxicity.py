"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has a learning rate of its own, and the L1 term leaves only a small set of weights, which is
broadcast to score whole texts. A bounded sample of labelled rows (SAMPLE, in hash order of the id) is fitted in
one task; everything else runs over all rows.

Edge cases: a null text is empty and scores as the bias alone; rows with a null or repeated doc_id are scored like
any other (one row out for each row in, held_out false for a null id); of texts that repeat a labelled id that of the smallest hash is fitted; an empty table gives an empty result; without
training labels every score is 0.5; other columns of documents never clash, as only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, labelled_texts, lean, one_label, staged, whole_text

BITS = 20
#: Most labelled rows that the fit takes.
SAMPLE = 12_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 16.0, 1.0
#: Words whose hashes a worker keeps.
CACHE = 500_000
#: Taken off both ends of a word.
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%&$=+/\\~`^_-"


class Hashes(dict):
    """Word to 32-bit hash; a worker's memory stays bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = h = zlib.crc32((word.lower().strip(PUNCTUATION) or word).encode("utf-8", "surrogatepass"))
        return h


def features(text: str, hashes: Hashes, bits: int = BITS) -> np.ndarray:
    """Hashed unigrams, bigrams and one-word skip-grams, in text order, repeats included."""
    tokens = text.split()
    if not tokens:
        return np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    mix = np.uint64(0x9E3779B97F4A7C15)
    parts = [h * mix, (h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:]) * mix, (h[:-2] * np.uint64(0x165667B19E3779F9) + h[2:] + np.uint64(7)) * mix]
    return (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Weights:
    """Sparse weights and the bias."""

    index: np.ndarray
    value: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float32)
        w[self.index] = self.value
        return w


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Weights:
    """Fit on (distinct feature ids, label) rows, each epoch in another seeded order. The bias has no L1 term."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    bias = 1 << bits
    order = np.random.default_rng(17)

    def weight(i: np.ndarray) -> np.ndarray:
        shrink = np.where(i == bias, 0.0, l1)
        zi = z[i]
        return np.where(np.abs(zi) <= shrink, 0.0, -(zi - np.sign(zi) * shrink) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            x, y = rows[k]
            i = np.append(x, bias)
            w = weight(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / alpha * w
    w = weight(np.arange(bias + 1))
    keep = np.flatnonzero(w[:bias])
    return Weights(keep.astype(np.int32), w[keep].astype(np.float32), float(w[bias]), bits)


def score(text: str, w: np.ndarray, bias: float, hashes: Hashes, bits: int = BITS) -> float:
    """Each distinct feature counts once."""
    i = features(text, hashes, bits)
    i = i[w[i] != 0]
    return float(1 / (1 + np.exp(-np.clip(bias + float(w[np.unique(i)].sum()), -35, 35))))


def fit(documents: DataFrame, labels: DataFrame, train: Column | None = None, label: str = "toxic", sample: int = SAMPLE) -> Weights:
    """Fit on at most `sample` labelled rows that meet `train`, taken in hash order of doc_id."""
    ids = one_label(labels, label)
    ids = ids.where(train) if train is not None else ids
    ids = staged(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "toxic-sample")
    rows = labelled_texts(documents, ids, label).select("text", "label")

    @lean
    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for b in batches:
            yield pd.DataFrame({"x": [np.unique(features(t, hashes)).astype(np.int32) for t in b.text], "label": b.label})

    @lean
    def train_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(x, int(y)) for b in batches for x, y in zip(b.x, b.label, strict=True)]
        rows.sort(key=lambda r: (len(r[0]), r[1], r[0].tobytes()))  # any order of arrival gives the same weights
        m = ftrl(rows)
        yield pd.DataFrame({"index": [m.index], "value": [m.value], "bias": [m.bias]})

    got = rows.mapInPandas(featurise, "x array<int>, label int").repartition(1).mapInPandas(train_one, "index array<int>, value array<float>, bias double").collect()
    if not got:
        return Weights(np.empty(0, np.int32), np.empty(0, np.float32), 0.0)
    return Weights(np.array(got[0]["index"], np.int32), np.array(got[0]["value"], np.float32), got[0]["bias"])


def score_column(spark: SparkSession, model: Weights) -> Column:
    """The score of the column `text`; a filter may use it and leave all columns as they are."""
    sent = spark.sparkContext.broadcast((model.index, model.value, model.bias, model.bits))
    @F.pandas_udf("double")
    @lean
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, value, bias, bits = sent.value
        w, hashes = Weights(index, value, bias, bits).dense(), Hashes()
        for texts in batches:
            yield pd.Series([score(t, w, bias, hashes, bits) for t in texts], dtype="float64")

    return scores(whole_text())


def score_documents(documents: DataFrame, model: Weights) -> DataFrame:
    """All columns of documents and `score`, which takes the place of a column of that name."""
    return documents.withColumn("score", score_column(documents.sparkSession, model))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    from .common import table

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return score_documents(documents, model).select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
