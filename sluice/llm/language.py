"""Language identification: the nearest of several centroids of each language, by the cosine of TF-IDF vectors of character n-grams.

A text's letters are lower-cased and runs of anything else count as one blank; its n-grams of one to three signs, also across word boundaries, are hashed to DIMS terms. Document frequencies
are counted over all documents that may be learned from. A bounded sample of these (SAMPLE rows, about as many of each language, in hash order) is featurised where it lies; in one task each
language's unit vectors are then clustered around CENTROIDS directions. Centroids (languages x CENTROIDS x DIMS floats) are broadcast and every whole text is compared with all of them.
A text that lies farther from its nearest centroid than nearly all (REACH times the distance of the sample's QUANTILE) of that centroid's own sample is `rejected`: its language is the nearest one, but not
one that was learned with confidence.

Edge cases: a text that is null or has no letter is `und` with score 0, and so is every text where nothing could be learned; documents with a null lang are predicted but not learned from; of learned texts that
repeat a doc_id each counts; equal cosines go to the language that sorts first; scores do not depend on lang, source or doc_id; rows with null or repeated ids are predicted like any other; a very long
text is read in pieces; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, staged, table, whole_text

#: Terms; most rows that centroids are fitted on; centroids of a language; rounds of clustering.
DIMS, SAMPLE, CENTROIDS, ROUNDS = 1 << 14, 4_096, 4, 12
#: A centroid's reach: so many times the distance within which this share of its sample lies.
REACH, QUANTILE = 1.25, 0.99
#: Signs of one text, and of a block of texts, that are hashed together.
PIECE = 1_000_000
UNDETERMINED = "und"
BLANK = 32
M1, M2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


@cache
def signs() -> np.ndarray:
    """For each code point its lower-case letter, or a blank where it is no letter. One table for a worker."""
    out = np.full(0x110000, BLANK, np.uint32)
    for k in range(0x110000):
        c = chr(k)
        if c.isalpha():
            low = c.lower()
            out[k] = ord(low) if len(low) == 1 else k
    return out


def terms(text: str) -> np.ndarray | None:
    """How often each term stands in a text; null if it has no letter."""
    counts, letters = np.zeros(DIMS, np.float32), False
    for at in range(0, len(text), PIECE):
        # Pieces share two signs, so that no n-gram is lost or counted twice.
        s = signs()[np.frombuffer(text[max(at - 2, 0) : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        new = min(at, 2)
        blank = s == BLANK
        letters = letters or not blank.all()
        doubled = blank[1:] & blank[:-1]
        one = s * M1
        two = (one[:-1] ^ (s[1:] + np.uint32(1))) * M2
        three = (two[:-1] ^ (s[2:] + np.uint32(2))) * M1
        parts = [one[new:][~blank[new:]], two[max(new - 1, 0) :][~doubled[max(new - 1, 0) :]], three[~(doubled[1:] | doubled[:-1])]]
        counts += np.bincount(np.concatenate([(p >> np.uint32(18)).astype(np.int64) for p in parts]), minlength=DIMS)
    return counts if letters else None


def weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term ids, unit tf-idf weights)."""
    ids = np.flatnonzero(counts)
    w = np.log1p(counts[ids]) * idf[ids]
    return ids, w / max(float(np.sqrt((w**2).sum())), 1e-12)


def inverse_frequencies(documents: DataFrame) -> np.ndarray:
    """idf of every term over all these documents: each task adds up its own counts, one sum by term follows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(DIMS + 1, np.int64)
        for b in batches:
            for t in b.text:
                c = terms(t)
                if c is not None:
                    df[:DIMS] += c > 0
                    df[DIMS] += 1
        ids = np.flatnonzero(df)
        yield pd.DataFrame({"term": ids, "n": df[ids]})

    got = documents.select("text").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMS + 1)
    for r in got:  # at most DIMS + 1
        df[r["term"]] = r["n"]
    return (np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 0.1).astype(np.float32)


def clustered(rows: np.ndarray, most: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(unit centroids, the reach of each): spherical clustering of unit rows, begun at rows far from each other."""
    heads = [int((rows @ rows.sum(0)).argmax())]
    near = rows @ rows[heads[0]]
    while len(heads) < min(most, len(rows)) and near.min() < 1 - 1e-6:
        heads.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[heads[-1]])
    centres = rows[heads]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(1)
        sums = np.stack([rows[own == k].sum(0) if (own == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cos = rows @ centres.T
    own = cos.argmax(1)
    far = [1 - cos[own == k, k] for k in range(len(centres))]
    return centres, np.array([REACH * float(np.quantile(f, QUANTILE)) if len(f) else 0.0 for f in far])


def learned_rows(documents: DataFrame, train: Column | None, label: str) -> DataFrame:
    """(lang, text) of the documents to learn from."""
    rows = documents if train is None else documents.where(train)
    return rows.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("lang"), whole_text().alias("text"))


def fit(documents: DataFrame, train: Column | None = None, label: str = "lang", sample: int = SAMPLE) -> tuple:
    """(idf, languages, centroids, the language of each centroid, the reach of each)."""
    rows = learned_rows(documents, train, label)
    spark, idf = documents.sparkSession, inverse_frequencies(rows)
    sent = spark.sparkContext.broadcast(idf)
    # A text's place in hash order times its language's texts: the first of all are about as many of each language. Copies of a text count once, and texts stay where they are.
    keyed = rows.withColumn("hash", F.xxhash64("text"))
    keys = staged(keyed.select("lang", "hash").distinct(), "lang-keys")
    sizes = F.broadcast(keys.groupBy("lang").agg(F.count("*").alias("n")))  # a row for each language, as the model has vectors for each
    place = F.shiftrightunsigned("hash", 11).cast("double") * F.col("n")
    some = staged(keys.join(sizes, "lang").select("lang", "hash", place.alias("place")).orderBy("place", "hash", "lang").limit(sample).select("lang", "hash"), "lang-sample")
    some = keyed.join(F.broadcast(some), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text"))

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 64):
                got = [(y, *weighted(c, sent.value)) for y, t in zip(b.lang[at : at + 64], b.text[at : at + 64], strict=True) if (c := terms(t)) is not None]
                yield pd.DataFrame({"lang": [g[0] for g in got], "ids": [g[1].astype(np.int16) for g in got], "w": [g[2].astype(np.float32) for g in got]})

    def train_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[tuple[bytes, bytes]]] = {}
        for b in batches:
            for y, i, w in zip(b.lang, b.ids, b.w, strict=True):
                held.setdefault(y, []).append((np.asarray(i, np.int16).tobytes(), np.asarray(w, np.float32).tobytes()))
        for y in sorted(held):
            mine = sorted(held.pop(y))  # any order of arrival gives the same centroids
            dense = np.zeros((len(mine), DIMS), np.float32)
            for r, (i, w) in enumerate(mine):
                dense[r, np.frombuffer(i, np.int16)] = np.frombuffer(w, np.float32)
            centres, reach = clustered(dense)
            yield pd.DataFrame({"lang": [y] * len(centres), "centre": [c.tobytes() for c in centres.astype(np.float32)], "reach": reach})

    got = some.mapInPandas(featurise, "lang string, ids array<short>, w array<float>").repartition(1).mapInPandas(train_all, "lang string, centre binary, reach double").collect()
    languages = sorted({r["lang"] for r in got})
    got = sorted(got, key=lambda r: (r["lang"], r["centre"]))
    centres = np.array([np.frombuffer(r["centre"], np.float32) for r in got], np.float32).reshape(-1, DIMS)
    return idf, languages, centres, np.array([languages.index(r["lang"]) for r in got], np.int64), np.array([r["reach"] for r in got])


def predict_column(spark: SparkSession, model: tuple) -> Column:
    """lang, score and rejected of the column `text`."""
    idf, languages, centres, of, reach = model
    sent = spark.sparkContext.broadcast((idf, languages, np.ascontiguousarray(centres.T), of, reach))

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        idf, languages, centres, of, reach = sent.value
        for texts in batches:
            out = []
            for t in texts:
                counts = terms(t) if len(of) else None
                if counts is None:
                    out.append((UNDETERMINED, 0.0, True))
                    continue
                ids, w = weighted(counts, idf)
                cos = w @ centres[ids]
                k = int(cos.argmax())
                out.append((languages[of[k]], float(min(max(cos[k], 0.0), 1.0)), bool(1 - cos[k] > reach[k])))
            yield pd.DataFrame(out, columns=["lang", "score", "rejected"])

    return predict(whole_text())


def identify(documents: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of documents; score is the cosine with the nearest centroid."""
    found = documents.select("doc_id", predict_column(documents.sparkSession, model).alias("p"))
    return found.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(documents, F.coalesce(fold("doc_id", 3) != 1, F.lit(False)))
    return identify(documents, model).select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
