"""Quality: nearest-neighbour voting in a latent-semantic space.

Terms are hashed words, token shapes, shape pairs and repetition marks; their document frequencies are counted over
all documents. A truncated SVD of the tf-idf rows of a bounded labelled sample (SAMPLE rows, in hash order of doc_id)
gives the latent space. The sample's vectors are broadcast (SAMPLE x RANK floats), every document's exact cosines
with them are computed in blocks, and the NEIGHBOURS nearest vote with their similarity as weight.

Edge cases: null and empty texts have no terms and get the prior of the sample; so does a text whose vector is zero;
of texts that repeat a labelled id that of the smallest hash counts; equal similarities go to the smaller id; without training labels the score is 0.5; rows with null or repeated ids are scored like any other; an empty table gives an
empty result; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, labelled_texts, one_label, staged, table, whole_text

WORDS, SHAPES, PAIRS, MARKS = 4096, 1024, 1024, 32
DIMS = WORDS + SHAPES + PAIRS + MARKS
#: Most labelled rows that vote, the rank of the latent space, and how many neighbours vote.
SAMPLE, RANK, NEIGHBOURS = 4_096, 64, 7
CACHE = 300_000
#: Weights of the blocks of terms.
BLOCKS = ((0, WORDS, 0.5), (WORDS, WORDS + SHAPES, 1.0), (WORDS + SHAPES, WORDS + SHAPES + PAIRS, 1.0), (WORDS + SHAPES + PAIRS, DIMS, 0.5))


def shape(token: str) -> str:
    """Letters as a or A, digits as 0, runs as one."""
    if (body := token[:-1] if token[-1] in ".," else token).isalpha() and (body.islower() or body.isupper() or body[0].isupper() and body[1:].islower()):
        return ("a" if body.islower() else "A" if body.isupper() else "Aa") + token[len(body) :]
    signs = ("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in token)
    return "".join(c for c, _ in groupby(signs))


class Tokens(dict):
    """Token to word hash and shape hash in one number."""

    def __missing__(self, token: str) -> int:
        if len(self) > CACHE:
            self.clear()
        h = lambda s: zlib.crc32(s.encode("utf-8", "surrogatepass"))
        self[token] = v = (h(token.lower()) << 10) | h(shape(token)) % SHAPES
        return v


def term_counts(text: str, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Term ids and their damped counts."""
    parts = text.split()
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    both = np.fromiter(map(tokens.__getitem__, parts), np.int64, len(parts))
    word, form = both >> 10, both & 1023
    pair = (form[:-1] * 31 + form[1:] * 1009) % PAIRS
    repeated = 1 - len(np.unique(word)) / len(word)
    doubled = float((word[1:] == word[:-1]).mean()) if len(word) > 1 else 0.0
    marks = np.array([int(15 * repeated), 16 + int(15 * doubled)]) + DIMS - MARKS
    counts = np.bincount(np.concatenate([word % WORDS, WORDS + form, WORDS + SHAPES + pair]), minlength=DIMS).astype(np.float32)
    counts[marks] = 1
    ids = np.flatnonzero(counts)
    return ids, np.log1p(counts[ids])


def weighted(ids: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf-idf, each block of terms scaled to its own length."""
    w = tf * idf[ids]
    for a, b, scale in BLOCKS:
        i, j = np.searchsorted(ids, (a, b))
        length = np.sqrt((w[i:j] ** 2).sum())
        if length:
            w[i:j] *= scale / length
    return w


def latent_space(rows: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The first right singular vectors, by a seeded random range finder with power iterations."""
    basis = np.random.default_rng(5).standard_normal((rows.shape[1], rank + 16)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(rows @ basis)
        basis = rows.T @ q
    _, _, right = np.linalg.svd(basis.T, full_matrices=False)
    return np.ascontiguousarray(right[:rank].T)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def vote(vectors: np.ndarray, known: np.ndarray, labels: np.ndarray, neighbours: int = NEIGHBOURS, block: int = 512) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest; the prior where nothing is similar."""
    prior = float(labels.mean()) if len(labels) else 0.5
    out = np.full(len(vectors), prior)
    if not len(labels):
        return out
    k = min(neighbours, len(labels))
    for at in range(0, len(vectors), block):
        cos = vectors[at : at + block] @ known.T
        cut = np.partition(cos, len(labels) - k, axis=1)[:, len(labels) - k, None]
        # Of equal similarities at the last place the earlier in the order of ids vote.
        above, tied = cos > cut, cos == cut
        near = np.argsort(-(above * 2.0 + (tied & (np.cumsum(tied, axis=1) <= k - above.sum(1, keepdims=True)))), axis=1, kind="stable")[:, :k]
        sim = np.maximum(np.take_along_axis(cos, near, 1), 0)
        total = sim.sum(1)
        got = (sim * labels[near]).sum(1)
        ok = total > 0
        out[at : at + block][ok] = got[ok] / total[ok]
    return np.clip(out, 0, 1)


def inverse_frequencies(documents: DataFrame) -> np.ndarray:
    """idf of every term id over all documents: each task adds up its own counts, one sum follows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, df, n = Tokens(), np.zeros(DIMS + 1, np.int64), 0
        for b in batches:
            for t in b.text:
                df[term_counts(t, tokens)[0]] += 1
            n += len(b)
        df[DIMS] = n
        ids = np.flatnonzero(df)
        yield pd.DataFrame({"term": ids, "n": df[ids]})

    rows = documents.select(whole_text().alias("text")).mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMS + 1)
    for r in rows:  # at most DIMS + 1
        df[r["term"]] = r["n"]
    return np.log((1 + df[DIMS]) / (1 + df[:DIMS])).astype(np.float32) + 0.1


def fit(documents: DataFrame, labels: DataFrame, train: Column | None = None, label: str = "quality", sample: int = SAMPLE) -> tuple:
    """(idf, latent space, the sample's unit vectors, its labels)."""
    ids = one_label(labels, label)
    ids = ids.where(train) if train is not None else ids
    ids = staged(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "quality-sample")
    idf = inverse_frequencies(documents)
    sent = documents.sparkSession.sparkContext.broadcast(idf)
    rows = labelled_texts(documents, ids, label)

    def train_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, got = Tokens(), []
        for b in batches:
            for d, t, y in zip(b.doc_id, b.text, b.label, strict=True):
                i, tf = term_counts(t, tokens)
                got.append((d, i, weighted(i, tf, sent.value), y))
        if not got:
            return
        got.sort(key=lambda g: g[0])
        dense = np.zeros((len(got), DIMS), np.float32)
        for r, (_, i, w, _) in enumerate(got):
            dense[r, i] = w
        space = latent_space(dense)
        yield pd.DataFrame({"space": [space.astype(np.float32).tobytes()], "known": [unit(dense @ space).astype(np.float32).tobytes()], "labels": [np.array([g[3] for g in got], np.float32).tobytes()]})

    got = rows.repartition(1).mapInPandas(train_one, "space binary, known binary, labels binary").collect()
    if not got:
        return idf, np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32)
    space = np.frombuffer(got[0]["space"], np.float32).reshape(DIMS, -1)
    return idf, space, np.frombuffer(got[0]["known"], np.float32).reshape(-1, space.shape[1]), np.frombuffer(got[0]["labels"], np.float32)


def score_documents(documents: DataFrame, model: tuple) -> DataFrame:
    """All columns of documents and `score`."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        idf, space, known, labels = sent.value
        tokens = Tokens()
        for texts in batches:
            rows = np.zeros((len(texts), space.shape[1]), np.float32)
            for r, t in enumerate(texts):
                i, tf = term_counts(t, tokens)
                rows[r] = weighted(i, tf, idf) @ space[i]
            yield pd.Series(vote(unit(rows), known, labels), dtype="float64")

    return documents.withColumn("score", scores(whole_text()))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return score_documents(documents, model).select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
