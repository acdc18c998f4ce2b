"""Hard negatives: for each anchor and each of its nearest rows of the same label, the best rows of other labels whose score lies in a window below the positive's.

Both steps, positives and negatives, are searches for the best scores in windows, and work by bounds on a spanning tree of anchors. Rows and anchors are dealt to cells
around the same roots, chosen from a bounded sample, and cells are cut into bounded blocks; a pair of cells whose scores cannot reach any window of its anchors is left out
before anything is shuffled for it. Each remaining pair of blocks is a task. It spans its anchors by a tree of least edges and goes down from the root: a candidate's score at an
anchor is its score at the parent, plus or minus the edge's length times the candidate's norm, and so on where the parent's is a bound itself. Only candidates whose bounds meet a
window of the anchor are scored again. The least score that a window can return is known from the sample beforehand. The search is exact, in integers.

Equal vectors of a label are one point that carries its smallest ids, as many as a result can hold, so a vector that a third of all rows share costs no more than any other. Labels are
spread over buckets for the positives, so anchors meet few rows of other labels there.

Edge cases: rows with a null vec_id, label or vector, or with null or non-finite components, take no part; zero vectors do; vectors meet only those of their own length; repeated (vec_id, label, vector)
rows count once; a vec_id with several vectors or labels is several rows, and an anchor never meets rows of its own vec_id; equal scores go to the smaller vec_id; a positive with a negative score
has an empty window; anchors without positives, and positives without negatives, give no rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table
from .vectors import COVER_SAMPLE, FLUSH, ROOTS, lengths, matrix, spread_roots

BLOCK_ROWS, ANCHOR_BLOCK, BUCKETS = 4_096, 1_024, 16
#: Share of a block's candidates from which on all are scored in one product.
DENSE = 0.5
LEAST, MOST = -(2**62), 2**62


def whole_rows(rows: DataFrame, vector: str, label: str, by: float) -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v holds floor(by * x) as doubles."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    ok = F.col("vec_id").isNotNull() & F.col(label).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad
    return rows.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * F.lit(by)).cast("double")).alias("v"))


def distinct_points(rows: DataFrame, keep: int) -> DataFrame:
    """(label, v, ids): each distinct vector of a label once, with its `keep` smallest ids. Tasks keep that many themselves before the shuffle."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, bytes], list[int]] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame({"label": [k[0] for k in seen], "key": [k[1] for k in seen], "ids": [sorted(set(x))[:keep] for x in seen.values()]})

        for b in batches:
            for i, y, v in zip(b.vec_id, b.label, b.v, strict=True):
                held = seen.setdefault((y, (np.asarray(v) + 0.0).tobytes()), [])
                held.append(i)
                if len(held) > 4 * keep:
                    held[:] = sorted(set(held))[:keep]
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
        if seen:
            yield out()

    some = rows.mapInPandas(local, "label long, key binary, ids array<long>")
    merged = some.groupBy("label", "key").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"label": b.label, "v": [np.frombuffer(k, np.float64) for k in b.key], "ids": b.ids})

    return merged.mapInPandas(unpack, "label long, v array<double>, ids array<long>")


def spanning_tree(anchors: np.ndarray) -> list[tuple[int, int, float]]:
    """(anchor, parent, length of the edge) of a tree of least edges, parents first. The root, parent -1, is the anchor nearest to the middle."""
    far = np.sqrt(((anchors - anchors.mean(axis=0)) ** 2).sum(1))
    near, parent, out = np.full(len(anchors), np.inf), np.full(len(anchors), -1), []
    open_ = np.ones(len(anchors), bool)
    k, edge = int(far.argmin()), 0.0
    while True:
        out.append((k, int(parent[k]), edge))
        open_[k] = False
        if not open_.any():
            return out
        d = np.sqrt(((anchors - anchors[k]) ** 2).sum(1))
        closer = open_ & (d < near)
        near[closer], parent[closer] = d[closer], k
        k = int(np.where(open_, near, np.inf).argmin())
        edge = float(near[k])


def tree_scores(anchors: np.ndarray, points: np.ndarray, low: np.ndarray, high: np.ndarray, admitted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor the points whose score may lie from low to high, and their exact scores.

    admitted(anchor): which points it may have at all. A parent's scores and bounds are kept until its last child has used them."""
    norm = np.sqrt((points**2).sum(1))
    length = np.sqrt((anchors**2).sum(1))
    # Sums of doubles are exact up to 2^53; beyond, products are summed as integers.
    exact = float(norm.max() * length.max()) * points.shape[1] < 2**52
    x, a = (points, anchors) if exact else (points.astype(np.int64), anchors.astype(np.int64))
    tree = spanning_tree(anchors)
    children = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(anchors))
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k, parent, edge in tree:
        if parent < 0:
            score, slack = np.zeros(len(points)), norm * length[k]
        else:
            score, slack = held[parent][0], held[parent][1] + edge * norm
            children[parent] -= 1
            if not children[parent]:
                del held[parent]
        rounding = 1e-9 * slack + 1e-12 * norm * length[k] + 1e-6
        some = admitted(k) & (score + slack + rounding >= low[k]) & (score - slack - rounding <= high[k])
        if parent < 0:
            some[:] = True  # the root's scores are the start of all bounds
        at = np.flatnonzero(some)
        now = (x @ a[k])[at] if len(at) > DENSE * len(points) else x[at] @ a[k]
        score = score.copy()
        score[at], slack[at] = now, 0.0
        if children[k]:
            held[k] = score, slack
        yield k, at, now.astype(np.int64)


def best_in(score: np.ndarray, ids: list[np.ndarray], own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows among points of these scores, ties by id, without the anchor's own id."""
    if len(score) > k + 1:  # a point has at least one id, and one at most is the anchor's own
        cut = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
        at = np.flatnonzero(score >= cut)
        score, ids = score[at], [ids[i] for i in at]
    if not len(score):
        return np.empty(0, np.int64), score
    every, scores = np.concatenate(ids), np.repeat(score, [len(i) for i in ids])
    other = every != own
    every, scores = every[other], scores[other]
    order = np.lexsort((every, -scores))[:k]
    return every[order], scores[order]


def block_search(same_label: bool, k: int):
    """The k best rows of a block of points in each window of each anchor of a block."""

    def search(points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(asked):
            label, ids = points.label.to_numpy(), [np.asarray(i, np.int64) for i in points.ids]
            anchors, own = matrix(asked.v), asked.anchor_id.to_numpy()
            admitted = lambda a: (label == asked.label.iat[a]) == same_label
            for a, at, score in tree_scores(anchors, matrix(points.v), asked.low.to_numpy(), asked.high.to_numpy(), admitted):
                ok = admitted(a)[at]
                at, score = at[ok], score[ok]
                for n, (low, high) in enumerate(zip(asked.lows.iat[a], asked.highs.iat[a], strict=True)):
                    inside = np.flatnonzero((score >= low) & (score <= high))
                    got, scores = best_in(score[inside], [ids[i] for i in at[inside]], own[a], k)
                    out.append(pd.DataFrame({"anchor_id": own[a], "variant": asked.variant.iat[a], "window": n, "vec_id": got, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("anchor_id", "variant", "window", "vec_id", "score")}).astype("int64")

    return search


def cell_pairs(roots: np.ndarray, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Pairs of cells of a bucket that may hold results, at most BUCKETS * ROOTS ** 2, with the first block of either and the cells' numbers of blocks.

    data: bucket, cell, n, radius; asked: also low and high, between which the scores lie that its anchors may return."""
    for t, size in ((data, BLOCK_ROWS), (asked, ANCHOR_BLOCK)):
        t["cuts"] = -(-t.n // size)
        t["first"] = t.cuts.cumsum() - t.cuts
    both = data.merge(asked, on="bucket", suffixes=("_d", "_q"))
    norms, d, q = np.linalg.norm(roots, axis=1), both.cell_d.to_numpy(), both.cell_q.to_numpy()
    middle = (roots[d] * roots[q]).sum(1)
    slack = both.radius_d * norms[q] + both.radius_q * norms[d] + both.radius_d * both.radius_q
    slack = slack * (1 + 1e-9) + 1e-12 * norms[d] * norms[q] + 1e-6
    both = both[(middle + slack >= both.low) & (middle - slack <= both.high)]
    return both[["bucket", "cell_d", "cell_q", "first_d", "cuts_d", "first_q", "cuts_q"]].astype("int64")


def window_search(points: DataFrame, asked: DataFrame, sample: tuple[np.ndarray, np.ndarray, np.ndarray], same_label: bool, k: int) -> DataFrame:
    """(anchor_id, variant, window, vec_id, score): the k best rows in each window of each anchor, of the same label or of others, of each pair of blocks.

    asked: anchor_id, variant, label, v, lows, highs. A row's windows need not be apart."""
    spark, roots = points.sparkSession, spread_roots(sample[0], ROOTS)
    heads = roots[: -(-asked.count() // ANCHOR_BLOCK)]
    if not len(heads):
        return spark.createDataFrame([], "anchor_id long, variant long, window long, vec_id long, score long")
    sent = spark.sparkContext.broadcast((*sample, roots, heads))

    def dealt(x: np.ndarray, roots: np.ndarray) -> dict[str, np.ndarray]:
        near = ((roots**2).sum(1) - 2 * x @ roots.T).argmin(1)
        return {"cell": near.astype(np.int64), "far": np.sqrt(((x - roots[near]) ** 2).sum(1))}

    def deal_points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(**dealt(matrix(b.v), sent.value[3]))

    def deal_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, labels, ids, _, heads = sent.value
        for b in batches:
            lows = []
            for i, y, v, low, high in zip(b.anchor_id, b.label, b.v, b.lows, b.highs, strict=True):
                # Each point of the sample but the anchor's own stands for a row, so its kth score in a window is the least that the window can return.
                score = np.sort((x @ np.asarray(v))[((labels == y) == same_label) & (ids != i)])
                raised = np.array(low, np.int64)
                for n, (lo, hi) in enumerate(zip(low, high, strict=True)):
                    at = np.searchsorted(score, hi, side="right") - k
                    if at >= 0 and score[at] > lo:
                        raised[n] = int(score[at] - 1)
                lows.append(raised)
            yield b.assign(lows=lows, low=[min(x, default=MOST) for x in lows], high=[max(x, default=LEAST) for x in b.highs], **dealt(matrix(b.v), heads))

    bucket = (F.pmod(F.xxhash64("label"), F.lit(BUCKETS)) if same_label else F.lit(0)).cast("long").alias("bucket")
    mine = staged(points.mapInPandas(deal_points, "label long, v array<double>, ids array<long>, cell long, far double").select("*", bucket), "neg-cells")
    wanted = staged(asked.mapInPandas(deal_anchors, "anchor_id long, variant long, label long, v array<double>, lows array<long>, highs array<long>, low long, high long, cell long, far double").select("*", bucket), "neg-anchor-cells")
    size = [F.count("*").alias("n"), F.max("far").alias("radius")]
    pairs = cell_pairs(roots, mine.groupBy("bucket", "cell").agg(*size).toPandas(), wanted.groupBy("bucket", "cell").agg(*size, F.min("low").alias("low"), F.max("high").alias("high")).toPandas())
    pairs = F.broadcast(spark.createDataFrame(pairs, "bucket long, cell_d long, cell_q long, first_d long, cuts_d long, first_q long, cuts_q long"))
    blocks = lambda k: F.explode(F.sequence(F.col(f"first_{k}"), F.col(f"first_{k}") + F.col(f"cuts_{k}") - 1)).alias(f"block_{k}")
    own = lambda k, *key: (F.col(f"first_{k}") + F.pmod(F.xxhash64(*key), F.col(f"cuts_{k}"))).alias(f"block_{k}")
    left = mine.withColumnRenamed("cell", "cell_d").join(pairs, ["bucket", "cell_d"]).select(own("d", "label", "v"), blocks("q"), "label", "v", "ids")
    right = wanted.withColumnRenamed("cell", "cell_q").join(pairs, ["bucket", "cell_q"]).select(blocks("d"), own("q", "anchor_id", "variant"), "anchor_id", "variant", "label", "v", "lows", "highs", "low", "high")
    key = ["block_d", "block_q"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(block_search(same_label, k), "anchor_id long, variant long, window long, vec_id long, score long")


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, vector: str = "embedding", label: str = "label", by: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that meets `anchors`, and each of its `positives` best rows of the same label,
    the `negatives` best rows of other labels that score from low to high hundredths of the positive's score. Scores are inner products of floor(by * x)."""
    whole = whole_rows(rows, vector, label, by)
    points = staged(distinct_points(whole, max(positives, negatives) + 1), "neg-points")
    asked = staged(whole.where(anchors).distinct().select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("variant"), "label", "v"), "neg-anchors")
    found = rows.sparkSession.createDataFrame([], "anchor_id long, variant long, positive_id long, positive_score long, negative_id long, negative_score long, place int")
    for dims in lengths(points):
        mine, ours = points.where(F.size("v") == dims), asked.where(F.size("v") == dims)
        got = mine.orderBy(F.xxhash64("label", "v"), F.element_at("ids", 1)).limit(COVER_SAMPLE).select("v", "label", F.element_at("ids", 1).alias("id")).toPandas()
        sample = matrix(got.v), got.label.to_numpy(), got.id.to_numpy()
        whole_line = [F.array(F.lit(x).cast("long")).alias(n) for n, x in (("lows", LEAST), ("highs", MOST))]
        near = window_search(mine, ours.select("*", *whole_line), sample, True, positives)
        best = Window.partitionBy("anchor_id", "variant").orderBy(F.desc("score"), "vec_id")
        near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
        near = near.groupBy("anchor_id", "variant").agg(F.array_sort(F.collect_list(F.struct(F.col("place").alias("n"), "vec_id", "score"))).alias("near"))
        edge = lambda share, up: F.transform("near", lambda p: F.ceil(p["score"] * share / F.lit(100).cast("decimal(3,0)")).cast("long") if up else F.floor(p["score"] * share / F.lit(100).cast("decimal(3,0)")).cast("long"))
        with_windows = staged(ours.join(near, ["anchor_id", "variant"]).withColumns({"lows": edge(low, True), "highs": edge(high, False)}), "neg-windows")
        hard = window_search(mine, with_windows.drop("near"), sample, False, negatives)
        named = with_windows.select("anchor_id", "variant", F.posexplode("near").alias("window", "p")).select("anchor_id", "variant", F.col("window").cast("long").alias("window"), F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
        best = Window.partitionBy("anchor_id", "variant", "window").orderBy(F.desc("score"), "vec_id")
        hard = hard.withColumn("place", F.row_number().over(best)).where(F.col("place") <= negatives).join(named, ["anchor_id", "variant", "window"])
        found = found.unionByName(hard.select("anchor_id", "variant", "positive_id", "positive_score", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "place"))
    return found.select("anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = d.label AS same, d.vec_id, CAST(list_inner_product(a.e, d.e) AS BIGINT) AS score
      FROM v a JOIN v d ON a.vec_id % 100 = 0 AND a.vec_id <> d.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
