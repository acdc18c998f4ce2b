"""Vector search: a forest of random-projection trees, and dual cover trees for exact inner products.

op1: the forest's hyperplanes are fitted on a bounded sample (FOREST_SAMPLE vectors, in hash order) and broadcast. Every row is
routed to one leaf of each tree. Queries search all trees through one shared priority queue, best margin first, until the
leaves visited hold WANTED of the sample, and meet the rows of those leaves in a shuffle by (tree, leaf). Candidates are
ranked again by exact distance in double precision.

op6: rows and queries are dealt to cells around the same roots, chosen from a bounded sample, and cells are cut into bounded
blocks. Cells are the upper nodes of both cover trees: a pair of a query cell and a data cell is pruned by their covering radii
against the worst kth score of the query cell, before anything is shuffled for it. Each remaining pair of blocks is a task, which
builds a cover tree of either and searches both together from their roots: a pair of nodes is pruned when no inner product between
them can beat the worst kth score in the query node's subtree. The search is exact.

Equal vectors count as one point that carries its smallest ids, as many as a result can hold, so a vector that a third of all
rows share costs no more than any other.

Edge cases: vectors that are null, hold null or non-finite components, or (op1) are zero take no part, as queries or as
candidates; so do rows with a null vec_id; vectors of another length than the most usual one are searched among their own kind;
repeated (vec_id, vector) rows count once; a vec_id that repeats with different vectors is one query,
and counts once among the candidates, with the best of them all; a query has fewer rows when there are fewer candidates; equal distances or scores
go to the smaller vec_id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

TREES, FOREST_SAMPLE, LEAF, WANTED = 12, 16_384, 24, 0.1
#: Rows of a leaf that one task meets; larger leaves are cut into parts.
LEAF_ROWS = 4_096
COVER_SAMPLE, ROOTS, BLOCK_ROWS, QUERY_BLOCK, COVER_LEAF = 4_096, 48, 4_096, 16_384, 64
#: Ids that a task holds for distinct vectors before it passes them on.
FLUSH = 100_000


def valid(rows: DataFrame, vector: str = "embedding", zero: bool = True) -> DataFrame:
    """(vec_id, v) of the rows that take part; v is an array of doubles."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad
    rows = rows.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows if zero else rows.where(F.exists("v", lambda x: x != 0))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): each distinct vector once, with its `keep` smallest ids. Tasks keep that many themselves before the shuffle."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, list[int]] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame({"key": list(seen), "ids": [sorted(set(x))[:keep] for x in seen.values()]})

        for b in batches:
            for i, v in zip(b.vec_id, b.v, strict=True):
                held = seen.setdefault((np.asarray(v, np.float64) + 0.0).tobytes(), [])
                held.append(i)
                if len(held) > 4 * keep:
                    held[:] = sorted(set(held))[:keep]
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
        if seen:
            yield out()

    some = rows.mapInPandas(local, "key binary, ids array<long>")
    merged = some.groupBy("key").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"v": [np.frombuffer(k, np.float64) for k in b.key], "ids": b.ids})

    return merged.mapInPandas(unpack, "v array<double>, ids array<long>")


def sample_vectors(points: DataFrame, most: int, dims: int) -> np.ndarray:
    """At most `most` vectors of the given length, in hash order."""
    got = points.where(F.size("v") == dims).orderBy(F.xxhash64("v"), F.element_at("ids", 1)).limit(most).select("v").toPandas()
    return np.array([np.asarray(x) for x in got.v]).reshape(-1, dims)


def lengths(points: DataFrame) -> list[int]:
    return [r["d"] for r in points.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").collect()]


class Forest:
    """Random-projection trees: a node splits at the median of its points' projections on the line through two of them."""

    def __init__(self, points: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> None:
        self.normals, self.cuts, self.kids, self.counts, self.roots = [], [], [], [], []
        rng = np.random.default_rng(seed)
        for _ in range(trees):
            self.roots.append(self.grow(points, np.arange(len(points)), leaf, rng))
        self.normals = np.array(self.normals).reshape(len(self.normals), -1)
        self.cuts, self.kids, self.counts = np.array(self.cuts), np.array(self.kids).reshape(-1, 2), np.array(self.counts)

    def grow(self, points: np.ndarray, mine: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        node = len(self.cuts)
        self.normals.append(np.zeros(points.shape[1]))
        self.cuts.append(0.0)
        self.kids.append((-1, -1))
        self.counts.append(len(mine))
        if len(mine) <= leaf:
            return node
        a, b = points[rng.choice(mine, 2, replace=False)]
        normal = a - b
        length = np.linalg.norm(normal)
        if not length:
            return node
        projected = points[mine] @ (normal / length)
        cut = float(np.median(projected))
        low = projected <= cut
        if low.all():
            low = projected < cut
        if not low.any():
            return node
        self.normals[node], self.cuts[node] = normal / length, cut
        self.kids[node] = (self.grow(points, mine[low], leaf, rng), self.grow(points, mine[~low], leaf, rng))
        return node

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        at = np.tile(np.array(self.roots), (len(vectors), 1))
        while True:
            inner = self.kids[at, 0] >= 0
            if not inner.any():
                return at
            r, t = np.nonzero(inner)
            node = at[r, t]
            right = np.einsum("ij,ij->i", vectors[r], self.normals[node]) > self.cuts[node]
            at[r, t] = self.kids[node, right.astype(int)]

    def search(self, vector: np.ndarray, wanted: float) -> list[int]:
        """Leaves of all trees, by one queue: nearest to the query's own side first, until they hold `wanted` sample points."""
        margins = self.normals @ vector - self.cuts
        queue, found, held = [(0.0, r) for r in self.roots], [], 0
        heapq.heapify(queue)
        while queue and (held < wanted or len(found) < len(self.roots)):
            far, node = heapq.heappop(queue)
            low, high = self.kids[node]
            if low < 0:
                found.append(int(node))
                held += self.counts[node]
                continue
            m = margins[node]
            heapq.heappush(queue, (max(far, m), int(low)))
            heapq.heappush(queue, (max(far, -m), int(high)))
        return found


def nearest_in_leaf(x: np.ndarray, square: np.ndarray, ids: list[np.ndarray], query_ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """Exact distances of the points that a blocked product shows to be among a query's k + 1 nearest of the leaf (its own vector may be one)."""
    rough = square[None, :] - 2 * queries @ x.T
    if len(x) > k + 1:
        cut = np.partition(rough, k, axis=1)[:, k] + 1e-9 * (1 + np.abs(square).max())
        q, p = np.nonzero(rough <= cut[:, None])
    else:
        q, p = (a.ravel() for a in np.indices(rough.shape))
    d = np.sqrt(((x[p] - queries[q]) ** 2).sum(1))
    times = np.array([len(i) for i in ids])[p]
    out = pd.DataFrame({"query_id": np.repeat(query_ids[q], times), "vec_id": np.concatenate([ids[i] for i in p]), "score": np.repeat(d, times)})
    out = out[out.query_id != out.vec_id].sort_values(["query_id", "score", "vec_id"])
    return out.groupby("query_id").head(k)


def approximate_neighbours(rows: DataFrame, queries: F.Column, k: int = 10, trees: int = TREES, wanted: float = WANTED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row that meets `queries`, by Euclidean distance."""
    spark = rows.sparkSession
    points = staged(distinct_vectors(valid(rows, zero=False), k + 1), "vec-points")
    asked = staged(valid(rows, zero=False).where(queries).withColumnRenamed("vec_id", "query_id").dropDuplicates(), "vec-queries")
    parts = []
    for dims in lengths(points):
        sample = sample_vectors(points, FOREST_SAMPLE, dims)
        forest = spark.sparkContext.broadcast(Forest(sample, trees))
        n = len(sample)

        def route(batches: Iterator[pd.DataFrame], forest=forest) -> Iterator[pd.DataFrame]:
            for b in batches:
                leaves = forest.value.route(np.array([np.asarray(v) for v in b.v]))
                yield pd.DataFrame({"leaf": list(leaves.astype(np.int32)), "v": b.v, "ids": b.ids})

        def ask(batches: Iterator[pd.DataFrame], forest=forest, n=n) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"query_id": b.query_id, "v": b.v, "leaf": [np.array(forest.value.search(np.asarray(v), wanted * n * len(forest.value.roots)), np.int32) for v in b.v]})

        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})]
            if len(left) and len(right):
                x, ids = np.array([np.asarray(v) for v in left.v]), [np.asarray(i, np.int64) for i in left.ids]
                square = (x**2).sum(1)
                for at in range(0, len(right), 256):
                    out.append(nearest_in_leaf(x, square, ids, right.query_id.to_numpy()[at : at + 256], np.array([np.asarray(v) for v in right.v[at : at + 256]]), k))
            return pd.concat(out)

        routed = staged(points.where(F.size("v") == dims).mapInPandas(route, "leaf array<int>, v array<double>, ids array<long>"), "vec-routed")
        index = routed.select(F.explode("leaf").alias("leaf"), "v", "ids")
        # As many rows as the fitted forest has leaves, whatever the table's size.
        cuts = F.broadcast(staged(index.groupBy("leaf").agg(F.ceil(F.count("*") / LEAF_ROWS).cast("int").alias("cut")), "vec-leaves"))
        index = index.join(cuts, "leaf").select("leaf", F.pmod(F.xxhash64("v"), F.col("cut")).cast("int").alias("part"), "v", "ids")
        probes = asked.where(F.size("v") == dims).mapInPandas(ask, "query_id long, v array<double>, leaf array<int>").select("query_id", "v", F.explode("leaf").alias("leaf"))
        probes = probes.join(cuts, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("part"), "query_id", "v")
        parts.append(index.groupBy("leaf", "part").cogroup(probes.groupBy("leaf", "part")).applyInPandas(meet, "query_id long, vec_id long, score double"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return ranked(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), F.asc("score"), k)


def ranked(found: DataFrame, order: F.Column, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class CoverTree:
    """A cover tree built level by level. Children of a node are more than half its scale apart, and each point goes to its
    nearest child; nodes of at most `leaf` points are not split. Arrays by node: centre, radius, first and last point, children."""

    def __init__(self, points: np.ndarray, leaf: int = COVER_LEAF) -> None:
        self.centre, self.radius, self.span, self.kids = [], [], [], []
        self.order: list[int] = []
        x = points.astype(np.float64)
        self.build(x, np.arange(len(x)), 0, leaf)
        self.order = np.array(self.order)
        self.centre = x[np.array(self.centre)]
        self.radius = np.array(self.radius)
        self.points = points[self.order]

    def build(self, x: np.ndarray, mine: np.ndarray, centre: int, leaf: int) -> int:
        node, c = len(self.centre), mine[centre]
        far = np.sqrt(((x[mine] - x[c]) ** 2).sum(1))
        self.centre.append(c)
        self.radius.append(float(far.max()))
        self.kids.append([])
        self.span.append((len(self.order), len(self.order) + len(mine)))
        if len(mine) <= leaf or far.max() == 0:
            self.order += mine.tolist()
            return node
        scale, near, who, heads = float(far.max()) / 2, far.copy(), np.zeros(len(mine), np.int64), [centre]
        # At most 2 sqrt(n) children; the next level goes on where that leaves wide ones.
        while near.max() > scale and len(heads) < 2 * int(np.sqrt(len(mine))) + 2:
            h = int(near.argmax())
            d = np.sqrt(((x[mine] - x[mine[h]]) ** 2).sum(1))
            who[d < near] = len(heads)
            near = np.minimum(near, d)
            heads.append(h)
        for k, h in enumerate(heads):
            part = np.flatnonzero(who == k)
            if len(part) == len(mine):
                self.order += mine.tolist()
                return node
            if len(part):
                self.kids[node].append(self.build(x, mine[part], int(np.flatnonzero(part == h)[0]), leaf))
        return node


class Bounds:
    """The worst kth score of the queries below each node of a query tree, raised from the leaves up."""

    def __init__(self, tree: CoverTree, least: np.ndarray) -> None:
        self.tree, self.least = tree, least
        self.parent = np.full(len(tree.kids), -1)
        for node, kids in enumerate(tree.kids):
            self.parent[kids] = node
        self.low = np.empty(len(tree.kids))
        for node in reversed(range(len(tree.kids))):  # children have larger numbers
            self.low[node] = self.worst(node)

    def worst(self, node: int) -> float:
        kids = self.tree.kids[node]
        return self.low[kids].min() if kids else self.least[slice(*self.tree.span[node])].min()

    def raised(self, node: int) -> None:
        while node >= 0 and (now := self.worst(node)) > self.low[node]:
            self.low[node] = now
            node = self.parent[node]


def dual_search(queries: CoverTree, data: CoverTree, worst: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, data place, score) of every data point that may be among a query's k best.

    worst: a lower bound of each query's kth score, in tree order, raised as scores come. Pairs of nodes, from the two roots on, go best bound
    first, so the bounds rise early; of a pair the node with the larger radius is opened."""
    least, top = worst.astype(np.float64), np.full((len(queries.points), k), -(2**62), np.int64)
    bounds = Bounds(queries, least)
    norm_q, norm_d = np.linalg.norm(queries.centre, axis=1), np.linalg.norm(data.centre, axis=1)
    kids_q, kids_d = ([np.array(c, np.int64) for c in t.kids] for t in (queries, data))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def most(q: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The highest inner product that points of the nodes may have."""
        r_q, r_d = queries.radius[q], data.radius[d]
        rounding = 1e-12 * (norm_q[q] + r_q) * (norm_d[d] + r_d) + 1e-6
        return (queries.centre[q] * data.centre[d]).sum(1) + r_q * norm_d[d] + r_d * norm_q[q] + r_q * r_d + rounding

    root = np.zeros(1, np.int64)
    heap = [(-float(most(root, root)[0]), 0, 0)]
    while heap:
        bound, q, d = heapq.heappop(heap)
        if -bound < bounds.low[q]:
            continue
        if len(kids_q[q]) or len(kids_d[d]):
            open_q = len(kids_q[q]) and (not len(kids_d[d]) or queries.radius[q] >= data.radius[d])
            qs, ds = (kids_q[q], np.full(len(kids_q[q]), d)) if open_q else (np.full(len(kids_d[d]), q), kids_d[d])
            limit = most(qs, ds)
            for x in np.flatnonzero(limit >= bounds.low[qs]).tolist():
                heapq.heappush(heap, (-float(limit[x]), int(qs[x]), int(ds[x])))
            continue
        (a, b), (s, e) = queries.span[q], data.span[d]
        new = queries.points[a:b] @ data.points[s:e].T
        r, c = np.nonzero(new >= least[a:b, None])
        if not len(r):
            continue
        found.append((a + r, s + c, new[r, c]))
        rows = np.unique(r)
        both = np.concatenate([top[a + rows], new[rows]], axis=1)
        top[a + rows] = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k :]
        least[a + rows] = np.maximum(least[a + rows], top[a + rows].min(1))
        bounds.raised(q)
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    q, d, score = (np.concatenate(x) for x in zip(*found, strict=True))
    still = score >= least[q]
    return q[still], d[still], score[still]


def scaled(rows: DataFrame, by: float = 256.0) -> DataFrame:
    """Every component x becomes floor(by * x)."""
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(by)).cast("double")))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v) for v in vectors])


def block_search(k: int):
    """The k best of one block of points for every query of one block of queries."""

    def search(points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        queries, data = CoverTree(matrix(asked.v).astype(np.int64)), CoverTree(matrix(points.v).astype(np.int64))
        held, query_ids = [np.asarray(i, np.int64) for i in points.ids], asked.query_id.to_numpy()[queries.order]
        # k + 1 points: the query's own vector may stand among them.
        qs, ds, scores = dual_search(queries, data, asked.least.to_numpy()[queries.order], k + 1)
        of = data.order[ds]
        times = np.array([len(i) for i in held], np.int64)[of]
        vec = np.concatenate([held[i] for i in of]) if len(of) else np.empty(0, np.int64)
        out = pd.DataFrame({"query_id": np.repeat(query_ids[qs], times), "vec_id": vec, "score": np.repeat(scores, times)}).astype("int64")
        out = out[out.query_id != out.vec_id].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return out.drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k)

    return search


def spread_roots(sample: np.ndarray, most: int) -> np.ndarray:
    """At most `most` vectors of the sample, each the farthest from those before it."""
    roots, near = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(roots) < most and near.max() > 0:
        roots.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[roots[-1]]) ** 2).sum(1))
    return sample[roots]


def cell_pairs(roots: np.ndarray, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Pairs of cells (d_cell, q_cell) that may hold results, at most ROOTS ** 2, with the first and last block of either and the cells' numbers of blocks.

    data: cell, n, radius; asked: also least, the worst kth score known of its queries. Cells are the children of the two trees' roots."""
    for t, size in ((data, BLOCK_ROWS), (asked, QUERY_BLOCK)):
        t["cuts"] = -(-t.n // size)
        t["first"] = t.cuts.cumsum() - t.cuts
    d, q = data.cell.to_numpy(), asked.cell.to_numpy()
    norms, r_d, r_q = np.linalg.norm(roots, axis=1), data.radius.to_numpy(), asked.radius.to_numpy()
    rounding = 1e-12 * np.outer(norms[q] + r_q, norms[d] + r_d) + 1e-6
    limit = roots[q] @ roots[d].T + r_q[:, None] * norms[d] + norms[q][:, None] * r_d + np.outer(r_q, r_d) + rounding
    i, j = np.nonzero(limit >= asked.least.to_numpy()[:, None])
    out = {"d_cell": d[j], "q_cell": q[i]}
    for name, t, at in (("d", data, j), ("q", asked, i)):
        out |= {f"{name}_first": t["first"].to_numpy()[at], f"{name}_cuts": t.cuts.to_numpy()[at]}
    return pd.DataFrame(out).astype("int64")


def best_products(rows: DataFrame, queries: F.Column, k: int = 5, by: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products for every row that meets `queries`."""
    spark = rows.sparkSession
    whole = scaled(valid(rows), by)
    points = staged(distinct_vectors(whole, k + 1), "vec-ints")
    asked = staged(whole.where(queries).withColumnRenamed("vec_id", "query_id").dropDuplicates(), "vec-int-queries")
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for dims in lengths(points):
        sample = sample_vectors(points, COVER_SAMPLE, dims)
        roots = spread_roots(sample, ROOTS)
        ours = asked.where(F.size("v") == dims)
        # Roots are in the order of a cover tree's levels: queries take as many of the first as they fill blocks.
        heads = roots[: -(-ours.count() // QUERY_BLOCK)]
        if not len(heads):
            continue
        sent = spark.sparkContext.broadcast((sample, roots, heads))

        def dealt(x: np.ndarray, roots: np.ndarray) -> dict[str, np.ndarray]:
            near = ((roots**2).sum(1) - 2 * x @ roots.T).argmin(1)
            return {"cell": near.astype(np.int64), "far": np.sqrt(((x - roots[near]) ** 2).sum(1))}

        def deal_points(batches: Iterator[pd.DataFrame], sent=sent, dealt=dealt) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame(dealt(matrix(b.v), sent.value[1]) | {"v": b.v, "ids": b.ids})

        def deal_queries(batches: Iterator[pd.DataFrame], sent=sent, dealt=dealt) -> Iterator[pd.DataFrame]:
            sample, _, heads = sent.value
            at = len(sample) - k - 1
            for b in batches:
                for s in range(0, len(b), 1_024):
                    x = matrix(b.v[s : s + 1_024])
                    # A query's own vector in the sample may be none of its candidates, so the bound is its (k+1)th score there.
                    least = np.partition(x @ sample.T, at, axis=1)[:, at] if at >= 0 else np.full(len(x), -(2.0**62))
                    yield pd.DataFrame(dealt(x, heads) | {"least": least, "query_id": b.query_id[s : s + 1_024], "v": b.v[s : s + 1_024]})

        mine = staged(points.where(F.size("v") == dims).mapInPandas(deal_points, "cell long, far double, v array<double>, ids array<long>"), "vec-cells")
        wanted = staged(ours.mapInPandas(deal_queries, "cell long, far double, least double, query_id long, v array<double>"), "vec-query-cells")
        size = [F.count("*").alias("n"), F.max("far").alias("radius")]
        pairs = cell_pairs(roots, mine.groupBy("cell").agg(*size).toPandas(), wanted.groupBy("cell").agg(*size, F.min("least").alias("least")).toPandas())
        pairs = F.broadcast(spark.createDataFrame(pairs, "d_cell long, q_cell long, d_first long, d_cuts long, q_first long, q_cuts long"))
        blocks = lambda k: F.explode(F.sequence(F.col(f"{k}_first"), F.col(f"{k}_first") + F.col(f"{k}_cuts") - 1)).alias(f"{k}_block")
        own = lambda k, key: (F.col(f"{k}_first") + F.pmod(F.xxhash64(key), F.col(f"{k}_cuts"))).alias(f"{k}_block")
        left = mine.join(pairs, F.col("cell") == F.col("d_cell")).select(own("d", "v"), blocks("q"), "v", "ids")
        right = wanted.join(pairs, F.col("cell") == F.col("q_cell")).select(blocks("d"), own("q", "query_id"), "least", "query_id", "v")
        key = ["d_block", "q_block"]
        found = found.unionByName(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(block_search(k), "query_id long, vec_id long, score long"))
    # One shuffle, by query, serves both steps.
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return ranked(best, F.desc("score"), k)


def op1_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approximate_neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op6_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_products(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
