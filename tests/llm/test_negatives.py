from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, ids string"


def plain(rows, asked, positives=5, negative=10):
    """Every product of every anchor, in Python integers."""
    rows = {(i, y, tuple(int(np.floor(256 * c)) for c in v)) for i, v, y in rows if i is not None and y is not None and v and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for i, y, v in rows:
        if not asked(i):
            continue
        scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in rows if j != i and len(v) == len(w)]
        for s, j, _ in sorted(x for x in scores if x[2] == y)[:positives]:
            hard = sorted(x for x in scores if x[2] != y and 30 * -s <= 100 * -x[0] <= 90 * -s)[:negative]
            out += [(i, j, k, n, -s, -t) for k, (t, n, _) in enumerate(hard, 1)]
    return Counter(out)


def made(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(v), y, "s", "i") for i, v, y in rows], SCHEMA)


@pytest.fixture(scope="module")
def groups():
    """Vectors around few heads, of which many rows repeat one, under a few labels."""
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(12, 6)))[rng.integers(0, 12, 900)] + rng.normal(size=(900, 6)) * 0.1
    x[100:400] = x[100]
    y = rng.integers(0, 3, 900)
    y[100:380] = 1
    return [(k, v.tolist(), int(z)) for k, (v, z) in enumerate(zip(x, y, strict=True))]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, groups, monkeypatch, small):
    """Also with a small sample and many blocks of either side, so that bounds decide what is scored."""
    if small:
        for name, value in (("BLOCK_ROWS", 60), ("ANCHOR_BLOCK", 10), ("COVER_SAMPLE", 40), ("BUCKETS", 2)):
            monkeypatch.setattr(negatives, name, value)
    got = negatives.hard_negatives(made(spark, groups), F.col("vec_id") % 9 == 0)
    want = plain(groups, lambda i: i % 9 == 0)
    assert Counter(tuple(r) for r in got.collect()) == want and sum(want.values()) > 500


def test_tree_scores_few(groups):
    """Candidates whose bounds meet no window are not scored, and none that lies in one is left out."""
    x = np.floor(np.array([v for _, v, _ in groups]) * 256)
    a = x[::9]
    s = a @ x.T
    low, high = np.sort(s, axis=1)[:, -12].astype(float), np.full(len(a), 2.0**62)
    scored = 0
    for k, at, score in negatives.tree_scores(a, x, low, high, lambda k: np.ones(len(x), bool)):
        assert set(np.flatnonzero(s[k] >= low[k])) <= set(at.tolist()) and (score == s[k, at]).all()
        scored += len(at)
    assert scored < s.size / 2
    tree = negatives.spanning_tree(a)
    d = np.sqrt(((a[:, None] - a[None]) ** 2).sum(2))
    least, seen = 0.0, {0}
    while len(seen) < len(a):
        i, j = min(((i, j) for i in seen for j in set(range(len(a))) - seen), key=lambda p: d[p])
        least += d[i, j]
        seen.add(j)
    assert sum(e for _, _, e in tree) == pytest.approx(least) and sorted(k for k, _, _ in tree) == list(range(len(a)))


def test_odd_tables(spark):
    """Nulls, not-a-numbers, zero vectors, other lengths, repeated rows, an id of several labels and vectors, large numbers; an empty table."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.5, 1.0], 2), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (2, [0.5, 0.1], 2), (3, None, 1), (4, [nan, 1.0], 1), (5, [None, 1.0], 1), (6, [inf, 0.0], 2), (7, [0.0, 0.0], 2), (8, [0.0, 0.0], 1), (None, [1.0, 1.0], 1), (9, [0.4, 0.2], None), (10, [1.0], 1), (11, [0.5], 2), (12, [1.0], 1), (13, [0.25, 0.25], 3), (14, [], 1), (15, [-1.0, 0.0], 1)]
    rows += [(20 + k, [3e5 + k, 1e5 * k, 7.0], k % 2) for k in range(12)] + [(40 + k, [2e5, 3e4 * k, 1.0], 2) for k in range(12)]
    got = negatives.hard_negatives(made(spark, rows), F.col("vec_id") % 5 == 0)
    want = plain(rows, lambda i: i % 5 == 0)
    assert Counter(tuple(r) for r in got.collect()) == want and {k[0] for k in want} >= {0, 10, 20}
    assert negatives.hard_negatives(made(spark, rows).limit(0), F.lit(True)).count() == 0
    assert negatives.hard_negatives(made(spark, rows), F.col("vec_id") < 0).count() == 0
