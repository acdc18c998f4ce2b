"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of words with smallest period q and at least max(LEAST, 2 q) words that no neighbouring word extends with period q. Documents are
gathered in blocks and each block gets one suffix array, by prefix doubling over word numbers that are a document's own, so that suffixes of two documents
share nothing. Its LCP intervals, split in two at each of their boundaries, are known by the nearest smaller values alone; there are no tree nodes. A square
of period d that the next word does not continue stands at i exactly if suffixes i and i + d share d words, so they part at an interval of depth d, on either side
of one boundary. For each boundary only the smaller side is read: a suffix i there asks by the inverse array whether i + d or i - d stands on the other side. Each run
holds one such square for its period, at its end; rotating it to the left, word by word, gives the run's start. Squares whose period is a multiple of a run's period
and which lie in that run are merged into it.

Time is n log n for each document, whatever it repeats, and memory follows the words of a block (BLOCK) or of one longer document. All of it is narrow: nothing is shuffled.

Edge cases: null and empty texts and texts of ASCII white space have no words and no runs; words are compared as they are, with no change of case; repeated rows and rows
with a null id are documents of their own; an empty table gives an empty result; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, whole_text

#: Fewest words of a run.
LEAST = 12
#: Words that are searched together.
BLOCK = 200_000
#: Suffixes that one step of the test reads, steps of a rotation that all squares take together, and rounds of jumps before a plain scan.
STEP, TOGETHER, JUMPS = 2_000_000, 32, 64
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def number_words(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word: the place where its document first has it. Every document ends with a number of its own, as the block begins with one. Also each document's first place."""
    starts, parts, at = [], [np.zeros(1, np.int64)], 1
    for words in docs:
        starts.append(at)
        parts += [np.fromiter(map({}.setdefault, words, range(at, at + len(words))), np.int64, len(words)), np.array([at + len(words)])]
        at += len(words) + 1
    return np.concatenate(parts), np.array(starts, np.int64)


def suffix_array(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix array, its inverse, LCP of each suffix with the one before it; one more 0 at the end). The last element is like no other."""
    n = len(x)
    sa = np.argsort(x, kind="stable")
    first = np.concatenate([[True], np.diff(x[sa]) != 0])
    parted = np.where(first, 0, -1)  # the round in which a suffix and the one before it part
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, h, turn = [rank.astype(np.int32)], 1, 0
    open_ = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(open_):
        turn += 1
        mine = sa[open_]
        key = rank[mine] * n + rank[mine + h]
        order = np.argsort(key, kind="stable")
        mine, key = mine[order], key[order]
        sa[open_] = mine
        first = np.concatenate([[True], np.diff(key) != 0])
        parted[open_[first & (parted[open_] < 0)]] = turn
        rank[mine] = np.maximum.accumulate(np.where(first, open_, 0))
        open_ = open_[~(first & np.append(first[1:], True))]
        h *= 2
        levels.append(rank.astype(np.int32))
    lcp = np.zeros(n + 1, np.int64)
    rest = np.flatnonzero(parted > 0)
    for level in reversed(range(len(levels) - 1)):
        some = rest[parted[rest] > level]
        a, b, known = sa[some - 1], sa[some], lcp[some]
        same = levels[level][a + known] == levels[level][b + known]
        lcp[some[same]] += 1 << level
    return sa, rank, lcp


def nearest_smaller(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place of a positive LCP: the nearest place before it with a smaller one, and the nearest after it with one that is not larger."""
    places = np.flatnonzero(lcp > 0)
    before, after = np.arange(len(lcp)) - 1, np.arange(len(lcp)) + 1
    for near, passes in ((before, np.greater_equal), (after, np.greater)):
        active = places
        for _ in range(JUMPS):
            active = active[passes(lcp[near[active]], lcp[active])]
            if not len(active):
                break
            near[active] = near[near[active]]
        else:
            values, jumps = lcp.tolist(), near.tolist()
            for k in active.tolist() if near is before else reversed(active.tolist()):
                j = jumps[k]
                while passes(values[j], values[k]):
                    j = jumps[j]
                jumps[k] = j
            near[:] = jumps
    return places, before[places], after[places]


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares that the next word does not continue. Of both sides of a boundary the smaller is read."""
    places, low, high = nearest_smaller(lcp)
    left = places - low <= high - places
    begin, size = np.where(left, low, places), np.where(left, places - low, high - places)
    other_low, other_high, depth = np.where(left, places, low), np.where(left, high, places), lcp[places]
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // STEP)) + 1).tolist(), len(places)]
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for a, b in pairwise(cuts):
        m = size[a:b]
        at = np.repeat(begin[a:b] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        i, d, lo, hi = sa[at], np.repeat(depth[a:b], m), np.repeat(other_low[a:b], m), np.repeat(other_high[a:b], m)
        to = isa[i + d]
        yes = (lo <= to) & (to < hi)
        found.append((i[yes], d[yes]))
        back = i - d
        to = isa[np.maximum(back, 0)]
        yes = (back > 0) & (lo <= to) & (to < hi)
        found.append((back[yes], d[yes]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def rotated(x: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far left the squares may be rotated: the starts of their runs."""
    at, active = start.copy(), np.arange(len(start))
    for _ in range(TOGETHER):
        active = active[x[at[active] - 1] == x[at[active] - 1 + period[active]]]
        if not len(active):
            return at
        at[active] -= 1
    for k in active.tolist():
        s, d, width = int(at[k]), int(period[k]), 64
        while True:
            a = max(s - width, 0)
            differ = np.flatnonzero(x[a:s] != x[a + d : s + d])
            if len(differ):
                at[k] = a + differ[-1] + 1
                break
            s, width = a, 2 * width
    return at


def runs_in(x: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period."""
    start, period = branching_squares(*suffix_array(x))
    end = start + 2 * period
    order = np.lexsort((period, end))
    end, period, out = end[order], period[order], [np.empty((3, 0), np.int64)]
    while len(end):
        # The shortest square at an end has its run's smallest period; of the longer ones those that lie in the run and have a multiple of it are the same run.
        head = np.concatenate([[True], np.diff(end) != 0])
        e, q = end[head], period[head]
        s = rotated(x, e - 2 * q, q)
        out.append(np.stack([s, e - s, q]))
        of = np.cumsum(head) - 1
        rest = ~head & ~((period % q[of] == 0) & (2 * period <= (e - s)[of]))
        end, period = end[rest], period[rest]
    start, length, period = np.concatenate(out, axis=1)
    keep = length >= least
    order = np.lexsort((period[keep], start[keep]))
    return start[keep][order], length[keep][order], period[keep][order]


def search(docs: list[list[bytes]], least: int = LEAST) -> tuple[list[np.ndarray], list[bytes]]:
    """For each document its runs, as rows of start, length and period, and its words joined by blanks, each run but its first period left out."""
    x, starts = number_words(docs)
    start, length, period = runs_in(x, least)
    of = np.searchsorted(starts, start, side="right") - 1
    change = np.zeros(len(x) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change) == 0
    rows = np.stack([start - starts[of] if len(of) else start, length, period], axis=1)
    bounds = np.searchsorted(of, np.arange(len(docs) + 1))
    texts = [b" ".join(compress(words, keep[a : a + len(words)].tolist()) if m < n else words) for words, a, m, n in zip(docs, starts.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return [rows[m:n] for m, n in zip(bounds[:-1], bounds[1:], strict=True)], texts


def find_runs(documents: DataFrame, least: int = LEAST, words_of: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) for each row of documents: the runs by start, then period, and the words that are left once each run keeps its first period only.

    words_of(doc_id, words): the words to search instead of the text's own."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, docs, size = [], [], 0
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                words = text.as_buffer().to_pybytes().split()  # bytes are split at ASCII white space alone
                ids.append(i)
                docs.append(words_of(i, words) if words_of else words)
                size += len(words) + 1
                if size >= BLOCK:
                    yield found(ids, docs)
                    ids, docs, size = [], [], 0
            if docs:
                yield found(ids, docs)

    def found(ids: list, docs: list[list[bytes]]) -> pa.RecordBatch:
        runs, texts = search(docs, least)
        flat = np.concatenate(runs)
        offsets = np.cumsum([0, *map(len, runs)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(blocks, f"doc_id long, runs array<{RUN}>, collapsed string")


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the query searches: of one document in ten, by the checksum of its id, what follows a place is made to repeat."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), words_of=repeated_tail)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select("doc_id", "runs", "collapsed", best.alias("b")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"), F.floor(1000 * F.col("b.length") / -F.col("b.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
