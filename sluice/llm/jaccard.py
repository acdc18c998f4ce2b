"""N-gram Jaccard join: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, exactly.

Jaccard distance d = 1 - |x & y| / |x | y| is a metric, and the join works by pivots and regions. Document pivots alone would leave
nearly all documents at distance 1 from all of them, so that no window could separate anything. The first pivots are therefore
sets of one shingle: a document is nearest, at 1 - 1/n, to the shingles that it holds, ties go to the rarer shingle, and as
two documents within 0.2 differ in at most n // 5 of a document's shingles, it is enough to be replicated to the cells of its
first n // 5 + 1 shingles (`shingles.prefix_length`): the window of a document whose nearest pivot is missing from its partner.
Inside a cell the place of its shingle in a document's order bounds the distance further: what comes before it is missing from
a partner that first meets the document there (`admits`).

Each cell then takes the member that most others share cells with as its document pivot, so that near copies of a text, which share most cells, meet few pivots, and the cells of a pivot
make up its region. Members within 0.2 of their pivot are linked to it and, through it, to each other: they form one component, and none of their pairs is formed. A region whose members are of one
component is settled.

A region of several components and at most LARGE members is a leaf: its members of different components are compared, by sketches, then sets. Larger ones join recursively. In a pivot's region a member x is known by its difference D(x), the shingles that it or the pivot has but not both, and the symmetric difference of two members is that
of their differences: |D(x)| + |D(y)| - 2 |D(x) & D(y)|. Two that are linked, one of them farther than 0.2 from the pivot, therefore share shingles of their differences, o at least (`shared_least`), by the triangle
inequality; and the same replication goes on one level down, over what members lack or have beside the pivot: those that no other member of the region has come first, so a member that has many of
them of its own meets nobody. What meets is compared by differences, which are short where documents are near.
Members whose sketch shows that they are not related to the pivot (RELATED), such as documents that share a passage with it, have no short difference: they meet the others of their
cells by sizes, places and parities instead (`met_in_cells`). Nothing is dropped, so results are exact up to collisions of 64-bit hashes. Equal sets are one point.
Shingles that a scan finds to be common come later in the order, the commoner the later; which ones does not change results.

Edge cases: null texts and texts without words have an empty set and are linked with nothing; fewer than five words make one
shingle; a null doc_id never names a component (one of only such documents has a null component_id); rows that
repeat a doc_id are documents of their own; an empty table gives an empty result; very long texts are hashed whole; ties between
pivots go to the set hash. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, lean, staged, table, whole_text
from .shingles import prefix_length, shingle_sets

#: Shingles that one step of the scan for common ones looks at together; common ones stand in at least COMMON documents.
LOOK, COMMON, MOST_COMMON = 4_000_000, 8, 1 << 20
#: Texts whose sets a Python worker makes at a time.
PORTION = 512
#: Members up to which a region is a leaf, whose members are compared with each other.
LARGE = 64
RATIO = 0.8
#: Words of 64 bits of the parities that pairs meet by.
PARITIES = 4
#: A member and a pivot are related if their sketches differ in at most one bit for so many shingles of both.
RELATED = 5
#: Bits of the smallest parity sketch. A larger set has as many bits as shingles, rounded up to a power of two.
LEAST_BITS = 256
#: log2 of the bits of the filters that keep most rows out of a shuffle. Their size is fixed; where they fill up, more rows are shuffled.
FILTER_BITS = 25


def set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "big", signed=True)


def common_shingles(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that many documents hold, at most MOST_COMMON, and log2 of how many. A scan adds up those that occur twice within a step; it may miss rarer ones, which only costs time."""

    @lean
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()

        def out() -> pd.DataFrame:
            every = np.concatenate(held)
            held.clear()
            every.sort()
            at = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
            n = np.diff(np.append(at, len(every)))
            return pd.DataFrame({"s": every[at[n > 1]].view(np.int64), "n": n[n > 1]})

        for b in batches:
            for at in range(0, len(b), PORTION):
                for s in shingle_sets(list(b.text[at : at + PORTION])):
                    if len(s) and (k := set_id(s)) not in seen:  # copies of a text are one set
                        seen.add(k)
                        held.append(s)
                        size += len(s)
            if size > LOOK:
                yield out()
                size, seen = 0, set()
        if held:
            yield out()

    rows = documents.select(whole_text().alias("text")).mapInPandas(look, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    got = rows.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "s").limit(MOST_COMMON).select("s", F.floor(F.log2("n")).cast("int").alias("level")).toPandas()
    s = got.s.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(s)
    return s[order], got.level.to_numpy(np.int8)[order]


def window_of(s: np.ndarray, common: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order that all sets share: by level of frequency, then hash."""
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        rank = np.where(common[at] == s, level[at], 0)
        s = s[np.argsort(rank, kind="stable")]
    return s[: prefix_length(len(s))].view(np.int64)


def parities(s: np.ndarray) -> np.ndarray:
    """For each of 2^k bits, whether an odd number of the set's shingles falls on it; in words of 64 bits."""
    size = max(LEAST_BITS, 1 << (len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def scan(documents: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, text_hash, set_id, n, window, sketch) for each row; window and sketch only where a task first sees a set."""
    sent = documents.sparkSession.sparkContext.broadcast(common)

    @F.pandas_udf("set_id long, n long, window array<long>, sketch array<long>")
    @lean
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for texts in (b[at : at + PORTION] for b in batches for at in range(0, len(b), PORTION)):
            rows = []
            for s in shingle_sets(list(texts)):
                k, window, sketch = set_id(s) if len(s) else 0, None, None
                if len(s) and k not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(k)
                    window, sketch = window_of(s, *sent.value), parities(s)
                rows.append((k, len(s), window, sketch))
            yield pd.DataFrame(rows, columns=["set_id", "n", "window", "sketch"])

    rows = documents.select("doc_id", whole_text().alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), sets("text").alias("r")).select("doc_id", "text_hash", "r.*")


def perhaps_in(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """rows whose key (a 64-bit hash) may stand in wanted; a join has to follow. The filter is a bitmap of a fixed 2^FILTER_BITS bits."""
    bit = lambda k: F.pmod(k, F.lit(1 << FILTER_BITS))
    word, mask = lambda k: F.shiftright(bit(k), 6).cast("int"), lambda k: F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))")
    words = wanted.groupBy(word(F.col(key)).alias("word_")).agg(F.bit_or(mask(key)).alias("mask_"))
    return rows.join(F.broadcast(words), word(F.col(key)) == F.col("word_")).where(F.col("mask_").bitwiseAND(mask(key)) != 0).drop("word_", "mask_")


def region_members(scanned: DataFrame) -> DataFrame:
    """(cell, set_id, n, pos) of the regions that hold more than one set. In small regions only members that could be linked with another there stay."""
    entries = scanned.where(F.col("window").isNotNull()).select(F.posexplode("window").alias("pos", "cell"), "set_id", "n")
    shared = entries.groupBy("cell").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")).where("lo <> hi").select("cell")
    shared = staged(shared, "jac-shared")
    every = staged(perhaps_in(entries, "cell", shared).join(shared, "cell").select("cell", "set_id", "n", "pos").distinct(), "jac-entries")
    large = staged(every.groupBy("cell").count().where(F.col("count") > LARGE).select("cell"), "jac-large")
    a = every.join(large, "cell", "left_anti").toDF("cell", "a", "n_a", "pos_a")
    b = every.toDF("cell_b", "b", "n_b", "pos_b")
    some = a.join(b, (F.col("cell") == F.col("cell_b")) & (F.col("a") != F.col("b")) & admits(), "left_semi").toDF(*every.columns)
    out = staged(some.unionByName(every.join(large, "cell", "left_semi")), "jac-members")
    discard(shared, every, large)
    return out


def points_of(windows: DataFrame) -> DataFrame:
    """(set_id, text_hash, sketch): one text and the sketch of each set."""
    rows = windows.where(F.col("sketch").isNotNull())
    return staged(rows.groupBy("set_id").agg(F.min(F.struct("text_hash", "sketch")).alias("x")).select("set_id", "x.*"), "jac-points")


def sets_of(documents: DataFrame, close: DataFrame) -> DataFrame:
    """(set_id, shingles) of the sets in close pairs. Each is made once more from one of its texts."""

    @F.pandas_udf("array<long>")
    @lean
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for at in range(0, len(texts), PORTION):
                yield pd.Series([s.view(np.int64) for s in shingle_sets(list(texts[at : at + PORTION]))], dtype=object)

    side = lambda k: close.select(F.col(k).alias("set_id"), F.col(f"text_{k}").alias("text_hash"))
    texts = staged(side("a").unionByName(side("b")).distinct(), "jac-wanted")
    rows = documents.select(whole_text().alias("text")).withColumn("text_hash", F.xxhash64("text"))
    # Copies of a text are one before the shuffle, and the join that follows needs no other.
    one = perhaps_in(rows, "text_hash", texts).groupBy("text_hash").agg(F.min("text").alias("text")).join(texts, "text_hash")
    out = staged(one.select("set_id", shingles("text").alias("shingles")), "jac-shingles")
    discard(texts)
    return out


def least_overlap(n_a: Column, n_b: Column) -> Column:
    """The smallest intersection of sets of these sizes with a similarity of RATIO: 4 / 9 of both sizes, rounded up."""
    return F.floor((4 * (n_a + n_b) + 8) / 9)


def admits() -> Column:
    """Members a and b of a region may be linked and first meet in its shingle: sizes allow it, and what stands before the shingle in either's order, which the other lacks, leaves enough."""
    n_a, n_b = F.col("n_a"), F.col("n_b")
    least = least_overlap(n_a, n_b)
    return (5 * F.least(n_a, n_b) >= 4 * F.greatest(n_a, n_b)) & (F.col("pos_a") <= n_a - least) & (F.col("pos_b") <= n_b - least)


def close_pairs(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs (a, b, n_a, n_b, text_a, text_b) with `bits`, in how many bits their sketches differ: at most as many as their sets do in shingles. Sketches of sizes 2^k and 2^(k+1) meet once the larger is folded.
    Only those of at most RELATED of their shingles stay, which links always are."""
    a, b = (points.select(F.col("set_id").alias(k), F.col("text_hash").alias(f"text_{k}"), F.col("sketch").alias(f"s_{k}")) for k in "ab")
    half = lambda s: (F.size(s) / 2).cast("int")
    xor = lambda x, y: F.zip_with(x, y, lambda u, v: u.bitwiseXOR(v))
    folded = lambda s, other: F.when(F.size(s) > F.size(other), xor(F.slice(s, F.lit(1), half(s)), F.slice(s, half(s) + 1, half(s)))).otherwise(s)
    differ = F.aggregate(xor(folded(F.col("s_a"), F.col("s_b")), folded(F.col("s_b"), F.col("s_a"))), F.lit(0), lambda n, x: n + F.bit_count(x))
    both = pairs.join(a, "a").join(b, "b").withColumn("bits", differ)
    return both.where(F.col("bits") * RELATED <= F.col("n_a") + F.col("n_b")).select(*pairs.columns, "text_a", "text_b", "bits")


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b, n_a, n_b) of a member and a pivot, with `diff`, the shingles that one of them has. b, which may be the pivot of many, is joined last."""
    a, b = (perhaps_in(sets, "set_id", pairs.select(F.col(k).alias("set_id"))).toDF(k, f"s_{k}") for k in "ab")
    both = pairs.join(a, "a").join(b, "b")
    return both.select(*pairs.columns, F.concat(F.array_except("s_a", "s_b"), F.array_except("s_b", "s_a")).alias("diff"))


def most_apart(n_a: Column, n_b: Column) -> Column:
    """The largest symmetric difference of sets of these sizes that are linked."""
    return n_a + n_b - 2 * least_overlap(n_a, n_b)


def stars(edges: DataFrame) -> bool:
    """Every node has one edge, and none of them leads to a node with an edge of its own."""
    many = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    return many.unionByName(edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").select("u")).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that edges (a, b) reach, by alternating large and small stars; nodes without edges are left out."""
    edges = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "jac-star")
    while not stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        old, edges = edges, staged(small.distinct(), "jac-star")
        discard(old)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """labels (node, component) once links (a, b) are added: only components that links touch are looked at."""
    if labels is None:
        return staged(components(links), "jac-labels")
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(nodes.select("node", F.col("node").alias("component")))
    of = lambda k: labels.select(F.col("node").alias(k), F.col("component").alias(f"c_{k}"))
    joined = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    joined = components(joined).select(F.col("node").alias("component"), F.col("component").alias("now"))
    return staged(every.join(joined, "component", "left").select("node", F.coalesce("now", "component").alias("component")), "jac-labels")


def with_components(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("set_id"))
    return members.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))


def pivots_of(members: DataFrame) -> DataFrame:
    """(cell, b, n_b): of each cell the member that shares cells with most others, counted over all its cells; ties go to the set hash."""
    sizes = members.groupBy("cell").agg(F.count("*").alias("m"))
    known = members.join(sizes, "cell").groupBy("set_id").agg(F.sum("m").alias("company"))
    best = F.max(F.struct("company", F.xxhash64("set_id").alias("tie"), F.col("set_id").alias("b"), F.col("n").alias("n_b"))).alias("x")
    return members.join(known, "set_id").groupBy("cell").agg(best).select("cell", "x.b", "x.n_b")


def regions_of(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): the regions of all pivots. A set is in those whose pivot one of its cells has; the pivot itself is left out."""
    return members.join(pivots, "cell").where(F.col("set_id") != F.col("b")).select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), "b", "n_b").distinct()


def open_regions(regions: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b, component): the members of regions of several components, in which two members and the pivot are not linked yet. It is all sums by key, so a region need not fit a task."""
    at = with_components(regions.withColumnRenamed("a", "set_id"), labels).withColumnRenamed("set_id", "a")
    of_pivot = labels.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
    at = staged(at.join(of_pivot, "b", "left").withColumn("c_b", F.coalesce("c_b", "b")), "jac-region-parts")
    several = at.groupBy("b").agg(F.count("*").alias("m"), F.max(F.col("component") != F.col("c_b")).alias("several")).where("m > 1 and several").select("b")
    return at.join(several, "b", "left_semi").select("a", "n_a", "b", "n_b", "component")


def met_in_small_regions(members: DataFrame) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of members of a region (a, n_a, b, component) of at most LARGE that may be linked by their sizes and are of several components: for a member at most LARGE in each of its regions."""
    side = lambda k: members.select(F.col("b").alias("pivot"), F.col("a").alias(k), F.col("n_a").alias(f"n_{k}"), F.col("component").alias(f"c_{k}"))
    n_a, n_b = F.col("n_a"), F.col("n_b")
    possible = (F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & (5 * F.least(n_a, n_b) >= 4 * F.greatest(n_a, n_b))
    return side("a").join(side("b"), "pivot").where(possible).select("a", "b", "n_a", "n_b").distinct()


def shared_least(d_a: Column, d_b: Column, n_a: Column, n_b: Column) -> Column:
    """How many shingles of their differences two linked members share at least."""
    return F.ceil((d_a + d_b - most_apart(n_a, n_b)) / 2)


def odd_bits() -> Column:
    """In how many bits the parities of two members' differences differ."""
    return reduce(lambda n, k: n + F.bit_count(F.col("odd_a")[k].bitwiseXOR(F.col("odd_b")[k])), range(1, PARITIES), F.bit_count(F.col("odd_a")[0].bitwiseXOR(F.col("odd_b")[0])))


def could_meet(own: DataFrame) -> DataFrame:
    """(pivot, a): in regions of up to LARGE members only those that sizes and parities leave a partner of another component; all members of larger ones."""
    large = own.groupBy("pivot").count().where(F.col("count") > LARGE).select("pivot")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    a = own.join(large, "pivot", "left_anti").select("pivot", "a", "n_a", F.col("far").alias("far_a"), F.col("component").alias("c_a"), F.col("odd").alias("odd_a"))
    b = own.select(F.col("pivot").alias("at"), F.col("a").alias("b"), F.col("n_a").alias("n_b"), F.col("far").alias("far_b"), F.col("component").alias("c_b"), F.col("odd").alias("odd_b"))
    possible = (F.col("c_a") != F.col("c_b")) & (F.col("far_a") | F.col("far_b")) & (5 * F.least(n_a, n_b) >= 4 * F.greatest(n_a, n_b)) & (odd_bits() <= most_apart(n_a, n_b))
    some = a.join(b, (F.col("pivot") == F.col("at")) & possible, "left_semi").select("pivot", "a")
    return some.unionByName(own.join(large, "pivot", "left_semi").select("pivot", "a"))


def met_in_regions(diffs: DataFrame) -> DataFrame:
    """(pivot, a, b, n_a, n_b, c_b, bits) of members of a region that may be linked and are of several components; one of them is far from the pivot.

    diffs: pivot, a, n_a, far, component, diff. bits: in how many bits the parities of their differences differ, at most as many as shingles. Shingles of differences that one member alone has come first in its order, then rarer ones; as of members' cells, only places up to d - shared_least can be
    where two linked members first meet."""
    parity = [F.expr(f"aggregate(filter(diff, h -> pmod(shiftright(h, 6), {PARITIES}) = {k}), 0L, (s, h) -> s ^ shiftleft(1L, cast(pmod(h, 64) as int)))") for k in range(PARITIES)]
    own = staged(diffs.select("pivot", "a", "n_a", F.size("diff").alias("d"), "far", "component", F.array(*parity).alias("odd")), "jac-own")
    entries = diffs.join(could_meet(own), ["pivot", "a"], "left_semi").select("pivot", "a", F.explode("diff").alias("e"), "far", "component")
    # Only shingles that a far member and one of another component both have can be where they meet.
    shared = entries.groupBy("pivot", "e").agg(F.count("*").alias("times"), F.max("far").alias("any_far"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi and any_far")
    some = staged(entries.select("pivot", "a", "e").join(shared.select("pivot", "e", "times"), ["pivot", "e"]), "jac-shared-diff")
    order = Window.partitionBy("pivot", "a").orderBy("times", "e")
    held = F.count("*").over(Window.partitionBy("pivot", "a"))
    # Shingles of its own come before; those that only near members, or only one component, share are counted with them, as no member that it may meet has them.
    placed = some.withColumn("behind", held - F.row_number().over(order) + 1).join(own, ["pivot", "a"]).withColumn("place", F.col("d") - F.col("behind"))
    # The farthest place for any partner: differences of linked members differ by at most a quarter of either's shingles.
    placed = staged(placed.where(F.col("place") <= F.floor(F.col("n_a") / 4) + 1).drop("behind"), "jac-places")
    x = placed.where("far").select("pivot", "e", "a", "n_a", F.col("d").alias("d_a"), F.col("component").alias("c_a"), F.col("place").alias("place_a"), F.col("odd").alias("odd_a"))
    y = placed.select("pivot", "e", F.col("a").alias("b"), F.col("n_a").alias("n_b"), F.col("d").alias("d_b"), F.col("far").alias("far_b"), F.col("component").alias("c_b"), F.col("place").alias("place_b"), F.col("odd").alias("odd_b"))
    bits = odd_bits()
    n_a, n_b, d_a, d_b = (F.col(c) for c in ("n_a", "n_b", "d_a", "d_b"))
    least = shared_least(d_a, d_b, n_a, n_b)
    possible = (F.col("c_a") != F.col("c_b")) & (~F.col("far_b") | (F.col("a") < F.col("b"))) & (5 * F.least(n_a, n_b) >= 4 * F.greatest(n_a, n_b)) & (F.col("place_a") <= d_a - least) & (F.col("place_b") <= d_b - least) & (bits <= most_apart(n_a, n_b))
    met = staged(x.join(y, ["pivot", "e"]).where(possible).select("pivot", "a", "b", "n_a", "n_b", "c_b", bits.alias("bits")).distinct(), "jac-met")
    discard(own, some, placed)
    return met


def links_by_difference(met: DataFrame, diffs: DataFrame) -> DataFrame:
    """The links (a, b) among members that met, by the size of what their differences share."""
    side = lambda k: diffs.select("pivot", F.col("a").alias(k), F.col("diff").alias(f"diff_{k}"))
    both = met.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"])
    apart = F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    return both.where(apart <= most_apart(F.col("n_a"), F.col("n_b"))).select("a", "b")


def with_differences(regions: DataFrame, documents: DataFrame) -> DataFrame:
    """Members a of regions of pivots b (a staged table, with a text of each) and their `diff`."""
    sets = sets_of(documents, regions)
    out = staged(differences(regions.drop("text_a", "text_b"), sets), "jac-diffs")
    discard(sets)
    return out


def met_in_cells(members: DataFrame, pivots: DataFrame, strangers: DataFrame, labels: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs (a, b, n_a, n_b, bits) of members of a cell that may be linked and are of several components, one of which is not related to the cell's pivot.

    strangers: (a, b), members and pivots that are not related. They meet the rest of a cell by size, by place and by parities, all in the join's condition."""
    odd = points.select("set_id", *[F.aggregate(F.expr(f"filter(sketch, (w, i) -> i % {PARITIES} = {k})"), F.lit(0).cast("long"), lambda s, w: s.bitwiseXOR(w)).alias(f"odd{k}") for k in range(PARITIES)])
    here = members.join(pivots.select("cell", F.col("b").alias("pivot")), "cell").join(strangers.select("pivot").distinct(), "pivot", "left_semi")
    here = here.join(strangers.select("pivot", F.col("a").alias("set_id"), F.lit(True).alias("strange")), ["pivot", "set_id"], "left").where(F.col("set_id") != F.col("pivot"))
    here = staged(with_components(here.join(odd, "set_id"), labels).withColumn("strange", F.coalesce("strange", F.lit(False))), "jac-strangers")
    side = lambda k: here.select("cell", F.col("set_id").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("n", "pos", "component", "strange", *[f"odd{i}" for i in range(PARITIES)])])
    bits = reduce(lambda n, k: n + F.bit_count(F.col(f"odd{k}_a").bitwiseXOR(F.col(f"odd{k}_b"))), range(1, PARITIES), F.bit_count(F.col("odd0_a").bitwiseXOR(F.col("odd0_b"))))
    once = ~F.col("strange_b") | (F.col("a") < F.col("b"))
    possible = (F.col("component_a") != F.col("component_b")) & once & admits() & (bits <= most_apart(F.col("n_a"), F.col("n_b")))
    met = staged(side("a").where("strange_a").join(side("b"), "cell").where(possible).select("a", "b", "n_a", "n_b").distinct(), "jac-met-cells")
    discard(here)
    return met


def links_by_sets(met: DataFrame, points: DataFrame, documents: DataFrame) -> DataFrame:
    """The links (a, b) among members that met in cells: sketches, then sets."""
    most = most_apart(F.col("n_a"), F.col("n_b"))
    close = staged(close_pairs(met, points).where(F.col("bits") <= most).drop("bits"), "jac-close")
    found = with_differences(close, documents)
    discard(close)
    return found.where(F.size("diff") <= most).select("a", "b")


def joined_regions(members: DataFrame, points: DataFrame, documents: DataFrame) -> DataFrame:
    """(node, component) of the sets in regions that links join."""
    pivots = staged(pivots_of(members), "jac-pivots")
    regions = staged(regions_of(members, pivots), "jac-regions")
    # Who is within 0.2 of a pivot: sketches first, then sets.
    most = most_apart(F.col("n_a"), F.col("n_b"))
    related = staged(close_pairs(regions, points), "jac-close")
    near = with_differences(staged(related.where(F.col("bits") <= most).drop("bits"), "jac-near"), documents)
    labels = merged(None, near.where(F.size("diff") <= most).select("a", "b"))
    open_ = staged(open_regions(regions, labels), "jac-open")
    here = staged(open_.join(related.select("a", "b", "text_a", "text_b", "bits"), ["a", "b"]), "jac-open-related")
    strangers = staged(open_.join(related.select("a", "b"), ["a", "b"], "left_anti").select("a", F.col("b").alias("pivot")), "jac-strange")
    # Small regions are compared as they are; of large ones the differences to their pivots are made.
    large = staged(here.groupBy("b").count().where(F.col("count") > LARGE).select("b"), "jac-large-regions")
    pairs = staged(met_in_small_regions(here.join(large, "b", "left_anti")), "jac-met-small")
    known = here.drop("text_a", "text_b", "bits").join(large, "b", "left_semi").join(near.select("a", "b", "diff"), ["a", "b"])
    rest = staged(here.where(F.col("bits") > most).drop("bits").join(large, "b", "left_semi").select("a", "n_a", "b", "n_b", "component", "text_a", "text_b"), "jac-rest")
    diffs = staged(known.unionByName(with_differences(rest, documents)).select(F.col("b").alias("pivot"), "a", "n_a", (F.size("diff") > most).alias("far"), "component", "diff"), "jac-open-diffs")
    discard(regions, related, near, open_, here, large, rest)
    met = met_in_regions(diffs)
    # A member needs one link to a component: the likeliest first, then all that are still apart.
    likely = Window.partitionBy("a", "c_b").orderBy("bits", "b", "pivot")
    ranked = staged(met.withColumn("nth", F.row_number().over(likely)).select("pivot", "a", "b", "n_a", "n_b", "nth"), "jac-ranked")
    labels = merged(labels, links_by_difference(ranked.where("nth = 1").drop("nth"), diffs))
    rest = still_apart(ranked.where("nth > 1").drop("nth"), labels)
    labels = merged(labels, links_by_difference(rest, diffs))
    discard(diffs, met, ranked)
    met = met_in_cells(members, pivots, strangers, labels, points)
    out = merged(labels, links_by_sets(met.unionByName(still_apart(pairs, labels)), points, documents))
    discard(pivots, strangers, pairs, met)
    return out


def still_apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """pairs (a, b) of several components."""
    of = lambda k: labels.select(F.col("node").alias(k), F.col("component").alias(f"now_{k}"))
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")).select(*pairs.columns)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) for each row of documents."""
    windows = staged(scan(documents, common_shingles(documents)), "jac-windows")
    scanned = staged(windows.drop("window", "sketch"), "jac-scan")
    members, points = region_members(windows), points_of(windows)
    discard(windows)
    return label_documents(scanned, joined_regions(members, points, documents))


def label_documents(scanned: DataFrame, labels: DataFrame) -> DataFrame:
    """Components of sets to components of documents, each named by its smallest doc_id."""
    sets = scanned.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    sets = staged(with_components(sets, labels), "jac-sets")
    names = sets.groupBy("component").agg(F.min("least").alias("component_id"))
    named = staged(sets.join(names, "component").select("set_id", "component_id"), "jac-named")
    out = scanned.select("doc_id", "text_hash", "set_id", "n").join(named, "set_id", "left")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def kept_documents(documents: DataFrame) -> DataFrame:
    """documents with one row of each group: that of the smallest doc_id, then text hash, then hash of all its columns; documents without words all stay."""
    groups = staged(near_duplicates(documents), "jac-groups")
    best = groups.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("x")).select("x.doc_id", "x.text_hash")
    times = groups.where("n_shingles > 0").groupBy("doc_id", "text_hash").agg(F.count("*").alias("times"))
    best = best.join(times, best.doc_id.eqNullSafe(times.doc_id) & (best.text_hash == times.text_hash)).select(best.doc_id.alias("best_id"), best.text_hash.alias("best_hash"), "times")
    best = staged(best.unionByName(groups.where("n_shingles = 0").select("doc_id", "text_hash", F.lit(1).cast("long")).distinct().toDF("best_id", "best_hash", "times")), "jac-best")
    rows = documents.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(whole_text()).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("text_hash") == F.col("best_hash"))
    # Few rows repeat both id and text; they are settled apart, added up in tasks first, so that a row that a third of all rows repeat is no hot group.
    once = rows.join(best.where("times = 1"), same, "left_semi").select("row.*")
    again = rows.join(best.where("times > 1"), same, "left_semi").groupBy("doc_id", "text_hash")
    return once.unionByName(again.agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row.*"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
