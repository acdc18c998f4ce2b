"""Mixing sources to target weights: temperature mixing with budgeted block permutations, DataFrame operations only.

Token shares p of the sources become weights p^a / sum p^a. The exponent a in [0, 1] is bisected to the largest entropy target
or repetition limit it can meet: the entropy of the weights falls and the fewest-token source's repetition falls as a grows, so
the answer is the largest a whose entropy is at least ENTROPY times ln(number of sources), or, where that would repeat
a source more than REPEATS times within the budget, the smallest a that keeps to the limit.

A source's part of the budget is then realised: its documents stand in a seeded permutation, whole passes come first, and a
last part pass takes documents while their tokens before them are fewer than what is left. All copies are dealt in proportion
over blocks of BLOCK_TOKENS tokens of the mixture, and each block is permuted by a seeded hash.

A hot source is never held in one task: its documents are dealt over sqrt(n) buckets by the hash that orders them, the
buckets' sums are added up first, and only places inside a bucket need a window.

Edge cases: null text counts no tokens and null sources are one source of their own; documents without tokens are kept with the
whole passes only and once at least when nothing of the source has tokens; repeated rows are documents of their own only if
(doc_id, text) differ in their order hash, else they tie and stay side by side; an empty table gives an empty result; equal
hashes are ordered by doc_id. Other columns never clash in op5, as only doc_id, source and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, whole_text

SEED, ENTROPY, REPEATS, BLOCK_TOKENS = "mix-1", 0.98, 4.0, 65_536
#: Bisection halves [0, 1] so often.
HALVINGS = 40
TOKEN = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A seeded 52-bit hash of the parts, which Spark and SQL engines compute alike."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(SEED))), 1, 13), 16, 10).cast("long")


def sources(rows: DataFrame) -> DataFrame:
    """(source, docs, tokens): one row for each source."""
    return rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("source_tokens"))


def exponent(stats: DataFrame, budget: Column | None = None, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """Bisection over the table of sources. Each job evaluates the seven midpoints that three halvings can need, in one pass."""
    total = stats.agg(F.sum("source_tokens").alias("t"), F.count(F.when(F.col("source_tokens") > 0, 1)).alias("n")).first()
    if not total["t"] or total["n"] < 2:
        return 1.0
    p = F.col("source_tokens") / F.lit(float(total["t"]))
    want = entropy * math.log(total["n"])

    def measure(points: list[float]) -> list[tuple[float, float]]:
        """Entropy and largest repetition for each exponent; the budget is the corpus's tokens."""
        cols = []
        for k, a in enumerate(points):
            w = F.pow(p, F.lit(a))
            cols += [F.sum(w).alias(f"s{k}"), F.sum(w * F.ln(w)).alias(f"l{k}"), F.max(w / p).alias(f"m{k}")]
        r = stats.where(F.col("source_tokens") > 0).agg(*cols).first()
        return [(math.log(r[f"s{k}"]) - r[f"l{k}"] / r[f"s{k}"], r[f"m{k}"] / r[f"s{k}"]) for k in range(len(points))]

    def bisect(holds) -> tuple[float, float]:
        """[lo, hi] around the largest exponent for which it holds: it holds at lo."""
        lo, hi = 0.0, 1.0
        for _ in range(-(-HALVINGS // 3)):
            points = [lo + (hi - lo) * k / 8 for k in range(1, 8)]
            good = [holds(*x) for x in measure(points)]
            k = 4  # three halvings, from the midpoint
            for step in (2, 1, 0):
                lo, hi = (points[k - 1], hi) if good[k - 1] else (lo, points[k - 1])
                k += step if good[k - 1] else -step
        return lo, hi

    (at0,), (at1,) = measure([0.0]), measure([1.0])
    a = 1.0 if at1[0] >= want else bisect(lambda h, _: h >= want)[0]
    (now,) = measure([a])
    if now[1] > repeats:  # a larger exponent repeats less
        a = bisect(lambda _, m: m > repeats)[1] if at0[1] > repeats else a
    return a


def mix(documents: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each copy: doc_id, source, row_hash, tokens, copy (from 1), block, position in the block (from 1)."""
    rows = documents.select("doc_id", "source", tokens(whole_text()).alias("tokens"), F.xxhash64(whole_text()).alias("row_hash"))
    rows = staged(rows.withColumn("u", unit_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "mix-rows")
    stats = staged(sources(rows), "mix-sources")
    a = exponent(stats, entropy=entropy, repeats=repeats)
    whole = stats.agg(F.sum("source_tokens").alias("t"), F.sum(F.when(F.col("source_tokens") > 0, F.pow(F.col("source_tokens").cast("double"), F.lit(a)))).alias("z")).first()
    budget, z = float(whole["t"] or 0), float(whole["z"] or 1)
    blocks = max(1, math.ceil(budget / block_tokens))
    plan = stats.select(
        "source",
        "source_tokens",
        F.ceil(F.sqrt("docs")).cast("long").alias("buckets"),
        F.when(F.col("source_tokens") > 0, F.round(F.lit(budget) * F.pow(F.col("source_tokens").cast("double"), F.lit(a)) / F.lit(z)).cast("long")).otherwise(F.lit(0)).alias("due"),
    )
    return realise(rows, plan, blocks)


SALTS = 64


def realise(rows: DataFrame, plan: DataFrame, blocks: int) -> DataFrame:
    """rows: doc_id, source, tokens, row_hash, u; plan: source, source_tokens, buckets, due."""
    salted = plan.withColumn("plan_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "plan_source")
    placed = (
        rows.withColumn("salt", (F.col("u") % SALTS).cast("int"))
        .join(salted, (F.col("salt") == F.col("plan_salt")) & F.col("source").eqNullSafe(F.col("plan_source")))
        .select(*rows.columns, "source_tokens", "due", F.floor(F.col("u") * F.col("buckets") / F.lit(float(1 << 52))).cast("long").alias("bucket"))
    )
    placed = staged(placed, "mix-placed")
    sums = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
    before = sums.select("source", "bucket", (F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    before = before.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce("before", F.lit(0)).alias("bucket_before"))
    inside = Window.partitionBy("source", "bucket").orderBy("u", "doc_id", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    ordered = ordered.join(before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))).withColumn("at", F.col("bucket_before") + F.col("inside"))
    passes = F.when(F.col("source_tokens") > 0, F.floor(F.col("due") / F.col("source_tokens"))).otherwise(F.lit(1)).cast("long")
    left = F.col("due") - passes * F.col("source_tokens")
    copies = passes + F.when((F.col("source_tokens") > 0) & (F.col("at") < left), 1).otherwise(0)
    each = ordered.withColumn("copies", copies).where(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    stream = (F.col("copy") - 1) * F.col("source_tokens") + F.col("at")
    block = F.when(F.col("due") > 0, F.least(F.lit(blocks - 1), F.floor(stream * F.lit(blocks) / F.col("due")))).otherwise(F.lit(0)).cast("long")
    dealt = each.select("doc_id", "source", "row_hash", "tokens", "copy", block.alias("block"), unit_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("copy")).alias("h"))
    return dealt.withColumn("position", F.row_number().over(Window.partitionBy("block").orderBy("h", "doc_id", "copy", "row_hash")).cast("long")).drop("h")


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """documents as the mixture takes them: a row for each copy, in the order of blocks and of places in a block; columns as they were, whatever their names.

    Rows that repeat both id and text are numbered, and each gets the copies that the mixture has for one of them, so that no budget is exceeded."""
    key = lambda i, h: F.concat(F.coalesce(i.cast("string"), F.lit("")), F.lit("|"), h.cast("string"))
    plan = staged(mix(documents, **settings), "mix-plan")
    same = Window.partitionBy("doc_id", "row_hash", "copy").orderBy("block", "position")
    plan = plan.select(key(F.col("doc_id"), F.col("row_hash")).alias("key"), F.row_number().over(same).alias("nth_planned"), "block", "position")
    plain = [f"`{n}`" for n, kind in documents.dtypes if "map<" not in kind and "variant" not in kind]
    rows = documents.select(F.struct("*").alias("row"), key(F.col("doc_id"), F.xxhash64(whole_text())).alias("key"), F.xxhash64(*plain).alias("tie"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("tie"))).drop("tie")
    # The numbers are compared outside the key, so that rows stay where their numbering has put them.
    out = rows.join(plan, (rows["key"] == plan["key"]) & F.col("nth").between(F.col("nth_planned"), F.col("nth_planned"))).select("row", "block", "position")
    return out.repartitionByRange("block", "position").sortWithinPartitions("block", "position").select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", "tokens", "copy", "block", "position")


OP5_SQL = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
         CAST(('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), '{SEED}')), 1, 13)) AS BIGINT) AS u
  FROM documents),
s AS (SELECT source, sum(tokens) AS st, count(*) AS docs FROM r GROUP BY source),
c AS (SELECT sum(st) AS t, count(*) FILTER (st > 0) AS n FROM s),
pts AS (SELECT CAST(st AS DOUBLE) / t AS p FROM s, c WHERE st > 0),
one AS (SELECT -sum(p * ln(p)) AS h1 FROM pts),
b(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1,
         CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
  FROM (SELECT b.i, b.lo, b.hi, (b.lo + b.hi) / 2 AS mid,
               (SELECT ln(sum(pow(p, (b.lo + b.hi) / 2))) - sum(pow(p, (b.lo + b.hi) / 2) * ln(pow(p, (b.lo + b.hi) / 2))) / sum(pow(p, (b.lo + b.hi) / 2)) FROM pts)
               >= {ENTROPY} * (SELECT ln(n) FROM c) AS ok
        FROM b WHERE b.i < 42)),
e AS (SELECT CASE WHEN (SELECT h1 FROM one) >= {ENTROPY} * (SELECT ln(n) FROM c) THEN 1.0 ELSE lo END AS a FROM b WHERE i = 42),
z AS (SELECT sum(pow(CAST(st AS DOUBLE), a)) AS z FROM s, e WHERE st > 0),
plan AS (SELECT source, st, CASE WHEN st > 0 THEN CAST(round(CAST(t AS DOUBLE) * pow(CAST(st AS DOUBLE), a) / z) AS BIGINT) ELSE 0 END AS due,
                greatest(1, CAST(ceil(t / {BLOCK_TOKENS}.0) AS BIGINT)) AS blocks FROM s, c, e, z),
o AS (SELECT r.*, st, due, blocks, coalesce(sum(tokens) OVER (PARTITION BY r.source ORDER BY u, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
      FROM r JOIN plan ON r.source IS NOT DISTINCT FROM plan.source),
k AS (SELECT *, CASE WHEN st > 0 THEN CAST(floor(CAST(due AS DOUBLE) / st) AS BIGINT) ELSE 1 END AS passes FROM o),
x AS (SELECT *, unnest(range(1, passes + CASE WHEN st > 0 AND prior < due - passes * st THEN 1 ELSE 0 END + 1)) AS copy FROM k),
y AS (SELECT doc_id, source, tokens, copy,
             CASE WHEN due > 0 THEN CAST(least(blocks - 1, floor(CAST(((copy - 1) * st + prior) * blocks AS DOUBLE) / due)) AS BIGINT) ELSE 0 END AS block,
             CAST(('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), CAST(copy AS VARCHAR), '{SEED}')), 1, 13)) AS BIGINT) AS h
      FROM x)
SELECT doc_id, source, tokens, CAST(copy AS BIGINT) AS copy, block, row_number() OVER (PARTITION BY block ORDER BY h, doc_id, copy) AS position FROM y
"""
