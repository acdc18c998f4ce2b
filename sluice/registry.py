"""Queries of the loader's operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions import cells as X
from .functions import metrics as M
from .functions import types as T
from .operators import binding as B
from .operators import blocks as K
from .operators import commit as C
from .operators import defaults as D
from .sources import log as L
from .streaming import loader as S
from .streaming import measures, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ROWS, POLL = 100, 100

# Two clusters with two topics each, whose partitions have the same numbers.
LOG = """WITH RECURSIVE src AS (SELECT *, CASE WHEN user_id // 2 % 2 = 0 THEN 'A' ELSE 'B' END AS zone, CASE WHEN user_id // 4 % 3 = 0 THEN 'audit' ELSE 'events' END AS topic, CAST(user_id % 2 AS BIGINT) AS part FROM events),
 log AS (SELECT zone, topic, part, row_number() OVER (PARTITION BY zone, topic, part ORDER BY event_id) - 1 AS pos, event_type AS tbl, ts, props AS payload, value, event_id AS arrival_seq FROM src)"""
BLOCKS = f""", blk AS (SELECT *, (row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY pos) - 1) // {ROWS} AS block_no FROM log),
 rng AS (SELECT zone, topic, part, tbl, block_no, min(pos) AS begin_pos, max(pos) AS end_pos, count(*) AS cnt, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS bytes, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM blk GROUP BY ALL)"""
META = f""", cut AS (SELECT zone, topic, part, (max(pos) + 1) // 2 AS cut FROM log GROUP BY ALL), old AS (SELECT log.* FROM log JOIN cut USING (zone, topic, part) WHERE pos < cut), oblk AS (SELECT *, (row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY pos) - 1) // {ROWS} AS block_no FROM old),
 orng AS (SELECT zone, topic, part, tbl, block_no, min(pos) AS begin_pos, max(pos) AS end_pos, count(*) AS cnt FROM oblk GROUP BY ALL),
 meta AS (SELECT zone, topic, part, tbl, begin_pos, end_pos, cnt FROM (SELECT *, row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY block_no DESC) AS r FROM orng) WHERE r = 1)"""


def add(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def log(s, d):
    return L.events_log(s, d)


def blocks(s, d):
    return K.cut_rows(log(s, d), ROWS)


def with_size(df):
    """size: messages of each partition. Sizes are a row a partition and are sent to all tasks; a join by SOURCE would gather a partition in one task."""
    return df.join(F.broadcast(df.groupBy(*L.SOURCE).agg((F.max("pos") + 1).alias("size"))), L.SOURCE)


def until_half(df):
    """The first half of each partition's offsets: what was loaded when a replay starts."""
    return with_size(df).withColumn("cut", F.floor(F.col("size") / 2)).drop("size").where(F.col("pos") < F.col("cut")).drop("cut")


def meta(s, d):
    return C.commit_metadata(K.block_ranges(K.cut_rows(until_half(log(s, d)), ROWS)))


def retained(df):
    """What a log still has that keeps 330 offsets before the half of each partition."""
    return with_size(df).withColumn("cut", F.floor(F.col("size") / 2)).drop("size").where(F.col("pos") >= F.col("cut") - 330).drop("cut")


def whole_meta(s, d):
    return C.commit_metadata(K.block_ranges(blocks(s, d)))


WHOLE = BLOCKS + ", meta AS (SELECT zone, topic, part, tbl, begin_pos, end_pos, cnt FROM (SELECT *, row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY block_no DESC) AS r FROM rng) WHERE r = 1)"


# Sources
add("subscribe_clusters", LOG + " SELECT zone, topic, tbl, count(*) AS n FROM log GROUP BY ALL")(lambda s, d: log(s, d).groupBy("zone", "topic", "tbl").agg(F.count("*").alias("n")))
add("poll_batches", LOG + f" SELECT zone, topic, part, pos // {POLL} AS poll, count(*) AS n FROM log GROUP BY ALL")(lambda s, d: L.with_poll_batch(log(s, d), POLL).groupBy(*L.SOURCE, "poll").agg(F.count("*").alias("n")))
add("resume_offsets", LOG + WHOLE + """, f AS (SELECT zone, topic, part, min(begin_pos) AS p FROM meta GROUP BY ALL), t AS (SELECT zone, topic, string_agg('"' || part || '":' || p, ',' ORDER BY part) AS parts FROM f GROUP BY ALL)
 SELECT zone, '{' || string_agg('"' || topic || '":{' || parts || '}', ',' ORDER BY topic) || '}' AS offsets FROM t GROUP BY 1""")(lambda s, d: L.starting_offsets(whole_meta(s, d)))


@add("route_by_header", LOG + " SELECT coalesce(CASE WHEN arrival_seq % 97 <> 0 THEN tbl END, 'rejected') AS dest, count(*) AS n FROM log GROUP BY 1")
def route_by_header(s, d):
    ok, bad = L.route(log(s, d).withColumn("tbl", F.when(F.col("arrival_seq") % 97 != 0, F.col("tbl"))))
    return ok.select(F.col("tbl").alias("dest")).unionByName(bad.select(F.lit("rejected").alias("dest"))).groupBy("dest").agg(F.count("*").alias("n"))


INSERT = "CASE arrival_seq % 4 WHEN 0 THEN 'insert into simple (`id`,`kind`,`score`) values (?,?,?)' WHEN 1 THEN 'insert into simple values (?, ?, ?, ?)' WHEN 2 THEN 'insert into simple (score, id) values (?, ?)' ELSE 'INSERT INTO simple VALUES (?, ?)' END"
SIMPLE = [B.Col("id", "bigint"), B.Col("kind", "string"), B.Col("score", "double", nullable=True), B.Col("status", "string", "default", "'normal'"), B.Col("doubled", "bigint", "materialized", "id * 2"), B.Col("kind_upper", "string", "alias", "upper(kind)")]


def envelopes(s, d, copies=1):
    """Messages of four INSERT shapes, with cells to fit."""
    df = log(s, d)
    text = lambda c: F.col(c).cast("string")
    shape = F.col("arrival_seq") % 4
    df = df.withColumn("c_", F.when(shape == 0, F.array(text("arrival_seq"), F.col("tbl"), text("value"))).when(shape == 1, F.array(text("arrival_seq"), F.col("tbl"), text("value"), F.lit("sent"))).when(shape == 2, F.array(text("value"), text("arrival_seq"))).otherwise(F.array(text("arrival_seq"), F.col("tbl"))))
    body = F.struct(F.lit("s1").alias("shard"), F.col("tbl").alias("table"), (F.col("arrival_seq") % 3 + 1).alias("schema_hash"), F.expr(INSERT).alias("sql"), F.array_repeat("c_", copies).alias("rows"))
    return df.withColumn("payload", F.to_json(body)).drop("c_", "value")


def decoded(s, d, copies=1):
    return B.insert_shape(L.explode_rows(L.decode(envelopes(s, d, copies))))


add("decode_envelope", LOG + f" SELECT arrival_seq, 's1' AS shard, tbl AS envelope_table, arrival_seq % 3 + 1 AS schema_hash, {INSERT} AS sql FROM log")(lambda s, d: L.decode(envelopes(s, d)).select("arrival_seq", "shard", "envelope_table", "schema_hash", "sql"))
add("explode_rows", LOG + " SELECT arrival_seq, CAST(r AS INTEGER) AS row_in_msg FROM log, (SELECT unnest(range(3)) AS r)")(lambda s, d: L.explode_rows(L.decode(envelopes(s, d, 3))).select("arrival_seq", "row_in_msg"))
add("synthetic_log")(lambda s, d: L.synthetic_log(s, log(s, d), 3, 4))
add("insert_shape", LOG + f" SELECT {INSERT} AS sql, CASE arrival_seq % 4 WHEN 0 THEN 'id,kind,score' WHEN 2 THEN 'score,id' ELSE '' END AS names, CASE arrival_seq % 4 WHEN 0 THEN 3 WHEN 1 THEN 4 ELSE 2 END AS placeholders, count(*) AS n FROM log GROUP BY 1, 2, 3")(lambda s, d: decoded(s, d).groupBy("sql", F.array_join("names", ",").alias("names"), "placeholders").agg(F.count("*").alias("n")))
add("insertable_columns", "SELECT * FROM (VALUES ('id', 1), ('kind', 2), ('score', 3), ('status', 4)) t(name, place), (SELECT count(*) AS n FROM events)")(lambda s, d: log(s, d).agg(F.count("*").alias("n")).select(F.posexplode(F.array(*[F.lit(c.name) for c in B.insertable(SIMPLE)])).alias("p", "name"), "n").select("name", (F.col("p") + 1).alias("place"), "n"))


def bound(s, d, shape):
    rows = B.bind(decoded(s, d).where(F.col("arrival_seq") % 4 == shape), SIMPLE)
    return D.fill_defaults(B.project(rows, SIMPLE, ["arrival_seq"]), SIMPLE)


def bound_sql(shape, kind, score, status):
    return LOG + f" SELECT arrival_seq, arrival_seq AS id, {kind} AS kind, {score} AS score, {status} AS status FROM log WHERE arrival_seq % 4 = {shape}"


add("bind_positional", bound_sql(1, "tbl", "value", "'sent'"))(lambda s, d: bound(s, d, 1))
add("bind_prefix", bound_sql(3, "tbl", "CAST(NULL AS DOUBLE)", "'normal'"))(lambda s, d: bound(s, d, 3))
add("bind_named", bound_sql(2, "''", "value", "'normal'"))(lambda s, d: bound(s, d, 2))
add("fill_default_expr", bound_sql(0, "tbl", "value", "'normal'"))(lambda s, d: bound(s, d, 0))
add("fill_type_default", LOG + " SELECT count(*) FILTER (arrival_seq % 4 = 2) AS empty_kind, count(*) FILTER (arrival_seq % 4 = 3) AS null_score FROM log")(lambda s, d: bound(s, d, 2).unionByName(bound(s, d, 3)).agg(F.count(F.when(F.col("kind") == "", 1)).alias("empty_kind"), F.count(F.when(F.col("score").isNull(), 1)).alias("null_score")))
add("explicit_null_kept", LOG + " SELECT arrival_seq, CASE WHEN arrival_seq % 5 <> 0 THEN value END AS score, 'normal' AS status FROM log")(lambda s, d: D.fill_defaults(log(s, d).select("arrival_seq", F.col("arrival_seq").alias("id"), F.col("tbl").alias("kind"), F.when(F.col("arrival_seq") % 5 != 0, F.col("value")).alias("score")), SIMPLE).select("arrival_seq", "score", "status"))
add("reorder_columns", LOG + " SELECT arrival_seq AS id, tbl AS kind, value AS score FROM log")(lambda s, d: B.reorder(log(s, d).select(F.col("value").alias("score"), F.col("tbl").alias("kind"), F.col("arrival_seq").alias("id")), SIMPLE))
add("append_with_defaults", LOG + " SELECT arrival_seq AS id, tbl AS kind, CAST(NULL AS DOUBLE) AS score, 'normal' AS status, arrival_seq * 2 AS doubled, upper(tbl) AS kind_upper FROM log")(lambda s, d: D.derive(D.fill_defaults(log(s, d).select(F.col("arrival_seq").alias("id"), F.col("tbl").alias("kind")), SIMPLE), SIMPLE))


def faulty(s, d):
    """Messages that are bad by rule: an unknown column, too few placeholders, a short row."""
    a = F.col("arrival_seq")
    df = B.insert_shape(L.decode(envelopes(s, d, 2)))
    df = df.withColumn("names", F.when(a % 89 == 0, F.array(F.lit("nope"), F.lit("kind"))).when(a % 83 == 0, F.array(F.lit("id"))).otherwise(F.col("names")))
    df = df.withColumn("placeholders", F.when(a % 89 == 0, 2).when(a % 83 == 0, 2).otherwise(F.col("placeholders")))
    short = F.transform("rows", lambda r, i: F.when(i == 1, F.slice(r, 1, 1)).otherwise(r))
    return df.withColumn("rows", F.when((a % 79 == 0) & (a % 89 != 0) & (a % 83 != 0), short).otherwise(F.col("rows"))).withColumn("bound", B.targets(SIMPLE)).withColumn("error", B.checked(B.message_problem(SIMPLE)))


def fault_sql(rule):
    return LOG + f" SELECT arrival_seq FROM log WHERE {rule}"


for name, error, rule in (("reject_unknown_column", "unknown_column", "arrival_seq % 89 = 0"), ("reject_placeholder_mismatch", "placeholder_mismatch", "arrival_seq % 83 = 0 AND arrival_seq % 89 <> 0"), ("reject_row_arity", "row_arity", "arrival_seq % 79 = 0 AND arrival_seq % 89 <> 0 AND arrival_seq % 83 <> 0")):
    add(name, fault_sql(rule))(lambda s, d, error=error: faulty(s, d).where(F.col("error") == error).select("arrival_seq"))
add("dead_letter", LOG + " SELECT CASE WHEN arrival_seq % 89 = 0 THEN 'unknown_column' WHEN arrival_seq % 83 = 0 THEN 'placeholder_mismatch' WHEN arrival_seq % 79 = 0 THEN 'row_arity' ELSE 'good' END AS side, count(*) AS n FROM log GROUP BY 1")(
    lambda s, d: faulty(s, d).groupBy(F.coalesce("error", F.lit("good")).alias("side")).agg(F.count("*").alias("n"))
)
add("failure_counts", LOG + " SELECT tbl, CASE WHEN arrival_seq % 89 = 0 THEN 'unknown_column' WHEN arrival_seq % 83 = 0 THEN 'placeholder_mismatch' ELSE 'row_arity' END AS error, count(*) AS n FROM log WHERE arrival_seq % 89 = 0 OR arrival_seq % 83 = 0 OR arrival_seq % 79 = 0 GROUP BY 1, 2")(lambda s, d: faulty(s, d).where("error is not null").groupBy("tbl", "error").agg(F.count("*").alias("n")))


@add("missing_defaults_check", LOG + " SELECT arrival_seq % 4 <> 1 AS no_default, arrival_seq % 4 IN (2, 3) AS no_ordinary, count(*) AS n FROM log GROUP BY 1, 2")
def missing_defaults_check(s, d):
    a, b = B.coverage(SIMPLE)
    return B.bind(decoded(s, d), SIMPLE).groupBy(a.alias("no_default"), b.alias("no_ordinary")).agg(F.count("*").alias("n"))


# Types
WIDE = "CAST(arrival_seq * 37 - 40000 AS BIGINT)"
MS = "(epoch_us(ts) // 1000)"


def ms():
    return F.unix_millis("ts")


add("cast_number", LOG + f", w AS (SELECT arrival_seq, {WIDE} AS n FROM log) SELECT arrival_seq, CASE WHEN n BETWEEN -128 AND 127 THEN n END AS i8, CASE WHEN n BETWEEN 0 AND 65535 THEN n END AS u16, CASE WHEN ((n % 256) + 256) % 256 > 127 THEN ((n % 256) + 256) % 256 - 256 ELSE ((n % 256) + 256) % 256 END AS i8_wrap FROM w")(
    lambda s, d: log(s, d).withColumn("n", F.col("arrival_seq") * 37 - 40000).select("arrival_seq", T.cast_number(F.col("n"), "Int8").cast("long").alias("i8"), T.cast_number(F.col("n"), "UInt16").cast("long").alias("u16"), T.cast_number(F.col("n"), "Int8", "wrap").cast("long").alias("i8_wrap"))
)
add("cast_bool_to_number", LOG + " SELECT arrival_seq, CAST(value > 50 AS INTEGER) AS flag FROM log")(lambda s, d: log(s, d).select("arrival_seq", X.decode(F.parse_json((F.col("value") > 50).cast("string")), X.type_of("Int32")).alias("flag")))
add("cast_string", LOG + " SELECT CASE WHEN arrival_seq % 5 <> 0 THEN tbl END AS s, count(*) AS n FROM log GROUP BY 1")(
    lambda s, d: log(s, d).select(F.parse_json(F.when(F.col("arrival_seq") % 5 != 0, F.concat(F.lit('"'), F.col("tbl"), F.lit('"'))).otherwise(F.col("arrival_seq").cast("string"))).alias("cell")).groupBy(X.decode(F.col("cell"), X.type_of("String")).alias("s")).agg(F.count("*").alias("n"))
)
add("cast_fixed_string", LOG + " SELECT arrival_seq, CASE WHEN octet_length(encode(tbl)) <= 6 THEN rpad(upper(hex(encode(tbl))), 12, '0') END AS fixed FROM log")(lambda s, d: log(s, d).select("arrival_seq", F.hex(T.cast_fixed_string(F.col("tbl"), 6)).alias("fixed")))
add("ms_to_date", LOG + f" SELECT arrival_seq, CAST({MS} // 86400000 AS INTEGER) AS day FROM log")(lambda s, d: log(s, d).select("arrival_seq", F.unix_date(T.ms_to_date(ms())).alias("day")))
add("ms_to_datetime", LOG + f" SELECT arrival_seq, {MS} // 1000 AS sec FROM log")(lambda s, d: log(s, d).select("arrival_seq", F.unix_seconds(T.ms_to_datetime(ms())).alias("sec")))
add("ms_to_datetime64", LOG + f" SELECT arrival_seq, {MS} // 100 * 100 AS scale1, {MS} AS scale3, {MS} AS scale6 FROM log")(lambda s, d: log(s, d).select("arrival_seq", *[F.unix_millis(T.ms_to_datetime64(ms(), k)).alias(f"scale{k}") for k in (1, 3, 6)]))
add("cast_nullable", LOG + " SELECT arrival_seq, CASE WHEN arrival_seq % 7 <> 0 THEN arrival_seq % 1000 END AS n FROM log")(lambda s, d: log(s, d).select("arrival_seq", T.cast_number(F.when(F.col("arrival_seq") % 7 != 0, F.col("arrival_seq") % 1000), "Int32").cast("long").alias("n")))
add("null_into_required", LOG + " SELECT arrival_seq FROM log WHERE arrival_seq % 7 = 0 OR arrival_seq % 11 = 0")(lambda s, d: log(s, d).withColumn("x", F.when(F.col("arrival_seq") % 7 != 0, 1)).withColumn("y", F.when(F.col("arrival_seq") % 11 != 0, "a")).where(T.required_null(["x", "y"])).select("arrival_seq"))
add("cast_array", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size, list_sum(list_transform(embedding, lambda x: CAST(floor(x * 100) AS BIGINT))) AS total FROM embeddings")(
    lambda s, d: s.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.size("embedding").alias("size"), F.aggregate(T.cast_array(F.col("embedding"), lambda x: T.cast_number(F.floor(x.cast("float") * F.lit(100).cast("float")), "Int64")), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
)
add("decoded_bytes", LOG + " SELECT tbl, CAST(sum(16 + octet_length(encode(payload)) + octet_length(encode(tbl))) AS BIGINT) AS bytes FROM log GROUP BY 1")(lambda s, d: log(s, d).groupBy("tbl").agg(F.sum(T.row_bytes({"arrival_seq": 8, "value": 8}, ["payload", "tbl"])).alias("bytes")))

# Evolution
V1 = SIMPLE[:2]
V2 = [*V1, B.Col("extra", "bigint", "default", "7")]
add("schema_hash", "SELECT md5('id bigint,kind string') AS v1, md5('id bigint,kind string,extra bigint') AS v2, count(*) AS n FROM events")(lambda s, d: log(s, d).agg(F.count("*").alias("n")).select(D.schema_hash(V1).alias("v1"), D.schema_hash(V2).alias("v2"), "n"))


def versions(df):
    return df.select("tbl").distinct().select("tbl", F.explode(F.array(F.lit(1), F.lit(2)).cast("array<bigint>")).alias("version")).withColumn("schema_hash", F.col("version"))


def hashed(s, d):
    return log(s, d).withColumn("schema_hash", F.col("arrival_seq") % 3 + 1)


add("schema_check", LOG + " SELECT CASE arrival_seq % 3 WHEN 0 THEN 'stale' WHEN 1 THEN 'current' ELSE 'unknown' END AS state, count(*) AS n FROM log GROUP BY 1")(lambda s, d: D.classify_schema(hashed(s, d), versions(log(s, d))).groupBy("state").agg(F.count("*").alias("n")))
add("schema_version_usage", LOG + " SELECT tbl, arrival_seq % 3 + 1 AS schema_hash, count(*) AS n FROM log GROUP BY 1, 2")(lambda s, d: hashed(s, d).groupBy("tbl", "schema_hash").agg(F.count("*").alias("n")))
add("migrate_block", LOG + " SELECT arrival_seq AS id, tbl AS kind, CAST(7 AS BIGINT) AS extra FROM log")(lambda s, d: D.migrate(log(s, d).select(F.col("arrival_seq").alias("id"), F.col("tbl").alias("kind")), V2))
add("mixed_version_block", LOG + " SELECT arrival_seq AS id, tbl AS kind, CASE WHEN arrival_seq % 2 = 0 THEN 7 ELSE pos END AS extra FROM log")(
    lambda s, d: D.union_versions([log(s, d).where("arrival_seq % 2 = 0").select(F.col("arrival_seq").alias("id"), F.col("tbl").alias("kind")), log(s, d).where("arrival_seq % 2 <> 0").select(F.col("arrival_seq").alias("id"), F.col("tbl").alias("kind"), F.col("pos").alias("extra"))], V2)
)

# Blocks
add("block_by_rows", LOG + BLOCKS + " SELECT zone, topic, part, tbl, block_no, begin_pos, end_pos, cnt FROM rng")(lambda s, d: K.block_ranges(blocks(s, d)).select(*L.KEY, "block_no", "begin_pos", "end_pos", "cnt"))
add("block_by_messages", LOG + " SELECT zone, topic, part, tbl, pos, (row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY pos) - 1) // 64 AS block_no FROM log")(lambda s, d: K.cut_rows(log(s, d), 64).select(*L.KEY, "pos", "block_no"))
add("block_stats", LOG + BLOCKS + " SELECT zone, topic, part, tbl, block_no, cnt, bytes, end_pos - begin_pos + 1 AS span, first_us, last_us FROM rng")(lambda s, d: K.block_ranges(blocks(s, d)).select(*L.KEY, "block_no", "cnt", "bytes", (F.col("end_pos") - F.col("begin_pos") + 1).alias("span"), "first_us", "last_us"))
add("block_id", LOG + BLOCKS + " SELECT zone, topic, part, tbl, block_no, md5(concat_ws('|', zone, topic, part, tbl, 0, begin_pos, end_pos)) AS block_id FROM rng")(lambda s, d: K.block_ranges(blocks(s, d)).withColumn("epoch", F.lit(0)).select(*L.KEY, "block_no", K.block_id().alias("block_id")))
add("load_lag", LOG + BLOCKS + " SELECT zone, topic, part, tbl, block_no, last_us + block_no % 3 * 1000000 - first_us AS lag_us FROM rng WHERE block_no % 5 <> 4")(
    lambda s, d: M.load_lag(K.block_ranges(blocks(s, d)), F.when(F.col("block_no") % 5 != 4, F.col("last_us") + F.col("block_no") % 3 * 1_000_000)).select(*L.KEY, "block_no", "lag_us")
)


def greedy_sql(over):
    return LOG + f""", p AS (SELECT zone, topic, part, tbl, pos // {POLL} AS poll, count(*) AS n, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS b, min(epoch_us(ts)) AS f, max(epoch_us(ts)) AS l FROM log GROUP BY ALL),
 o AS (SELECT *, row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY poll) AS k FROM p),
 w AS (SELECT zone, topic, part, tbl, poll, k, CAST(0 AS BIGINT) AS block_no, n AS rn, b AS rb, f AS rf, l FROM o WHERE k = 1
  UNION ALL SELECT o.zone, o.topic, o.part, o.tbl, o.poll, o.k, CASE WHEN {over} THEN w.block_no + 1 ELSE w.block_no END, CASE WHEN {over} THEN o.n ELSE w.rn + o.n END, CASE WHEN {over} THEN o.b ELSE w.rb + o.b END, CASE WHEN {over} THEN o.f ELSE w.rf END, o.l
  FROM w JOIN o ON o.zone = w.zone AND o.topic = w.topic AND o.part = w.part AND o.tbl = w.tbl AND o.k = w.k + 1)
 SELECT zone, topic, part, tbl, poll, block_no FROM w"""


def greedy(s, d, **limits):
    return K.greedy_cut(K.poll_summary(log(s, d), POLL), **limits).select(*L.KEY, "poll", "block_no")


add("block_by_bytes", greedy_sql("w.rb > 2000"))(lambda s, d: greedy(s, d, size=2000))
add("block_by_time", greedy_sql("w.l - w.rf > 86400000000"))(lambda s, d: greedy(s, d, seconds=86400))
add("block_any_trigger", greedy_sql("(w.rn > 150 OR w.rb > 1500 OR w.l - w.rf > 172800000000)"))(lambda s, d: greedy(s, d, rows=150, size=1500, seconds=172800))

# Commit metadata
add("commit_metadata", LOG + WHOLE + " SELECT zone, topic, part, tbl, begin_pos, end_pos, cnt FROM meta")(whole_meta)
add("commit_offset", LOG + WHOLE + " SELECT zone, topic, part, min(begin_pos) AS commit_pos, max(end_pos) AS max_pos FROM meta GROUP BY ALL")(lambda s, d: C.commit_offset(whole_meta(s, d)))
add("metadata_max", LOG + WHOLE + " SELECT zone, topic, part, max(end_pos) AS max_pos FROM meta GROUP BY ALL")(lambda s, d: C.commit_offset(whole_meta(s, d)).select(*L.SOURCE, "max_pos"))
add("empty_marker", LOG + META + ", t AS (SELECT DISTINCT zone, topic, part, tbl FROM log), l AS (SELECT zone, topic, part, max(pos) AS last_pos FROM old GROUP BY ALL) SELECT zone, topic, part, tbl, CASE WHEN tbl = 'view' OR begin_pos IS NULL THEN last_pos + 1 ELSE begin_pos END AS begin_pos, CASE WHEN tbl = 'view' OR begin_pos IS NULL THEN last_pos ELSE end_pos END AS end_pos, CASE WHEN tbl = 'view' OR begin_pos IS NULL THEN 0 ELSE cnt END AS cnt FROM t JOIN l USING (zone, topic, part) LEFT JOIN meta USING (zone, topic, part, tbl)")(
    lambda s, d: C.with_empty_markers(meta(s, d).where("tbl <> 'view'"), log(s, d).select(*L.KEY).distinct(), until_half(log(s, d)).groupBy(*L.SOURCE).agg(F.max("pos").alias("last_pos")))
)
add("first_seen_marker", LOG + " SELECT zone, topic, part, tbl, min(pos) AS begin_pos, min(pos) - 1 AS end_pos, CAST(0 AS BIGINT) AS cnt FROM log GROUP BY ALL")(lambda s, d: C.first_seen_markers(log(s, d)))
add("serialize_metadata_v0", LOG + WHOLE + " SELECT zone, topic, part, string_agg(tbl || ',' || begin_pos || ',' || end_pos, ',' ORDER BY tbl) AS metadata FROM meta GROUP BY ALL")(lambda s, d: C.meta_to_string(whole_meta(s, d)))
add("serialize_metadata_v1", LOG + WHOLE + " SELECT zone, topic, part, '1,,r1,' || string_agg(tbl || ',' || begin_pos || ',' || end_pos || ',' || cnt, ',' ORDER BY tbl) || ',,0' AS metadata FROM meta GROUP BY ALL")(lambda s, d: C.meta_to_string(whole_meta(s, d), 1, "r1", 0))
add("parse_metadata", LOG + WHOLE + " SELECT zone, topic, part, CAST(0 AS BIGINT) AS reference, tbl, begin_pos, end_pos, cnt FROM meta")(lambda s, d: C.meta_from_string(C.meta_to_string(whole_meta(s, d), 1, "r1", 0)))
add("merge_metadata", LOG + META + BLOCKS + ", n AS (SELECT zone, topic, part, tbl, begin_pos, end_pos, cnt FROM (SELECT *, row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY block_no DESC) AS r FROM rng) WHERE r = 1 AND tbl <> 'view') SELECT zone, topic, part, tbl, coalesce(n.begin_pos, m.begin_pos) AS begin_pos, coalesce(n.end_pos, m.end_pos) AS end_pos, coalesce(n.cnt, m.cnt) AS cnt FROM meta m FULL JOIN n USING (zone, topic, part, tbl)")(lambda s, d: C.merge_meta(meta(s, d), C.commit_metadata(K.block_ranges(blocks(s, d))).where("tbl <> 'view'")))
add("message_count_from_reference", LOG + META + ", ref AS (SELECT zone, topic, part, min(begin_pos) AS reference FROM meta GROUP BY ALL) SELECT zone, topic, part, tbl, pos, CAST(coalesce(cnt, 0) + count(*) FILTER (end_pos IS NULL OR pos > end_pos) OVER (PARTITION BY zone, topic, part, tbl ORDER BY pos) AS BIGINT) AS n FROM log JOIN ref USING (zone, topic, part) LEFT JOIN meta USING (zone, topic, part, tbl) WHERE pos >= reference")(
    lambda s, d: (lambda m: C.counts_from_reference(log(s, d), m.join(m.groupBy(*L.SOURCE).agg(F.min("begin_pos").alias("reference")), L.SOURCE)).select(*L.KEY, "pos", "n"))(meta(s, d))
)
add("replay_plan", LOG + META + " SELECT zone, topic, part, min(begin_pos) AS commit_pos, max(end_pos) AS max_pos, CASE WHEN min(begin_pos) <= max(end_pos) THEN 'REPLAY' ELSE 'CONSUME' END AS state FROM meta GROUP BY ALL")(lambda s, d: C.replay_plan(meta(s, d)))
CLASSIFY = LOG + META + ", c AS (SELECT zone, topic, part, min(begin_pos) AS commit_pos FROM meta GROUP BY ALL) SELECT zone, topic, part, tbl, pos, {} AS action FROM log JOIN c USING (zone, topic, part) LEFT JOIN meta USING (zone, topic, part, tbl)"
add("replay_classify", CLASSIFY.format("CASE WHEN pos < commit_pos THEN 'abnormal_before_begin' WHEN begin_pos IS NULL THEN 'consume' WHEN pos < begin_pos THEN 'skip_before_begin' WHEN pos <= end_pos THEN 'replay_append' ELSE 'consume' END"))(lambda s, d: C.classify(log(s, d), meta(s, d)).select(*L.KEY, "pos", "action"))
add("force_consume", CLASSIFY.format("'consume'"))(lambda s, d: C.classify(log(s, d), meta(s, d), True).select(*L.KEY, "pos", "action"))
add("rebuild_block", LOG + META + " SELECT zone, topic, part, tbl, pos, arrival_seq FROM log JOIN meta USING (zone, topic, part, tbl) WHERE pos BETWEEN begin_pos AND end_pos")(lambda s, d: C.rebuild_blocks(log(s, d), meta(s, d)).select(*L.KEY, "pos", "arrival_seq"))
add("replay_gap", LOG + META + ", f AS (SELECT zone, topic, part, min(pos) AS first_pos FROM log JOIN cut USING (zone, topic, part) WHERE pos >= cut - 330 GROUP BY ALL) SELECT zone, topic, part, tbl, begin_pos, first_pos FROM meta LEFT JOIN f USING (zone, topic, part) WHERE first_pos IS NULL OR first_pos > begin_pos")(lambda s, d: C.replay_gap(retained(log(s, d)), meta(s, d)))


def damaged(s, d):
    """The log with gaps, repeats and a reset: from half of each partition on, offsets begin at 0 again."""
    df = log(s, d)
    half = df.groupBy(*L.SOURCE).agg(F.floor((F.max("pos") + 1) / 2).alias("cut"))
    df = df.join(half, L.SOURCE).withColumn("pos", F.when(F.col("pos") >= F.col("cut"), F.col("pos") - F.col("cut")).otherwise(F.col("pos"))).drop("cut").where("arrival_seq % 103 <> 0")
    again = df.where("arrival_seq % 101 = 0").withColumn("arrival_seq", F.col("arrival_seq") * 2 + 1)
    return df.withColumn("arrival_seq", F.col("arrival_seq") * 2).unionByName(again)


# A reset is an offset 0 after larger ones of its epoch; the runs between zeros tell which zeros are resets.
DAMAGED = """, half AS (SELECT zone, topic, part, (max(pos) + 1) // 2 AS cut FROM log GROUP BY ALL), cutlog AS (SELECT zone, topic, part, CASE WHEN pos >= cut THEN pos - cut ELSE pos END AS pos, tbl, arrival_seq FROM log JOIN half USING (zone, topic, part) WHERE arrival_seq % 103 <> 0),
 dmg AS (SELECT zone, topic, part, pos, tbl, arrival_seq * 2 AS arrival_seq FROM cutlog UNION ALL SELECT zone, topic, part, pos, tbl, arrival_seq * 2 + 1 FROM cutlog WHERE arrival_seq % 101 = 0),
 seqs AS (SELECT *, row_number() OVER (PARTITION BY zone, topic, part ORDER BY arrival_seq) AS k FROM dmg),
 walk AS (SELECT zone, topic, part, pos, arrival_seq, k, pos AS last, 0 AS epoch, 'ok' AS anomaly FROM seqs WHERE k = 1
  UNION ALL SELECT s.zone, s.topic, s.part, s.pos, s.arrival_seq, s.k, CASE WHEN s.pos = 0 AND w.last > 0 THEN 0 WHEN s.pos <= w.last THEN w.last ELSE s.pos END,
   w.epoch + CASE WHEN s.pos = 0 AND w.last > 0 THEN 1 ELSE 0 END, CASE WHEN s.pos = 0 AND w.last > 0 THEN 'reset' WHEN s.pos <= w.last THEN 'rewind' WHEN s.pos > w.last + 1 THEN 'gap' ELSE 'ok' END
  FROM walk w JOIN seqs s ON s.zone = w.zone AND s.topic = w.topic AND s.part = w.part AND s.k = w.k + 1)"""
add("offset_anomalies", LOG + DAMAGED + " SELECT zone, topic, part, pos, arrival_seq, anomaly FROM walk")(lambda s, d: C.offset_anomalies(damaged(s, d)).select(*L.SOURCE, "pos", "arrival_seq", "anomaly"))
add("drop_rewound", LOG + DAMAGED + " SELECT zone, topic, part, pos, min(arrival_seq) AS arrival_seq FROM dmg GROUP BY ALL")(lambda s, d: C.dedup_log(damaged(s, d)).select(*L.SOURCE, "pos", "arrival_seq"))
add("flush_on_reset", LOG + DAMAGED + " SELECT zone, topic, part, pos, arrival_seq, CAST(epoch AS BIGINT) AS epoch FROM walk")(lambda s, d: C.epoch_of(damaged(s, d)).select(*L.SOURCE, "pos", "arrival_seq", "epoch"))


TURN = 7


@add("commit_conflict", LOG + BLOCKS + f" SELECT zone, topic, part, seq FROM (SELECT zone, topic, part, row_number() OVER (PARTITION BY zone, topic, part ORDER BY end_pos, tbl) - 1 AS seq FROM rng) WHERE seq % {TURN} = 0 AND seq >= {2 * TURN}")
def commit_conflict(s, d):
    """The blocks of each partition as commits in the order of their ends, by two owners that take turns of seven. Whoever comes back finds what the other wrote."""
    ranges = K.block_ranges(blocks(s, d))
    seq = F.row_number().over(Window.partitionBy(*L.SOURCE).orderBy("end_pos", "tbl")) - 1
    history = ranges.select(*L.SOURCE, seq.cast("long").alias("seq"), F.concat_ws(",", "tbl", "begin_pos", "end_pos").alias("written"))
    return C.commit_conflicts(history.withColumn("owner", F.floor(F.col("seq") / TURN) % 2)).select(*L.SOURCE, "seq")


@add("overlap_check", LOG + BLOCKS + " SELECT zone, topic, part, tbl, block_no FROM rng WHERE block_no > 0 AND block_no % 3 = 0")
def overlap_check(s, d):
    """The real ranges, of which every third begins at the end of the one before it, and one stands twice."""
    ranges = K.block_ranges(blocks(s, d)).select(*L.KEY, "block_no", "begin_pos", "end_pos")
    before = F.lag("end_pos").over(Window.partitionBy(*L.KEY).orderBy("block_no"))
    shifted = ranges.withColumn("begin_pos", F.when(F.col("block_no") % 3 == 0, F.coalesce(before, "begin_pos")).otherwise(F.col("begin_pos")))
    return C.overlaps(shifted.unionByName(shifted.where("block_no = 1"))).select(*L.KEY, "block_no")


add("completeness_check", LOG + BLOCKS + ", p AS (SELECT max(end_pos) + 1 AS c, sum(cnt) AS n FROM rng GROUP BY zone, topic, part) SELECT CAST(sum(c) AS BIGINT) AS covered, CAST(sum(n) AS BIGINT) AS loaded FROM p")(lambda s, d: C.completeness(K.block_ranges(blocks(s, d))))
for name, first, way in (("first_batches", True, ""), ("last_batches", False, "DESC")):
    add(name, LOG + BLOCKS + f" SELECT zone, topic, part, tbl, begin_pos, end_pos, cnt FROM (SELECT *, row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY block_no {way}) AS r FROM rng) WHERE r = 1")(lambda s, d, first=first: C.edge_blocks(K.block_ranges(blocks(s, d)), first))
add("assignment_history", LOG + BLOCKS + " SELECT zone, topic, part, tbl, begin_pos, nth FROM (SELECT *, row_number() OVER (PARTITION BY zone, topic, part ORDER BY begin_pos DESC, tbl) AS nth FROM rng) WHERE nth <= 100")(lambda s, d: C.assignments(K.block_ranges(blocks(s, d))).select(*L.KEY, "begin_pos", F.col("nth").cast("long").alias("nth")))

# Sink: the log as three polls of each partition, through the loader into a folder; then read back. The second breaks off before its ledger and is tried again; each is delivered once more after it counts.
EXTRA = [B.Col("id", "bigint"), B.Col("kind", "string"), B.Col("score", "double", nullable=True), B.Col("status", "string", "default", "'normal'"), B.Col("level", "bigint", "default", "3")]
TABLES = {"click": SIMPLE, "view": SIMPLE, "purchase": SIMPLE, "error": EXTRA}  # `signup` is no table: dead letters
POLLS = 3


def log_schema(text: str):
    return StructType.fromDDL(text)


def polls(s, d):
    df = envelopes(s, d, 2).withColumn("tbl", F.when(F.col("arrival_seq") % 97 != 0, F.col("tbl")))
    return with_size(df).withColumn("poll", F.floor(F.col("pos") * POLLS / F.col("size"))).drop("size")


def arrived(df, root):
    """The polls of a log as files, as a broker keeps them: made once, and each try of a step reads its own poll."""
    df.write.mode("overwrite").partitionBy("poll").parquet(f"{root}-log")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}-log")


class Lost(RuntimeError):
    """The loader is lost before one of its writes."""


BROKEN = (None, "ledger", None)


def lose(before):
    def check(name):
        if name == before:
            raise Lost(name)

    return check


@cache
def _loaded_store(s, app, d):
    """Written once for a session and a folder of data; five queries read it."""
    root = f"{store.shared_dir(s)}/sluice-store-{app}-{md5(d.encode()).hexdigest()}"
    df = arrived(polls(s, d), root)
    for k in range(POLLS):
        for broken in (BROKEN[k], None, None):
            try:
                S.write_batch(df.where(F.col("poll") == k).drop("poll"), 2 * k, root, TABLES, S.Limits(rows=ROWS), before_step=broken and lose(broken))
            except Lost:
                pass
    S.flush(s, df.drop("poll").schema, root, TABLES)
    return root


def loaded_store(s, d):
    return _loaded_store(s, s.sparkContext.applicationId, d)


STORE = LOG + f""", z AS (SELECT zone, topic, part, max(pos) + 1 AS size FROM log GROUP BY ALL), m AS (SELECT log.*, pos * {POLLS} // size AS poll FROM log JOIN z USING (zone, topic, part) WHERE arrival_seq % 97 <> 0 AND tbl <> 'signup'),
 p AS (SELECT zone, topic, part, tbl, poll, count(*) AS n, min(pos) AS b, max(pos) AS e FROM m GROUP BY 1, 2, 3, 4, 5), o AS (SELECT *, row_number() OVER (PARTITION BY zone, topic, part, tbl ORDER BY poll) AS k FROM p),
 w AS (SELECT zone, topic, part, tbl, poll, k, CAST(0 AS BIGINT) AS block_no, n AS rn, n, b, e FROM o WHERE k = 1
  UNION ALL SELECT o.zone, o.topic, o.part, o.tbl, o.poll, o.k, CASE WHEN w.rn > {ROWS} THEN w.block_no + 1 ELSE w.block_no END, CASE WHEN w.rn > {ROWS} THEN o.n ELSE w.rn + o.n END, o.n, o.b, o.e
  FROM w JOIN o ON o.zone = w.zone AND o.topic = w.topic AND o.part = w.part AND o.tbl = w.tbl AND o.k = w.k + 1),
 bl AS (SELECT zone, topic, part, tbl, block_no, min(b) AS begin_pos, max(e) AS end_pos, CAST(sum(n) AS BIGINT) AS cnt FROM w GROUP BY 1, 2, 3, 4, 5)"""
add("exactly_once_sink", STORE + " SELECT md5(concat_ws('|', zone, topic, part, tbl, 0, begin_pos, end_pos)) AS block_id, zone, topic, part, tbl, block_no, begin_pos, end_pos, cnt FROM bl")(lambda s, d: S.ledger(s, loaded_store(s, d)).select("block_id", *L.KEY, "block_no", "begin_pos", "end_pos", "cnt"))
add("buffer_append", STORE + f" SELECT zone, topic, part, tbl, block_no, begin_pos, end_pos, rn AS cnt FROM w JOIN (SELECT * FROM bl) bl USING (zone, topic, part, tbl, block_no) WHERE k = (SELECT max(k) FROM w x WHERE x.zone = w.zone AND x.topic = w.topic AND x.part = w.part AND x.tbl = w.tbl) AND rn <= {ROWS}")(
    lambda s, d: store.get(s, loaded_store(s, d), "buffers", S.BUFFERS, 2 * POLLS - 2).where("not closed").select(*L.KEY, "block_no", "begin_pos", "end_pos", "cnt")
)


def every_table(s, d, *cols):
    return reduce(lambda a, b: a.unionByName(b), [S.loaded(s, loaded_store(s, d), t).select(F.lit(t).alias("tbl"), *cols) for t in TABLES])


add("write_block", STORE + " SELECT zone, topic, part, tbl, pos, CAST(r AS INTEGER) AS row_in_msg, block_no FROM m JOIN w USING (zone, topic, part, tbl, poll), (SELECT unnest(range(2)) AS r)")(
    lambda s, d: every_table(s, d, F.col("_zone").alias("zone"), F.col("_topic").alias("topic"), F.col("_part").alias("part"), F.col("_pos").alias("pos"), F.col("_row").alias("row_in_msg"), F.col("_block_no").alias("block_no"))
)


@add("fan_out_tables", STORE + " SELECT tbl AS dest, CASE tbl WHEN 'error' THEN 'id,kind,score,status,level' ELSE 'id,kind,score,status,doubled' END AS columns, 2 * count(*) AS n, CAST(2 * sum(arrival_seq) AS BIGINT) AS sum_id FROM m GROUP BY 1, 2 UNION ALL SELECT error, '', count(*), CAST(sum(pos) AS BIGINT) FROM (SELECT CASE WHEN arrival_seq % 97 = 0 THEN 'no_table_header' ELSE 'unknown_table' END AS error, pos FROM log WHERE arrival_seq % 97 = 0 OR tbl = 'signup') GROUP BY 1")
def fan_out_tables(s, d):
    root = loaded_store(s, d)
    sides = [(lambda rows: rows.groupBy(F.lit(t).alias("dest"), F.lit(",".join(rows.columns)).alias("columns")).agg(F.count("*").alias("n"), F.sum("id").alias("sum_id")))(S.loaded(s, root, t, origin=False)) for t in TABLES]
    sides.append(S.dead_letters(s, root).groupBy(F.col("error").alias("dest"), F.lit("").alias("columns")).agg(F.count("*").alias("n"), F.sum("pos").alias("sum_id")))
    return reduce(lambda a, b: a.unionByName(b), sides)


@add("verify_roundtrip", STORE + " SELECT tbl, 2 * count(*) AS sent, 2 * count(*) AS loaded, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra FROM m GROUP BY 1")
def verify_roundtrip(s, d):
    """Rows as sent, made without the loader, against those read back, both ways and with repeats."""
    shape = F.col("arrival_seq") % 4
    sent = log(s, d).where("arrival_seq % 97 <> 0").select(
        "tbl", F.col("arrival_seq").alias("id"), F.when(shape == 2, "").otherwise(F.col("tbl")).alias("kind"), F.when(shape != 3, F.col("value")).alias("score"), F.when(shape == 1, "sent").otherwise("normal").alias("status"), F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    ).drop("copy")
    got = every_table(s, d, "id", "kind", "score", "status")
    sides = [(sent.where(F.col("tbl").isin(*TABLES)), "sent"), (got, "loaded"), (sent.where(F.col("tbl").isin(*TABLES)).exceptAll(got), "missing"), (got.exceptAll(sent), "extra")]
    every = reduce(lambda a, b: a.unionByName(b), [df.groupBy("tbl").agg(*[F.count("*" if n == name else F.lit(None)).alias(n) for _, n in sides]) for df, name in sides])
    return every.groupBy("tbl").agg(*[F.sum(n).alias(n) for _, n in sides])


# Typed cells: the log as messages of a table with a column of every kind of type, through the loader. Numbers of `small` from 128 on are out of range, and such messages are dead letters.
TYPED = [B.Col(n, t) for n, t in {"id": "Int64", "small": "Int8", "big": "UInt64", "ratio": "Float64", "flag": "UInt8", "kind": "LowCardinality(String)", "fixed": "FixedString(8)", "day": "Date", "second": "DateTime('UTC')", "tenth": "DateTime64(1)", "maybe": "Nullable(Int32)", "list": "Array(UInt32)", "nested": "Array(Array(Nullable(String)))"}.items()] + [B.Col("note", "FixedString(3)", "default", "'ab'")]
TYPED_CELLS = "concat('[', arrival_seq, ',', arrival_seq % 192, ',', cast(9223372036854775807 as decimal(20,0)) + arrival_seq % 3, ',', arrival_seq % 8 / 4.0D, ',', arrival_seq % 2 = 0, ',\"', tbl, '\",\"', tbl, '\",', unix_millis(ts), ',', unix_millis(ts), ',', unix_millis(ts), ',', if(arrival_seq % 7 = 0, 'null', cast(arrival_seq % 1000 as string)), ',[', arrival_seq % 5, ',', arrival_seq, '],[[\"', tbl, '\",null],[]]]')"


def one_table(df, name, sql, version, cells):
    """Messages of one table, with a row each."""
    text = F.concat(F.lit(f'{{"shard":"s1","table":"{name}","schema_hash":'), version.cast("string"), F.lit(',"sql":"'), sql, F.lit('","rows":['), cells, F.lit("]}"))
    return df.withColumn("payload", text).withColumn("tbl", F.lit(name)).select("zone", "topic", "part", "pos", "tbl", "ts", "payload")


def own_root(s, d, name):
    return f"{store.shared_dir(s)}/sluice-{name}-{s.sparkContext.applicationId}-{md5(d.encode()).hexdigest()}"


@cache
def _typed_store(s, app, d):
    root, names = own_root(s, d, "typed"), [c.name for c in TYPED if c.kind == "ordinary"]
    messages = one_table(log(s, d), "typed", F.lit(f"insert into typed ({', '.join(names)}) values ({', '.join('?' * len(names))})"), F.lit(1), F.expr(TYPED_CELLS))
    S.write_batch(messages, 0, root, {"typed": TYPED}, S.Limits(rows=0))
    return root


@add("typed_cells", LOG + """ SELECT arrival_seq AS id, arrival_seq % 192 AS small, CAST(9223372036854775807 + CAST(arrival_seq % 3 AS HUGEINT) AS VARCHAR) AS big, (arrival_seq % 8) / 4.0 AS ratio, CAST(arrival_seq % 2 = 0 AS BIGINT) AS flag, tbl AS kind, rpad(hex(encode(tbl)), 16, '0') AS fixed,
 CAST(epoch_us(ts) // 86400000000 AS INTEGER) AS day, epoch_us(ts) // 1000000 AS second, epoch_us(ts) // 100000 * 100 AS tenth, CASE WHEN arrival_seq % 7 <> 0 THEN arrival_seq % 1000 END AS maybe, arrival_seq % 5 + arrival_seq AS list, '[["' || tbl || '",null],[]]' AS nested, '616200' AS note FROM log WHERE arrival_seq % 192 < 128""")
def typed_cells(s, d):
    total = F.aggregate("list", F.lit(0).cast("long"), lambda a, x: a + x)
    return S.loaded(s, _typed_store(s, s.sparkContext.applicationId, d), "typed", origin=False).select(
        "id", F.col("small").cast("long").alias("small"), F.col("big").cast("string").alias("big"), "ratio", F.col("flag").cast("long").alias("flag"), "kind", F.hex("fixed").alias("fixed"),
        F.unix_date("day").alias("day"), F.unix_seconds("second").alias("second"), F.unix_millis("tenth").alias("tenth"), F.col("maybe").cast("long").alias("maybe"), total.alias("list"), F.to_json("nested").alias("nested"), F.hex("note").alias("note"),
    )


add("rejected_cells", LOG + " SELECT zone, topic, part, pos, 'bad_cell' AS error FROM log WHERE arrival_seq % 192 >= 128")(lambda s, d: S.dead_letters(s, _typed_store(s, s.sparkContext.applicationId, d)).select(*L.SOURCE, "pos", "error"))

# A schema that changes in mid-stream: three polls of each partition, of which the second brings a column with a default; old writers go on, and an unknown hash means the latest.
FLOW = {1: [B.Col("id", "Int64"), B.Col("kind", "String")]}
FLOW[2] = [*FLOW[1], B.Col("level", "Int32", "default", "3"), B.Col("twice", "bigint", "materialized", "id * 2")]


@cache
def _changed_store(s, app, d):
    root, a = own_root(s, d, "changed"), F.col("arrival_seq")
    df = arrived(with_size(log(s, d)).withColumn("poll", F.floor(F.col("pos") * POLLS / F.col("size"))).drop("size"), root)
    version = F.when((F.col("poll") == 0) | (a % 2 != 0), 1).when(F.col("poll") == 1, 2).otherwise(9)
    cells = F.concat(F.lit("["), a.cast("string"), F.lit(',"'), F.col("tbl"), F.lit('"'), F.when(version == 1, "").otherwise(F.concat(F.lit(","), (a % 7).cast("string"))), F.lit("]"))
    marks = F.when(version == 1, "?, ?").otherwise("?, ?, ?")
    for k in range(POLLS):
        messages = one_table(df.where(F.col("poll") == k), "flow", F.concat(F.lit("insert into flow values ("), marks, F.lit(")")), version, cells)
        S.write_batch(messages, 2 * k, root, {"flow": FLOW if k else {1: FLOW[1]}}, S.Limits(rows=None, size=None))
    S.flush(s, log_schema("zone string, topic string, part long, pos long, tbl string, ts timestamp, payload string"), root, {"flow": FLOW})
    return root


add("schema_change", LOG + f", z AS (SELECT zone, topic, part, max(pos) + 1 AS size FROM log GROUP BY ALL) SELECT zone, topic, part, pos, CAST(0 AS BIGINT) AS block_no, arrival_seq AS id, tbl AS kind, CASE WHEN pos * {POLLS} // size = 0 OR arrival_seq % 2 <> 0 THEN 3 ELSE arrival_seq % 7 END AS level, arrival_seq * 2 AS twice FROM log JOIN z USING (zone, topic, part)")(
    lambda s, d: S.loaded(s, _changed_store(s, s.sparkContext.applicationId, d), "flow").select(F.col("_zone").alias("zone"), F.col("_topic").alias("topic"), F.col("_part").alias("part"), F.col("_pos").alias("pos"), F.col("_block_no").alias("block_no"), "id", "kind", F.col("level").cast("long").alias("level"), "twice")
)


# Tables
def base(name):
    return lambda s, d: s.read.parquet(f"{d}/{name}.parquet")


add("count_rows", "SELECT count(*) AS n FROM lineitem")(lambda s, d: base("lineitem")(s, d).agg(F.count("*").alias("n")))
add("count_where", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 25")(lambda s, d: base("lineitem")(s, d).where("l_quantity > 25").agg(F.count("*").alias("n")))
add("select_all", "SELECT * FROM nation")(base("nation"))
add("select_ordered", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey")(lambda s, d: base("orders")(s, d).select("o_orderkey", "o_custkey").orderBy("o_orderkey"))

# Monitoring
add("throughput", LOG + " SELECT zone, topic, tbl, CAST(epoch_us(ts) // 86400000000 * 86400 AS BIGINT) AS window_s, count(*) AS messages, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS bytes FROM log GROUP BY 1, 2, 3, 4")(lambda s, d: M.throughput(log(s, d)))


def histogram_sql(bounds, col):
    values = ", ".join(f"({k}, CAST({b} AS DOUBLE))" for k, b in enumerate(bounds))
    return f"""WITH e(bucket, upper) AS (VALUES {values}, ({len(bounds)}, NULL)), c AS (SELECT (SELECT count(*) FROM e WHERE upper < v) AS bucket, count(*) AS n FROM (SELECT CAST({col} AS DOUBLE) AS v FROM events) GROUP BY 1)
 SELECT CAST(e.bucket AS INTEGER) AS bucket, upper, coalesce(n, 0) AS n, CAST(sum(coalesce(n, 0)) OVER (ORDER BY e.bucket) AS BIGINT) AS cumulative FROM e LEFT JOIN c ON c.bucket = e.bucket"""


for name, bounds, col in (("histogram_default", M.default_bounds(), "value * 1000"), ("histogram_extended", M.extended_bounds(), "value * 100000"), ("histogram_pow2", M.pow2_bounds(), "event_id")):
    add(name, histogram_sql(bounds, col))(lambda s, d, bounds=bounds, col=col: M.histogram(base("events")(s, d).select(F.expr(col).alias("v")), "v", bounds))
add("consumer_lag", LOG + META + ", c AS (SELECT zone, topic, part, min(begin_pos) AS p FROM meta GROUP BY ALL), e AS (SELECT zone, topic, part, max(pos) + 1 AS x FROM log GROUP BY ALL) SELECT zone, topic, CAST(coalesce(sum(CASE WHEN x - p >= 0 THEN x - p END), -1) AS BIGINT) AS lag FROM e LEFT JOIN c USING (zone, topic, part) GROUP BY ALL")(
    lambda s, d: M.consumer_lag(log(s, d).groupBy(*L.SOURCE).agg((F.max("pos") + 1).alias("end_pos")), C.commit_offset(meta(s, d)))
)
add("load_retries", STORE + " SELECT tbl, count(*) AS messages, count(*) FILTER (poll = 1) AS repeated FROM m GROUP BY 1")(lambda s, d: measures.repeated(s, loaded_store(s, d)))
add("step_failures", STORE + f" SELECT CASE WHEN arrival_seq % 97 <> 0 THEN tbl END AS tbl, CASE WHEN arrival_seq % 97 = 0 THEN 'no_table_header' ELSE 'unknown_table' END AS error, count(*) AS n FROM log WHERE arrival_seq % 97 = 0 OR tbl = 'signup' GROUP BY ALL")(lambda s, d: measures.failures(s, loaded_store(s, d)))
add("step_throughput", STORE + f" SELECT CAST(pos * {POLLS} // size * 2 AS BIGINT) AS seq, count(*) FILTER (arrival_seq % 97 <> 0 AND tbl <> 'signup') AS messages, count(*) FILTER (arrival_seq % 97 = 0 OR tbl = 'signup') AS rejected, CAST(CASE WHEN pos * {POLLS} // size = 1 THEN 1 ELSE 0 END AS BIGINT) AS retries FROM log JOIN z USING (zone, topic, part) GROUP BY 1, 4")(
    lambda s, d: measures.throughput(s, loaded_store(s, d)).select("seq", "messages", "rejected", "retries")
)
add("replication_status", LOG + BLOCKS + " SELECT tbl, max(block_no) % 2 = 0 AS is_leader, FALSE AS is_readonly, count(*) AS queue_size, max(end_pos) - min(begin_pos) AS behind, (max(last_us) - min(first_us)) // 1000000 AS queue_age_s FROM rng GROUP BY 1")(
    lambda s, d: M.replication_status(K.block_ranges(blocks(s, d)).groupBy("tbl").agg((F.max("block_no") % 2 == 0).alias("is_leader"), F.lit(False).alias("is_readonly"), F.count("*").alias("queue_size"), F.max("end_pos").alias("log_max_index"), F.min("begin_pos").alias("log_pointer"), F.lit(0).alias("x"), (F.max("last_us") - F.min("first_us")).alias("age")).withColumn("now_s", F.floor(F.col("age") / 1000000)).withColumn("last_queue_update_s", F.lit(0).cast("long")))
)
add("table_totals", "SELECT 'documents' AS tbl, count(*) AS total_rows, CAST(coalesce(sum(octet_length(encode(text))), 0) AS BIGINT) AS total_bytes FROM documents UNION ALL SELECT 'pages', count(*), CAST(coalesce(sum(octet_length(encode(html))), 0) AS BIGINT) FROM pages")(lambda s, d: M.table_totals({"documents": (base("documents")(s, d), "text"), "pages": (base("pages")(s, d), "html")}))
add("commit_progress", LOG + META + ", c AS (SELECT zone, topic, part, min(begin_pos) AS commit_pos FROM meta GROUP BY ALL) SELECT zone, topic, part, max(pos) AS current_pos, max(commit_pos) AS commit_pos FROM log JOIN c USING (zone, topic, part) GROUP BY ALL")(lambda s, d: log(s, d).groupBy(*L.SOURCE).agg(F.max("pos").alias("current_pos")).join(C.commit_offset(meta(s, d)).select(*L.SOURCE, "commit_pos"), L.SOURCE))
