"""WARC: monolithic gzip normaliser.

A crawl is often one gzip stream for a whole file, in which no record can be found without inflating all before it. Pages
are written in that form first (one stream per file, at most RECORDS records and ROLL payload bytes, then the next file).
The normaliser inflates each stream once, piece by piece, writes every record again as a gzip member of its own, and
beside the file an index of the members' offsets. Equal payloads of at least MINIMUM bytes are settled between the two
steps, over all files: the smallest page_id keeps the payload, the others become revisit records. Last, the archives are
read back, member by member, by their index.

Files go to the shared folder through pyarrow's file systems (local, HDFS, S3). Spark's own file system names the folder in full first,
so a path without a scheme means the same to Spark and to the tasks. They are written under a task's own name and then moved to a name that
depends only on the partition and the file's place in it, so a task that runs again replaces what it wrote.

Edge cases: null html is an empty payload; null page_ids are kept and are never the response to which others refer unless no other id
has that payload; repeated page_ids each have a record, and one of a group's equal smallest ids is the response; an empty
table gives an empty result; other columns are not read. Files are inflated in pieces, but one record is held whole, as its digest and
length stand before its payload. Payloads under MINIMUM bytes have no group and take no part in the join, however often one stands there.
"""

from __future__ import annotations

import hashlib
import io
import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import run_dir, staged, table

RECORDS, ROLL, MINIMUM, PIECE, LEVEL = 400, 64 << 20, 100, 1 << 18, 4
#: Payloads with more than this share of all rows are joined by broadcast: there are at most 1 / HOT of them.
HOT = 1 / 1000
MOST_TASKS = 10_000
DATE = "2000-01-01T00:00:00Z"


def store(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem(), path[5:] if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and host that Spark would read it by."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def header(kind: str, length: int, fields: dict[str, str]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}", "Content-Type: application/octet-stream", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def clean(url: str) -> str:
    return "".join(c if c > " " else "%20" for c in url)


class Records:
    """Records of an inflated stream that comes in pieces: (fields, payload)."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, bytearray()

    def fill(self, n: int) -> bool:
        while len(self.held) < n:
            piece = next(self.pieces, None)
            if piece is None:
                return False
            self.held += piece
        return True

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while self.fill(1):
            at = 0
            while (end := self.held.find(b"\r\n\r\n", at)) < 0:
                at = max(0, len(self.held) - 3)
                if not self.fill(len(self.held) + 1):
                    raise ValueError("a record's head is cut off")
            fields = dict(x.split(": ", 1) for x in self.take(end + 4)[:-4].decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            if not self.fill(size + 4):
                raise ValueError("a record's payload is cut off")
            payload = self.take(size)
            if self.take(4) != b"\r\n\r\n":
                raise ValueError("a record doesn't end where its length says")
            yield fields, payload


def inflate(stream, piece: int = PIECE) -> Iterator[bytes]:
    """The inflated bytes of a gzip file of one or many members."""
    d = zlib.decompressobj(31)
    while data := stream.read(piece):
        while data:
            out = d.decompress(data, piece * 4)
            if out:
                yield out
            data = d.unconsumed_tail
            if d.eof:
                data, d = d.unused_data, zlib.decompressobj(31)


def member(data: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Monolith:
    """One file of records in a single gzip stream."""

    def __init__(self, folder: str, name: str, attempt: int) -> None:
        self.fs, root = store(folder)
        self.fs.create_dir(f"{root}/raw", recursive=True)
        self.name, self.at, self.done = f"{name}.warc.gz", f"{root}/raw/.{name}.{attempt}", f"{root}/raw/{name}.warc.gz"
        self.out, self.z = self.fs.open_output_stream(self.at, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.count = self.size = 0

    def add(self, fields: dict[str, str], payload: bytes) -> None:
        self.out.write(self.z.compress(header("response", len(payload), fields) + payload + b"\r\n\r\n"))
        self.count, self.size = self.count + 1, self.size + len(payload)

    def close(self) -> None:
        self.out.write(self.z.flush())
        self.out.close()
        self.fs.move(self.at, self.done)


def write_monoliths(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages; a row (file, seq, page_id, payload_bytes, payload_digest) for each record."""

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context, n, now, rows = TaskContext.get(), 0, None, []
        for b in batches:
            for page, url, html in zip(b.page_id, b.url, b.html, strict=True):
                if now is None:
                    now, n = Monolith(folder, f"part-{context.partitionId():06d}-{n:06d}", context.taskAttemptId()), n + 1
                payload = html.encode("utf-8", "surrogatepass")
                digest = hashlib.sha256(payload).hexdigest()
                now.add({"WARC-Record-ID": f"<urn:x:{now.name}:{now.count}>", "WARC-Target-URI": clean(url), "WARC-Payload-Digest": f"sha256:{digest}", "X-Page-Id": page}, payload)
                rows.append((now.name, now.count - 1, page, len(payload), digest))
                if now.count >= RECORDS or now.size >= ROLL:
                    now.close()
                    now = None
            if rows:
                yield pd.DataFrame(rows, columns=["file", "seq", "page", "payload_bytes", "payload_digest"])
                rows = []
        if now is not None:
            now.close()

    rows = pages.select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    out = rows.mapInPandas(one, "file string, seq long, page string, payload_bytes long, payload_digest string")
    return staged(out.withColumn("page_id", F.when(F.col("page") != "", F.col("page").cast("long"))).drop("page"), "warc-records")


def settle(records: DataFrame) -> DataFrame:
    """(file, seq, refers_file, refers_seq, refers_to, revisit) for each record. The first of a group is that of the smallest page_id, then file and seq."""
    total = records.count()
    short, long = records.where(F.col("payload_bytes") < MINIMUM), records.where(F.col("payload_bytes") >= MINIMUM)
    groups = (
        long.groupBy("payload_digest")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "seq")).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("payload_digest", "first", "n")
    )
    groups = staged(groups, "warc-groups")
    hot = groups.where(F.col("n") > max(1.0, total * HOT)).drop("n")
    rest = groups.where(F.col("n") <= max(1.0, total * HOT)).drop("n")
    # Records of short payloads stay where they are, those of hot groups are told by broadcast; only the others meet in a shuffle.
    marked = long.join(F.broadcast(hot), "payload_digest", "left")
    marked = marked.where(F.col("first").isNotNull()).select(*records.columns, "first").unionByName(marked.where(F.col("first").isNull()).drop("first").join(rest, "payload_digest", "left").select(*records.columns, "first"))
    marked = marked.unionByName(short.withColumn("first", F.lit(None).cast(groups.schema["first"].dataType)))
    revisit = F.col("first").isNotNull() & ((F.col("first.file") != F.col("file")) | (F.col("first.seq") != F.col("seq")))
    return marked.select("file", "seq", F.coalesce(revisit, F.lit(False)).alias("revisit"), F.col("first.page_id").alias("refers_to"), F.col("first.file").alias("refers_file"), F.col("first.seq").alias("refers_seq"))


def normalise(decisions: DataFrame, folder: str) -> DataFrame:
    """Rewrite every monolithic file, each record as its own member, and write its index; (file, records, bytes) for each."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, root = store(folder)
        name, attempt = pdf.file.iloc[0], TaskContext.get().taskAttemptId()
        told = {int(r.seq): r for r in pdf.itertuples()}
        fs.create_dir(f"{root}/normal", recursive=True)
        index, at = io.StringIO(), 0
        with fs.open_input_stream(f"{root}/raw/{name}", compression=None) as src, fs.open_output_stream(f"{root}/normal/.{name}.{attempt}", compression=None) as out:
            n = 0
            for n, (fields, payload) in enumerate(Records(inflate(src)), 1):  # noqa: B007
                t = told[n - 1]
                kind, length = "response", fields.pop("Content-Length")
                for k in ("WARC-Type", "WARC-Date", "Content-Type"):
                    fields.pop(k)
                fields["X-Payload-Length"] = length
                if t.revisit:
                    kind, payload = "revisit", b""
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    fields["WARC-Refers-To"] = f"<urn:x:{t.refers_file}:{int(t.refers_seq)}>"
                    fields["X-Refers-To-Page"] = "" if pd.isna(t.refers_to) else str(int(t.refers_to))
                data = member(header(kind, len(payload), fields) + payload + b"\r\n\r\n")
                out.write(data)
                index.write(json.dumps({"record": n - 1, "offset": at, "length": len(data), "page_id": fields["X-Page-Id"]}) + "\n")
                at += len(data)
        if n != len(told):
            raise ValueError(f"{name} has {n} records, not {len(told)}")
        with fs.open_output_stream(f"{root}/normal/.{name}.idx.{attempt}", compression=None) as f:
            f.write(index.getvalue().encode())
        fs.move(f"{root}/normal/.{name}.{attempt}", f"{root}/normal/{name}")
        fs.move(f"{root}/normal/.{name}.idx.{attempt}", f"{root}/normal/{name}.idx")
        return pd.DataFrame({"file": [name], "records": [n], "bytes": [at]})

    files = decisions.select("file").distinct().count()
    return staged(decisions.repartition(max(1, min(files, MOST_TASKS)), "file").groupBy("file").applyInPandas(one, "file string, records long, bytes long"), "warc-files")


def read_member(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    stream.seek(offset)
    return next(iter(Records(inflate(io.BytesIO(stream.read(length))))))


def read_back(files: DataFrame, folder: str) -> DataFrame:
    """A row for each record of the normalised files, found by the index; payloads are checked against their digests."""

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = store(folder)
        for b in batches:
            for name in b.file:
                rows = []
                with fs.open_input_stream(f"{root}/normal/{name}.idx", compression=None) as f:
                    index = [json.loads(x) for x in f.read().decode().splitlines()]
                with fs.open_input_file(f"{root}/normal/{name}") as f:
                    for x in index:
                        fields, payload = read_member(f, x["offset"], x["length"])
                        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: the payload of record {x['record']} has another digest")
                        rows.append((fields["X-Page-Id"], int(fields["X-Payload-Length"]), digest, kind, fields.get("X-Refers-To-Page", ""), name, x["offset"]))
                yield pd.DataFrame(rows, columns=["page", "payload_bytes", "payload_digest", "record_type", "refers", "file", "offset"])

    out = files.select("file").repartition(max(1, min(files.count(), MOST_TASKS)), "file").mapInPandas(one, "page string, payload_bytes long, payload_digest string, record_type string, refers string, file string, offset long")
    as_id = lambda c: F.when(F.col(c) != "", F.col(c).cast("long"))
    return out.select(as_id("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id("refers").alias("refers_to"), "file", "offset")


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write, normalise and read back; the archives stay in the folder (by default in the shared one)."""
    folder = qualified(spark, folder or run_dir(spark, "warc"))
    files = normalise(settle(write_monoliths(pages, folder)), folder)
    return read_back(files, folder)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
g AS (SELECT payload_digest AS digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN g ON digest = payload_digest AND payload_bytes >= 100
"""
