"""WARC archives: monolithic gzip normaliser with a sidecar index (operator 5).

Contract: every ``pages`` row becomes a WARC record whose payload is its html in UTF-8 (null: empty).  Of records with equal
payloads of at least ``MIN_REVISIT`` = 0 bytes, that with the largest page_id is a response and the others revisit it;
smaller payloads are all responses.  The archives are then read back.

Steps, each a set of tasks that write whole files under their final name by renaming, so a rerun task writes the same:

1. ``write_archives``: a task streams its rows into one archive, compressed as one gzip stream, as careless tools do;
2. ``normalise_archive``: the stream is inflated once, in pieces; each record goes out as a gzip member of its own, and a
   sidecar file gets a line for each: record id, offset, length, payload digest;
3. ``read_archives``: every record is read by offset and length, inflated alone, and its digest checked.

Files go through pyarrow's file systems to the cluster's shared folder (file, hdfs, s3, by its scheme).  A reader's
memory is one record and its file's index lines.  A payload that a third of all pages share is found by an aggregate;
in the join with its representative Spark splits the skewed side.

Null html: empty payload.  Null page_id: a record without the id header, a response only where no equal payload has an
id.  Rows of the same page_id and payload as the response are responses too.  An empty table gives an empty result and
no archive.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import buckets_of, checkpointed, shared_dir, table

MIN_REVISIT = 0
PIECE = 1 << 18


def record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, html, url and refers_to: the page that a revisit refers to, null for a response."""
    p = pages.select(pages["page_id"].cast("long").alias("page_id"), (pages["url"].cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"), F.coalesce(pages["html"], F.lit("")).alias("html"))
    p = p.withColumn("sha", F.sha2(F.col("html").cast("binary"), 256))
    best = p.select("sha", "page_id").groupBy("sha").agg(F.max("page_id").alias("best"), F.count("*").alias("n")).where("n > 1")
    j = p.join(best.select("sha", "best"), "sha", "left")  # a join's skewed side is split at run time
    revisit = (F.octet_length("html") >= min_revisit) & F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    return j.select("page_id", "url", "html", F.when(revisit, F.col("best")).alias("refers_to"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record.  A revisit has no body; it states its payload's length, and the page it refers to."""
    body = b"" if refers_to is not None else payload
    name = page_id if page_id is not None else uuid.uuid5(uuid.NAMESPACE_URL, digest(payload)).hex
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {''.join(c for c in (url or 'urn:none') if c > ' ')}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


class Replacing:
    """Files written beside their final names, which they get together at the end."""

    def __init__(self, *uris: str):
        self.fs = [_fs(u) for u in uris]

    def __enter__(self):
        for fs, path in self.fs:
            fs.create_dir(posixpath.dirname(path), recursive=True)
        self.tmp = [f"{path}.{uuid.uuid4().hex}" for _, path in self.fs]
        self.out = [fs.open_output_stream(t, compression=None) for (fs, _), t in zip(self.fs, self.tmp)]
        return self.out

    def __exit__(self, kind, *_):
        for o, (fs, path), t in zip(self.out, self.fs, self.tmp):
            o.close()
            fs.delete_file(t) if kind else fs.move(t, path)


def write_archives(typed: DataFrame, to: str) -> DataFrame:
    """One monolithic archive for each partition; returns the files' numbers (and record counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, n = TaskContext.get().partitionId(), 0
        first = next(batches, None)
        if first is None:
            return
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        with Replacing(f"{to}/mono/{number:06d}.warc.gz") as (out,):
            while first is not None:
                for i in range(first.num_rows):
                    page_id, url, html, ref = (first.column(c)[i].as_py() for c in range(4))
                    out.write(z.compress(record(page_id, url, html.encode(), ref)))
                    n += 1
                first = next(batches, None)
            out.write(z.flush())
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([n], pa.int64())], names=["file", "records"])

    return typed.select("page_id", "url", "html", "refers_to").mapInArrow(run, "file int, records long")


def inflated(source, piece: int = PIECE) -> Iterator[bytes]:
    """The stream's plain bytes in pieces; goes on where one gzip member ends and another starts."""
    z = zlib.decompressobj(31)
    while data := source.read(piece):
        while data:
            yield z.decompress(data)
            data = z.unused_data
            if z.eof and data:
                z = zlib.decompressobj(31)
            elif z.eof:
                z = zlib.decompressobj(31)
                break


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, body and all bytes of each record."""
    buf, need = bytearray(), 0
    for piece in pieces:
        buf += piece
        if len(buf) < need:  # a record's bytes are looked at when all are there
            continue
        at = need = 0
        while (end := buf.find(b"\r\n\r\n", at)) >= 0:
            head = dict(line.split(": ", 1) for line in bytes(buf[at:end]).decode().split("\r\n")[1:])
            size = int(head["Content-Length"])
            if len(buf) < end + 8 + size:
                need = end + 8 + size - at
                break
            yield head, bytes(buf[end + 4 : end + 4 + size]), bytes(buf[at : end + 8 + size])
            at = end + 8 + size
        del buf[:at]
    if buf:
        raise ValueError(f"{len(buf)} bytes after the last whole record")


def normalise_archive(source: str, to: str, sidecar: str) -> int:
    """Rewrites an archive with a member for each record, and writes its index; returns the number of records."""
    fs, path = _fs(source)
    n = offset = 0
    with fs.open_input_stream(path, compression=None) as f, Replacing(to, sidecar) as (out, index):
        for head, _, whole in records(inflated(f)):
            z = zlib.compressobj(1, zlib.DEFLATED, 31)
            member = z.compress(whole) + z.flush()
            out.write(member)
            index.write(f"{head['WARC-Record-ID']} {offset} {len(member)} {head['WARC-Payload-Digest']}\n".encode())
            offset += len(member)
            n += 1
    return n


READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.int32()), ("offset", pa.int64())])
READ_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file int, offset long"


def normalise_and_read(files: DataFrame, base: str) -> DataFrame:
    """Normalises each file of ``files``(file), then reads every record back by the sidecar's offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number in b.column("file").to_pylist():
                to, sidecar = f"{base}/warc/{number:06d}.warc.gz", f"{base}/warc/{number:06d}.idx"
                normalise_archive(f"{base}/mono/{number:06d}.warc.gz", to, sidecar)
                fs, path = _fs(to)
                rows: list[tuple] = []
                with fs.open_input_file(path) as f, _fs(sidecar)[0].open_input_stream(_fs(sidecar)[1], compression=None) as ix:
                    for line in ix.read().decode().splitlines():
                        _, offset, size, sha = line.split(" ")
                        f.seek(int(offset))
                        ((head, body, _),) = records(iter([zlib.decompress(f.read(int(size)), 31)]))
                        revisit = head["WARC-Type"] == "revisit"
                        if head["WARC-Payload-Digest"] != sha or not revisit and f"sha1:{digest(body)}" != sha:
                            raise ValueError(f"digest of {head['WARC-Record-ID']} differs")
                        ref = int(head["WARC-Refers-To"][len("<urn:page:") : -1]) if revisit else None
                        page = head.get("X-Page-ID")
                        rows.append((int(page) if page else None, int(head["X-Payload-Length"]) if revisit else len(body), sha.removeprefix("sha1:"), head["WARC-Type"], ref, number, int(offset)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), READ)], schema=READ)

    return files.select("file").repartition(buckets_of(files.sparkSession), "file").mapInArrow(run, READ_DDL)


def archive_pages(pages: DataFrame, to: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Writes, normalises and reads back archives of ``pages``(page_id, url, html) under the folder ``to``."""
    written = checkpointed(write_archives(record_types(pages, min_revisit), to))
    return normalise_and_read(written, to)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_pages(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS s FROM pages),
m AS (SELECT page_id, octet_length(b) AS n, s, max(page_id) OVER (PARTITION BY b) AS best FROM p),
g AS (SELECT *, list_transform(range(0, 8), lambda k: ('0x' || substr(s, 5 * k + 1, 5))::BIGINT) AS v FROM m)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to
FROM g
"""
