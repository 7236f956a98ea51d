"""WARC archives: writing, normalising a whole-file gzip stream, reading back.

``write_archives`` packs web pages into archives, each one single gzip stream
(as some crawlers leave them, so no record can be read without inflating all
before it).  ``normalise`` inflates such a stream once, rewrites every record
as a gzip member of its own and gives a sidecar index of the members' offsets.
``read_back`` opens single members by that index.  ``write_files`` leaves
normalised archives as ``.warc.gz`` files with an ``.idx`` file beside each, and
``read_files`` takes such a folder up again.

Between these steps archives are binary rows of a table in shared storage, so any
task can write or read them and a lost executor costs only its own tasks.  A file
is named by its content's digest and put in place whole, so a task that runs
again writes the same files.

Edge cases: null html is an empty payload; a null url is an empty target; of
repeated rows of one page_id with the same payload all are responses when
they hold the largest id, and share a record id; a record longer than
ARCHIVE_BYTES has an archive to itself; an archive without records has an empty index; null page_ids rank below all others; line breaks in
a url are percent-encoded; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionbars.llm.common import prepare, save

#: Payloads below this many bytes are never written as revisits.
LEAST_REVISIT = 1000
#: Uncompressed bytes of an archive; a longer record has an archive to itself.
ARCHIVE_BYTES = 8 << 20
LEVEL = 1
#: WARC-Date of records whose table has no time of capture.
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def plan(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, digest and the response that each record revisits."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    big = p.filter(F.length("payload") >= least)
    # one row per digest: partial aggregation takes in the copies of a hot page before the shuffle
    keep = big.groupBy(F.col("digest").alias("_d")).agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    j = p.join(keep, p["digest"] == keep["_d"], "left")
    return j.select("page_id", "url", "payload", "digest", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("_first")), F.col("_first")).alias("refers_to"))


def _record(page_id, url: str, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    b32 = base64.b32encode(bytes.fromhex(digest))
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    kind = b"response" if refers_to is None else b"revisit"
    http = _HTTP % len(payload)
    block = http + payload if refers_to is None else http
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:page:%s>" % (b"" if page_id is None else str(page_id).encode()), b"WARC-Date: " + date.encode(),
            b"WARC-Target-URI: " + target.encode(), b"WARC-Payload-Digest: sha1:" + b32, b"Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%d>" % refers_to]
    return b"\r\n".join([*head, b"Content-Length: %d" % len(block)]) + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, date: str = DATE) -> DataFrame:
    """(content binary): archives of one gzip stream each, a few MB of records;
    ``date`` is their time of capture, as WARC states it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(z, out):
            out.append(z.flush())
            return pa.record_batch([pa.array([b"".join(out)], pa.binary())], names=["content"])

        z, out, size = None, [], 0
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for row in zip(*cols):
                raw = _record(*row, date)
                if z is not None and size + len(raw) > ARCHIVE_BYTES:
                    yield done(z, out)
                    z = None
                if z is None:
                    z, out, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), [], 0
                out.append(z.compress(raw))
                size += len(raw)
        if z is not None:
            yield done(z, out)

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "content binary")


def split_records(raw: bytes) -> Iterator[tuple[int, int]]:
    """Bounds of the records of an inflated archive, by their stated lengths."""
    at = 0
    while at < len(raw):
        if not raw.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head = raw.index(b"\r\n\r\n", at)
        length = next(int(x[15:]) for x in raw[at:head].split(b"\r\n") if x.lower().startswith(b"content-length:"))
        end = head + 4 + length + 4
        if raw[end - 4 : end] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield at, end
        at = end


def normalise_stream(content: bytes) -> tuple[bytes, list[tuple[int, int]]]:
    """One inflation of the stream; every record as its own member; (offset, length) of each."""
    z = zlib.decompressobj(31)
    raw = z.decompress(content) + z.flush()
    if z.unused_data or not z.eof:
        raise ValueError("the archive is not one whole gzip stream")
    out, index, at = [], [], 0
    for lo, hi in split_records(raw):
        c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = c.compress(raw[lo:hi]) + c.flush()
        out.append(member)
        index.append((at, len(member)))
        at += len(member)
    return b"".join(out), index


def normalise(archives: DataFrame) -> DataFrame:
    """(archive, content, index array of offset and length) of archives (content)."""
    schema = "archive string, content binary, index array<struct<offset:long,length:long>>"
    kind = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                body, index = normalise_stream(content.as_py())
                yield pa.record_batch([pa.array([hashlib.sha1(body).hexdigest() + ".warc.gz"]), pa.array([body], pa.binary()),
                                       pa.array([[{"offset": o, "length": n} for o, n in index]], kind)], names=["archive", "content", "index"])

    return archives.mapInArrow(run, schema)


def read_member(body: bytes, offset: int, length: int) -> dict:
    """One record, from its member alone."""
    raw = zlib.decompress(body[offset : offset + length], 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda k: int(x) if (x := fields.get(k, b"<urn:page:>")[10:-1]) else None
    stated = next(int(x[15:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    digest = base64.b32decode(fields[b"WARC-Payload-Digest"][5:]).hex()
    kind = fields[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields[b'WARC-Record-ID']!r} is not what its header states")
    return {"page_id": number(b"WARC-Record-ID"), "date": fields[b"WARC-Date"].decode(), "url": fields[b"WARC-Target-URI"].decode(), "payload_bytes": stated, "payload_digest": digest,
            "record_type": kind, "refers_to": number(b"WARC-Refers-To"), "payload": payload if kind == "response" else None}


def read_back(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """A row per record of normalised archives, each read through the index."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, index in zip(batch.column("content"), batch.column("index")):
                body = body.as_py()
                rows = [read_member(body, x["offset"], x["length"]) for x in index.as_py()]
                yield pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

    return archives.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payloads else ""))


def write_files(archives: DataFrame, folder: str) -> DataFrame:
    """Writes every archive and its index (a line "offset length" a record) into
    ``folder``, a path or URI that the workers reach; a row (archive, records,
    bytes) per file.  The files are written when the result is run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)

        def put(name: str, content: bytes) -> None:
            part = posixpath.join(root, f".{name}-{uuid.uuid4().hex}")
            with store.open_output_stream(part, compression=None) as f:
                f.write(content)
            store.move(part, posixpath.join(root, name))

        for batch in batches:
            for name, body, index in zip(*(batch.column(c) for c in ("archive", "content", "index"))):
                name, body, index = name.as_py(), body.as_py(), index.as_py()
                put(name.replace(".warc.gz", ".idx"), "".join(f"{x['offset']} {x['length']}\n" for x in index).encode())
                put(name, body)   # last: an archive in the folder has its index
                yield pa.record_batch([pa.array([name]), pa.array([len(index)], pa.int64()), pa.array([len(body)], pa.int64())], names=["archive", "records", "bytes"])

    return archives.mapInArrow(run, "archive string, records long, bytes long")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, content, index) of the archives in a folder, for ``read_back``."""
    prepare(spark)

    def files(ending: str) -> DataFrame:
        df = spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}").load(folder)
        return df.select(F.regexp_extract("path", r"([^/.]+)[^/]*$", 1).alias("_name"), "content")

    lines = F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: x != "")
    pair = lambda x: F.struct(F.split(x, " ")[0].cast("long").alias("offset"), F.split(x, " ")[1].cast("long").alias("length"))
    index = files(".idx").select("_name", F.transform(lines, pair).alias("index"))
    return files(".warc.gz").join(index, "_name").select(F.concat("_name", F.lit(".warc.gz")).alias("archive"), "content", "index")


def archive_pages(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Normalised archives of web pages, written to the shared folder."""
    prepare(pages.sparkSession)
    return save(normalise(write_archives(plan(pages), date)), "warc")


ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS top FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= {LEAST_REVISIT} AND (page_id < top OR page_id IS NULL AND top IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST_REVISIT} AND (page_id < top OR page_id IS NULL AND top IS NOT NULL) THEN top END AS refers_to
FROM m
"""
