"""Operator 2: WARC archives, written and read back by Spark tasks.

Writer: one gzip member per record; a task rolls to a new file at ROLL_BYTES.
File names are unique per attempt and only a finished task's files reach the
manifest table, so retried tasks leave no doubles behind.

Reader: an archive is read front to back by one task (a task may have several). Members are inflated
incrementally (``zlib.decompressobj`` fed with READ_BYTES), blocks are framed by
Content-Length, and block and payload digests are verified while the bytes
stream by; only a record's header, or its payload when asked for, is held.

Defined cases: a null payload is empty; a record without page id or url is
written without that header and read back as null; of equal payloads of at least
``min_bytes`` bytes every row with the largest page id is a response (repeated
rows stay repeated), the others revisit it; an empty table writes no archive; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketscope.llm.common import NULL_ID, written
from marketscope.session import shared_dir
from marketscope.sources import files

ROLL_BYTES = 64 << 20
READ_BYTES = 1 << 16
CRLF = b"\r\n"
#: fixed values of the WARC 1.1 format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
#: the synthetic pages carry no crawl date
WARC_DATE = "2000-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
RECORDS = ("path string, page_id long, url string, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, payload binary")


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _header_value(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def build_record(page_id: int | None, url: str | None, payload: bytes, digest_hex: str, refers_to: int | None) -> bytes:
    """One uncompressed record: warc header, http header, payload (none for a revisit)."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", WARC_DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _header_value(url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)),
                   ("X-Refers-To-Page-Id", str(refers_to))]
    fields += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()),
               ("WARC-Block-Digest", base32_sha1(block)), ("Content-Type", HTTP_TYPE),
               ("Content-Length", str(len(block)))]
    head = VERSION + CRLF + b"".join(f"{k}: {v}".encode() + CRLF for k, v in fields) + CRLF
    return head + block + CRLF + CRLF


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(records: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write (page_id, url, payload, digest, refers_to) rows; returns the manifest (path, records, bytes)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output(path)
                member = gzip_member(build_record(row["page_id"], row["url"], (row["payload"] or "").encode("utf-8", "surrogatepass"),
                                                  row["digest"], row["refers_to"]))
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= roll_bytes:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["path", "records", "bytes"])

    return written(records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(write, MANIFEST), "warc-manifest")


class BadRecord(ValueError):
    """A record that breaks its framing or fails a digest."""


def inflated(stream) -> Iterator[Iterator[bytes]]:
    """For each gzip member of ``stream`` an iterator over its inflated bytes, read on demand."""
    pending = stream.read(READ_BYTES)
    while pending:
        z = zlib.decompressobj(31)

        def blocks(z=z):
            nonlocal pending
            while not z.eof:
                if not pending:
                    raise BadRecord("the archive ends inside a gzip member")
                data = z.decompress(pending, READ_BYTES)
                pending = z.unused_data if z.eof else z.unconsumed_tail
                if not pending:
                    pending = stream.read(READ_BYTES)
                if data:
                    yield data

        member = blocks()
        yield member
        for _ in member:       # the rest of a member its reader left unread
            pass


class Framed:
    """Bytes of one member, handed out up to a separator or by count."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.buf = blocks, b""

    def until(self, mark: bytes, limit: int = 1 << 20) -> bytes:
        while (at := self.buf.find(mark)) < 0:
            more = next(self.blocks, None)
            if more is None or len(self.buf) > limit:
                raise BadRecord(f"no end of header within {len(self.buf)} bytes")
            self.buf += more
        head, self.buf = self.buf[:at], self.buf[at + len(mark):]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buf:
                self.buf = next(self.blocks, b"")
                if not self.buf:
                    raise BadRecord(f"{n} bytes short of Content-Length")
            part, self.buf = self.buf[:n], self.buf[n:]
            n -= len(part)
            yield part

    def rest(self) -> bytes:
        return self.buf + b"".join(self.blocks)


def read_record(blocks: Iterator[bytes], with_payload: bool) -> dict:
    """Parse and verify one record; raises BadRecord."""
    f = Framed(blocks)
    head = f.until(CRLF + CRLF).split(CRLF)
    if not head[0].startswith(b"WARC/1."):
        raise BadRecord(f"not a WARC version line: {head[0][:40]!r}")
    fields = {k.strip().lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in head[1:])}
    try:
        length = int(fields["content-length"])
        kind, want_block, want_payload = fields["warc-type"], fields["warc-block-digest"], fields["warc-payload-digest"]
    except (KeyError, ValueError) as e:
        raise BadRecord(f"missing or bad header field: {e}") from e
    block_sha, payload_sha = hashlib.sha1(), hashlib.sha1()
    http, in_payload, size, kept = b"", False, 0, []
    for part in f.take(length):
        block_sha.update(part)
        if not in_payload:
            http += part
            at = http.find(CRLF + CRLF)
            if at < 0:
                continue
            in_payload, part = True, http[at + 4:]
        payload_sha.update(part)
        size += len(part)
        if with_payload:
            kept.append(part)
    if f.rest() != CRLF + CRLF:
        raise BadRecord("the record does not end after Content-Length bytes")
    if base64.b32encode(block_sha.digest()).decode() != want_block.removeprefix("sha1:"):
        raise BadRecord("block digest differs")
    if kind == "response" and base64.b32encode(payload_sha.digest()).decode() != want_payload.removeprefix("sha1:"):
        raise BadRecord("payload digest differs")
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return {"page_id": None if page is None else int(page), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": None if refers is None else int(refers),
            "payload_bytes": size if kind == "response" else None,
            "payload_digest": base64.b32decode(want_payload.removeprefix("sha1:")).hex(),
            "payload": b"".join(kept) if with_payload and kind == "response" else None}


def read_archives(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives named in column ``path``; a bad record fails the read with its place."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with files.open_input(path) as stream:
                    for i, member in enumerate(inflated(stream)):
                        try:
                            rows.append({"path": path} | read_record(member, with_payload))
                        except (BadRecord, zlib.error) as e:
                            raise BadRecord(f"{path}, record {i}: {e}") from e
                        held += len(rows[-1]["payload"] or b"")
                        if len(rows) >= 1000 or held >= ROLL_BYTES // 4:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, paths.count())      # one task per archive
    return paths.select("path").repartition(n, "path").mapInArrow(read, RECORDS)


def archive(pages: DataFrame, min_bytes: int = 1000, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write (page_id, url, html) as archives, equal payloads of ``min_bytes`` or more as revisits; the manifest."""
    spark: SparkSession = pages.sparkSession
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    src = src.withColumn("digest", F.sha1(F.encode("payload", "UTF-8"))).withColumn("n", F.octet_length("payload"))
    pid = F.coalesce("page_id", F.lit(NULL_ID))
    slim = written(src.select(pid.alias("pid"), "digest", "n", F.xxhash64("payload").alias("h")).where(F.col("n") >= min_bytes),
                   "warc-digests")
    keep = slim.groupBy("digest", "n", "h").agg(F.max("pid").alias("first"), F.count("*").alias("size")).where("size > 1")
    revisits = (slim.join(keep, ["digest", "n", "h"]).where("pid <> first")
                .groupBy("pid", "digest").agg(F.max("first").alias("refers_to")))
    records = src.withColumn("pid", pid).join(revisits, ["pid", "digest"], "left")
    return write_archives(records, shared_dir(spark, "llm-warc"), roll_bytes)


def warc_round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record read back.

    A revisit's payload size comes from the response it names, found by page id and digest.
    """
    read = written(read_archives(archive(pages, min_bytes), with_payload=False).drop("payload"), "warc-records")
    sizes = (read.where("record_type = 'response'")
             .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("bytes")))
    return read.join(sizes, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url")
