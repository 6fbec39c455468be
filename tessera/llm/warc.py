"""WARC archives: a writer with one gzip member per record and revisit records
for repeated payloads, and a sequential reader (incremental inflate, framing by
content length, digest verification).

Files are reached through pyarrow's file systems, so the folder may be any URI
that pyarrow and all executors can open (local shared mounts, hdfs, s3, gs)."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tessera.llm.common import persist

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"       # a parameter, so that archives are reproducible
LEAST_REVISIT = 100                 # payload bytes from which a repeat is a revisit
FILE_BYTES = 1 << 30                # compressed bytes from which a task starts its next file
CHUNK = 1 << 18
OUT_BYTES = 8 << 20
MAX_HEAD = 1 << 20                  # bytes of a record's header that any reader takes; a longer one must be announced


class WarcError(ValueError):
    """A record that breaks the format or does not match its digest."""


# ------------------------------------------------------------------- record
def record_id(key: str | None) -> str:
    return f"<urn:record:{'null' if key is None else 'k' + quote(key, safe='')}>"


def key_of(identifier: str) -> str | None:
    name = identifier.removeprefix("<urn:record:").removesuffix(">")
    return None if name == "null" else unquote(name[1:])


def _digest(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def head_bytes(record: bytes) -> int:
    return record.index(b"\r\n\r\n")


def record_bytes(key: str | None, uri: str | None, payload: bytes | None, digest: str, size: int,
                 refers_to: str | None, date: str = DATE) -> bytes:
    """One uncompressed record. With ``refers_to`` it is a revisit, whose block
    holds the response's head and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(key)}",
            f"WARC-Date: {date}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {quote(uri, safe=':/?#[]@!$&%()*+,;=~-._' + chr(39))}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: {_digest(block)}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ------------------------------------------------------------------- reader
@dataclass
class Record:
    offset: int               # of its gzip member in the file
    headers: dict[str, str]   # names in lower case
    payload: bytes | None     # None for a revisit

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]


class _Member:
    """The bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, stream: BinaryIO, rest: bytes):
        self.stream, self.rest, self.out, self.read = stream, rest, bytearray(), 0
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.rest or self.stream.read(CHUNK)
        self.rest = b""
        if not data:
            raise WarcError("the file ends inside a record")
        try:
            self.out += self.inflate.decompress(data, CHUNK * 4)
        except zlib.error as e:
            raise WarcError(f"broken gzip member: {e}") from e
        self.read += len(data) - len(self.inflate.unconsumed_tail) - len(self.inflate.unused_data)
        return True

    def until(self, mark: bytes, most: int) -> bytes:
        at = 0
        while (found := self.out.find(mark, at)) < 0:
            at = max(0, len(self.out) - len(mark))
            if len(self.out) >= most + len(mark) or not self.more():
                raise WarcError("a record header does not end")
        if found > most:
            raise WarcError("a record header does not end")
        taken = bytes(self.out[:found])
        del self.out[:found + len(mark)]
        return taken

    def exactly(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self.more():
                raise WarcError("a record is shorter than its content length")
        taken = bytes(self.out[:n])
        del self.out[:n]
        return taken

    def end(self) -> bytes:
        while self.more():
            pass
        if self.out:
            raise WarcError("a gzip member holds more than one record")
        return self.inflate.unused_data


def _verify(headers: dict[str, str], name: str, data: bytes) -> None:
    said = headers.get(name)
    if said and said.startswith("sha256:") and said != _digest(data):
        raise WarcError(f"{name} of {headers.get('warc-record-id')} does not match its bytes")


def read_records(stream: BinaryIO, most_head: int = MAX_HEAD) -> Iterator[Record]:
    """All records of a stream in order, one in memory at a time; a header of more
    than ``most_head`` bytes is refused."""
    rest, offset = b"", 0
    while rest or (rest := stream.read(CHUNK)):
        member = _Member(stream, rest)
        lines = member.until(b"\r\n\r\n", most_head).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError(f"no record begins at byte {offset}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        try:
            block = member.exactly(int(headers["content-length"]))
        except (KeyError, ValueError) as e:
            raise WarcError(f"the record at byte {offset} has no content length") from e
        if member.exactly(4) != b"\r\n\r\n":
            raise WarcError(f"the record at byte {offset} does not end where its content length says")
        rest = member.end()
        _verify(headers, "warc-block-digest", block)
        payload = None
        if headers.get("warc-type") != "revisit":
            payload = block
            if headers.get("content-type", "").startswith("application/http"):
                payload = block.partition(b"\r\n\r\n")[2]
            _verify(headers, "warc-payload-digest", payload)
        yield Record(offset, headers, payload)
        offset += member.read


# -------------------------------------------------------------------- Spark
def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str, key_col: str = "page_id", uri_col: str = "url", text_col: str = "html",
                   least_revisit: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of ``pages`` under ``folder``; returns ``(path, records, bytes, head)``
    of the files that count, as a written table; ``head`` is their longest header.

    The payload is the text in UTF-8 (null: empty). Of records with equal
    payloads of ``least_revisit`` bytes or more, the one of the smallest key is
    a response and the others are revisits of it. Ties: rows with that smallest
    key, if repeated, are responses all; a null key ranks above all others, and
    payloads that only null keys have are responses. A null URI is left out.

    A task that runs again writes files of other names, and only the files of
    the attempt that counts are in the returned table. Digests meet by an
    aggregation with one row per repeated payload; the join that carries
    payloads has that small side broadcast or, if skewed, split by AQE.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key_col).alias("key"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    repeated = persist(rows.where(F.col("size") >= least_revisit).groupBy("digest", "size")
                       .agg(F.min("key").alias("first"), F.count("*").alias("n"))
                       .where("n > 1 AND first IS NOT NULL").select("digest", "size", "first"), "warc-repeated")
    marked = rows.join(repeated, ["digest", "size"], "left")
    is_revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    marked = marked.select(F.col("key").cast("string").alias("key"), "uri", F.when(~is_revisit, F.col("payload")).alias("payload"),
                           "digest", "size", F.when(is_revisit, F.col("first").cast("string")).alias("refers_to"))
    schema = StructType([StructField("path", StringType()), StructField("records", LongType()), StructField("bytes", LongType()),
                         StructField("head", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        part, stream, path, records, held, head = TaskContext.get().partitionId(), None, "", 0, 0, 0
        done: list[tuple[str, int, int, int]] = []
        try:
            for batch in batches:
                for key, uri, body, digest, size, refers in zip(*batch.columns, strict=True):
                    if stream is None:
                        path, records, held = f"{root}/part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                        head = 0
                        stream = store.open_output_stream(path, compression=None)
                    record = record_bytes(key.as_py(), uri.as_py(), body.as_py(), digest.as_py(), size.as_py(),
                                          record_id(refers.as_py()) if refers.is_valid else None)
                    member = gzip_member(record)
                    stream.write(member)
                    records, held, head = records + 1, held + len(member), max(head, head_bytes(record))
                    if held >= file_bytes:
                        stream.close()
                        stream = None
                        done.append((path, records, held, head))
        finally:
            if stream is not None:
                stream.close()
                done.append((path, records, held, head))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in
                                          enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                                         names=["path", "records", "bytes", "head"])

    return persist(marked.mapInArrow(run, schema), "warc-files")


def read_archives(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """``(path, offset, record_id, key, record_type, uri, refers_to, digest,
    payload)`` of every record of ``files(path, head, ..)`` under ``folder``;
    headers may have ``head`` bytes, or ``MAX_HEAD`` if that is more or not known.

    One task reads a file from front to back; a record that breaks the format
    or its digest fails the job. ``key`` and ``refers_to`` are texts.
    """
    spark = files.sparkSession
    names = ["path", "offset", "record_id", "key", "record_type", "uri", "refers_to", "digest", "payload"]
    schema = StructType([StructField(n, LongType() if n == "offset" else BinaryType() if n == "payload" else StringType())
                         for n in names])
    arrow = [pa.int64() if n == "offset" else pa.binary() if n == "payload" else pa.string() for n in names]

    def row(path: str, r: Record) -> tuple:
        h = r.headers
        uri = h.get("warc-target-uri")
        return (path, r.offset, h.get("warc-record-id"), key_of(h.get("warc-record-id", "")), r.kind,
                None if uri is None else unquote(uri), key_of(h["warc-refers-to"]) if "warc-refers-to" in h else None,
                h.get("warc-payload-digest", "").removeprefix("sha256:") or None, r.payload if with_payload else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        for batch in batches:
            for path, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for r in read_records(stream, max(MAX_HEAD, head or 0)):
                        rows.append(row(path, r))
                        held += len(r.payload or b"") + 500
                        if held >= OUT_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow, strict=True)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow, strict=True)], names=names)

    n = max(files.count(), 1)
    head = F.col("head") if "head" in files.columns else F.lit(None)
    return files.select("path", head.cast("long").alias("head")).repartition(min(n, 100_000)).mapInArrow(run, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every record with ``payload_bytes`` and ``payload_digest`` of its full
    payload: responses by the payload read, revisits by the response they refer
    to, which must carry the digest that they claim."""
    seen = persist(records.select("key", "record_type", "refers_to", "digest",
                                  F.octet_length("payload").cast("long").alias("payload_bytes"),
                                  F.sha2("payload", 256).alias("payload_digest")), "warc-records")
    responses = seen.where("record_type = 'response'")
    target = (responses.groupBy(F.col("key").alias("refers_to"), F.col("payload_digest").alias("digest"))
              .agg(F.max("payload_bytes").alias("full_bytes")))
    revisits = (seen.where("record_type = 'revisit'").join(target, ["refers_to", "digest"], "left")
                .select("key", "record_type", "refers_to", F.col("full_bytes").alias("payload_bytes"),
                        F.when(F.col("full_bytes").isNotNull(), F.col("digest")).alias("payload_digest")))
    return responses.select("key", "record_type", "refers_to", "payload_bytes", "payload_digest").unionByName(revisits)
