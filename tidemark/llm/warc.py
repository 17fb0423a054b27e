"""WARC archives: monolithic gzip files rewritten with one gzip member a record.

A WARC file compressed as one gzip stream can only be read from its start.  The
normaliser inflates each such file once, front to back in chunks, writes every
record as a gzip member of its own and beside the archive a sidecar index with
the offset and length of each member.  From then on any record is read by
itself, and the index splits the work over tasks whatever the files' sizes are.

Files are the unit of work of the normaliser, since a gzip stream has no other
entry point; its memory is a few chunks however long files and records are.  An
archive and its index are written under other names and then renamed, the index
last, so a task that is lost or run twice leaves no half file that is read.

Archive files are opened with ``pyarrow.fs`` inside the tasks: the folder must be
one that it can open (local paths, HDFS, S3, GCS).

Defined cases: null html is an empty payload, a null url is named by the record;
records with equal payloads under ``min_bytes`` are all responses; of equal ones
at or over it those with the largest page_id are responses (more than one if
that id repeats), the others, null ids included, revisit it, and if all ids are
null all are responses; an empty table gives empty archives; a stream that ends
inside a record, or a payload that does not match its digest, is an error.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import drop_path, make_folder, scratch_path

CHUNK = 1 << 20
HEADER_BYTES = 1 << 20
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 1000
INDEX = "archive string, offset long, length long, record_id string, record_type string, payload_bytes long, payload_digest string"
RECORDS = "archive string, offset long, length long, record_id string, target_uri string, record_type string, payload_bytes long, payload_digest string, refers_to string"


# ---------------------------------------------------------------- records of a table

def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, bytes, digest and ``head``, the page that a revisit refers to (else null)."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.cast("string").alias("html"),
                        F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("digest"))
    heads = (rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 and head is not null").select(F.col("digest").alias("d"), F.col("bytes").alias("b"), "head"))
    joined = rows.join(heads, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")), "left").drop("d", "b")
    return joined.withColumn("head", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("head")), F.col("head")))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def record_text(rows: DataFrame) -> DataFrame:
    """``value``: the WARC record of each row of ``with_revisits``, without its closing line ends."""
    def line(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    uri = F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    for bad in "\r\n\t ":
        uri = F.replace(uri, F.lit(bad), F.lit(f"%{ord(bad):02X}"))
    revisit = F.col("head").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", "text/html; charset=utf-8"), line("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    refers = F.concat(line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), line("WARC-Refers-To", _urn(F.col("head"))))
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Target-URI", uri), line("WARC-Date", DATE), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, refers).otherwise(""), line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block).alias("value"))


def write_monolithic(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """A folder of WARC files, each one gzip stream; a record's closing line ends are the writer's separator."""
    record_text(with_revisits(pages, min_bytes)).write.option("lineSep", END.decode()).option("compression", "gzip").text(folder)


# ---------------------------------------------------------------- one stream

class Inflated:
    """The bytes of a gzip stream of one member or many, inflated once, a chunk at a time."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.inflater, self.rest, self.buffer = read, None, b"", bytearray()

    def fill(self) -> bool:
        """At most a chunk more in the buffer; False at the end of the stream."""
        while True:
            data = self.rest or self.read(CHUNK)
            if self.inflater is None:
                if not data:
                    return False
                data, self.rest = data.lstrip(b"\0"), b""        # padding between or after members
                if not data:
                    continue
                self.inflater = zlib.decompressobj(31)
            out = self.inflater.decompress(data, CHUNK)
            if self.inflater.eof:
                self.rest, self.inflater = self.inflater.unused_data, None
            else:
                self.rest = self.inflater.unconsumed_tail
                if not data and not out:
                    raise ValueError("gzip stream ends inside a member")
            if out:
                self.buffer += out
                return True

    def more(self) -> bool:
        return bool(self.buffer) or self.fill()

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and with ``mark``."""
        while (at := self.buffer.find(mark)) < 0:
            if len(self.buffer) > HEADER_BYTES or not self.fill():
                raise ValueError("record header without an end")
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in chunks."""
        while n:
            if not self.buffer and not self.fill():
                raise ValueError("stream ends inside a record")
            piece = self.take(min(n, len(self.buffer)))
            n -= len(piece)
            yield piece


def fields(header: bytes) -> dict[str, str]:
    """Named fields of a WARC or HTTP header, names in lower case."""
    lines = header.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines if x)}


class Payload:
    """SHA-1 and length of a record's payload as its block goes by: what follows the HTTP header, if it has one."""

    def __init__(self, http: bool):
        self.sha, self.bytes, self.head, self.inside = hashlib.sha1(), 0, b"", not http

    def feed(self, piece: bytes) -> None:
        if not self.inside:
            self.head += piece
            at = self.head.find(END)
            if at < 0:
                if len(self.head) > HEADER_BYTES:
                    raise ValueError("HTTP header without an end")
                return
            piece, self.head, self.inside = self.head[at + len(END):], self.head[:at + len(END)], True
        self.sha.update(piece)
        self.bytes += len(piece)


def described(warc: dict[str, str], payload: Payload) -> tuple[int, str]:
    """(bytes, digest) of the full payload: a revisit has them in its headers, any other record must hold what its digest says."""
    digest = warc.get("warc-payload-digest", "").removeprefix("sha1:")
    if warc.get("warc-type") == "revisit":
        return int(fields(payload.head).get("content-length", 0)), digest
    found = payload.sha.hexdigest()
    if len(digest) == 40 and digest.lower() != found:
        raise ValueError(f"payload of {warc.get('warc-record-id')} does not match its digest")
    return payload.bytes, found


def is_http(warc: dict[str, str]) -> bool:
    return warc.get("content-type", "").replace(" ", "").startswith("application/http")


def rewrite(read: Callable[[int], bytes], write: Callable[[bytes], object]) -> Iterator[dict]:
    """Every record of a stream as its own gzip member; yields the members' index entries."""
    stream, offset = Inflated(read), 0
    while stream.more():
        header = stream.until(END)
        if not header.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        warc = fields(header)
        member, payload, size = zlib.compressobj(6, zlib.DEFLATED, 31), Payload(is_http(warc)), 0
        for piece in _record(stream, header, int(warc["content-length"]), payload):
            packed = member.compress(piece)
            write(packed)
            size += len(packed)
        packed = member.flush()
        write(packed)
        size += len(packed)
        n, digest = described(warc, payload)
        yield {"offset": offset, "length": size, "record_id": warc.get("warc-record-id"), "record_type": warc.get("warc-type"), "payload_bytes": n, "payload_digest": digest}
        offset += size


def _record(stream: Inflated, header: bytes, length: int, payload: Payload) -> Iterator[bytes]:
    yield header
    for piece in stream.pieces(length):
        payload.feed(piece)
        yield piece
    if b"".join(stream.pieces(len(END))) != END:
        raise ValueError("record does not end where its length says")
    yield END


# ---------------------------------------------------------------- files

def store(uri: str):
    """The file system that holds ``uri``, and the path in it."""
    from pyarrow import fs
    if uri.startswith("file:") or uri.startswith("/"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """All ``*.gz`` files of ``source`` rewritten into ``target``; returns the sidecar index of the records."""
    make_folder(spark, target)

    def files(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield pa.RecordBatch.from_pylist([{"path": path, "records": _rewrite_file(path, target)}])

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    listed.mapInArrow(files, "path string, records long").write.format("noop").mode("overwrite").save()
    return read_index(spark, target)


def _rewrite_file(path: str, target: str) -> int:
    """One file rewritten; archive and index get their names when they are whole."""
    system, source = store(path)
    out, folder = store(target)
    name = re.sub(r"(\.txt|\.warc)*\.gz$", "", source.rsplit("/", 1)[-1])
    archive, index = f"{folder}/{name}.warc.gz", f"{folder}/{name}.cdxj"
    own = f"{folder}/_{name}-{uuid.uuid4().hex}"
    n = 0
    with system.open_input_stream(source, compression=None) as src, out.open_output_stream(f"{own}.gz", compression=None) as dst, \
            out.open_output_stream(f"{own}.index", compression=None) as side:
        for entry in rewrite(src.read, dst.write):
            side.write(json.dumps({"archive": f"{target}/{name}.warc.gz"} | entry).encode() + b"\n")
            n += 1
    out.move(f"{own}.gz", archive)
    out.move(f"{own}.index", index)
    return n


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar indexes of a folder: one row per record with its member's place."""
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.cdxj").json(target)


def read_records(index: DataFrame, payload: bool = False) -> DataFrame:
    """The records of ``index`` read member by member, each digest held against its payload.

    ``payload=True`` adds the payload itself (empty for revisits).
    """
    def members(batches):
        opened, file = None, None
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                if row["archive"] != opened:
                    system, path = store(row["archive"])
                    opened, file = row["archive"], system.open_input_file(path)
                file.seek(row["offset"])
                out.append(row | _read_member(file.read(row["length"]), payload))
                held += len(out[-1].get("payload") or b"")
                if held > CHUNK:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    text = RECORDS + (", payload binary" if payload else "")
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in text.split(", "))])
    return index.select("archive", "offset", "length").mapInArrow(members, text)


def _read_member(member: bytes, keep: bool) -> dict:
    data = zlib.decompress(member, 31)
    at = data.index(END) + len(END)
    warc = fields(data[:at])
    body = Payload(is_http(warc))
    block = data[at:-len(END)]
    body.feed(block)
    n, digest = described(warc, body)
    row = {"record_id": warc.get("warc-record-id"), "target_uri": warc.get("warc-target-uri"), "record_type": warc.get("warc-type"),
           "payload_bytes": n, "payload_digest": digest, "refers_to": warc.get("warc-refers-to")}
    return row | ({"payload": block[len(block) - body.bytes:]} if keep else {})


def archive_pages(pages: DataFrame) -> DataFrame:
    """``pages`` written as monolithic archives, normalised and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    whole, members = scratch_path(spark, "warc-whole"), scratch_path(spark, "warc-members")
    write_monolithic(pages, whole)
    records = read_records(normalise(spark, whole, members))
    drop_path(spark, whole)

    def page(urn: str) -> Column:
        number = F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1)
        return F.when(number != "", number.cast("long"))

    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


def oracle() -> str:
    """DuckDB SQL of ``archive_pages``."""
    return f"""
with p as (select page_id, encode(coalesce(html, '')) body from pages),
d as (select page_id, octet_length(body)::bigint n, sha1(body) h from p),
g as (select h, n, max(page_id) head from d where n >= {MIN_REVISIT_BYTES} group by h, n)
select d.page_id, d.n payload_bytes, d.h payload_digest,
  case when head is not null and (d.page_id is null or d.page_id < head) then 'revisit' else 'response' end record_type,
  case when head is not null and (d.page_id is null or d.page_id < head) then head end refers_to
from d left join g on d.h = g.h and d.n = g.n"""
