"""WARC derivatives: response records become linked metadata and plain-text conversion records.

Files hold one gzip member for each record.  Identifiers are UUIDs made from the source (partition, place in it,
target and digest), so a repeated run over the same partitions names its records alike.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm.store import fresh_path, local_filesystem, materialise

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
LEVEL = 1
CHUNK, FED = 1 << 20, 1 << 12
_CONTROL = re.compile("[\x00-\x1f\x7f]")


class Malformed(ValueError):
    """A file is no WARC, or a record's block doesn't agree with its digest."""


@dataclass
class Record:
    headers: list[tuple[str, str]]
    block: bytes = b""
    offset: int = field(default=0, compare=False)

    def get(self, name: str) -> str | None:
        for k, v in self.headers:
            if k == name:
                return v
        low = name.lower()
        return next((v for k, v in self.headers if k.lower() == low), None)


#: Two places of base 32 for each ten bits.
_PLACES = [a + b for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567" for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]


def digest(data: bytes) -> str:
    mark = int.from_bytes(hashlib.sha1(data).digest())
    return "sha1:" + "".join([_PLACES[mark >> k & 1023] for k in range(150, -1, -10)])


_VARIANT = dict(zip("0123456789abcdef", "89ab" * 4, strict=True))


def identifier(*parts: object) -> str:
    """A name-based UUID (version 5) as a URN."""
    m = hashlib.sha1("\0".join(map(str, parts)).encode()).hexdigest()
    return f"<urn:uuid:{m[:8]}-{m[8:12]}-5{m[13:16]}-{_VARIANT[m[16]]}{m[17:20]}-{m[20:32]}>"


def header_value(text: str) -> str:
    """A value without control characters: they are percent-encoded."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", text)


def serialise(record: Record) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in record.headers)
    return b"".join((f"{VERSION}\r\n{head}Content-Length: {len(record.block)}\r\n\r\n".encode(), record.block, b"\r\n\r\n"))


def member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(data: bytes, offset: int = 0) -> Record:
    """One record from its uncompressed bytes; checks version, length and block digest."""
    head, found, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not found or not first.startswith("WARC/1."):
        raise Malformed(f"no record at {offset}")
    headers = [(k, v.strip()) for k, _, v in (line.partition(":") for line in lines)]
    record = Record([h for h in headers if h[0].lower() != "content-length"], offset=offset)
    length = next((int(v) for k, v in headers if k.lower() == "content-length"), -1)
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise Malformed(f"wrong length at {offset}")
    record.block = rest[:length]
    if (own := record.get("WARC-Block-Digest")) and own != digest(record.block):
        raise Malformed(f"wrong block digest at {offset}")
    return record


def read(stream) -> Iterator[Record]:
    """All records of a gzipped stream; offsets are those of their members."""
    unpacker, parts, at, start = zlib.decompressobj(31), [], 0, 0
    while chunk := stream.read(CHUNK):
        view, here = memoryview(chunk), 0
        while here < len(view):
            fed = view[here : here + FED]  # what follows a member is copied, so little is fed at once
            parts.append(unpacker.decompress(fed))
            used = len(fed) - len(unpacker.unused_data)
            here += used
            at += used
            if unpacker.eof:
                yield parse(b"".join(parts), start)
                unpacker, parts, start = zlib.decompressobj(31), [], at
    if any(parts) or at > start:
        raise Malformed(f"cut short at {start}")


def response(number: tuple[int, int], target: str | None, body: bytes, date: str = DATE) -> Record:
    """A response record of an HTML body."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n%b" % (len(body), body)
    payload = digest(body)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", identifier("response", *number, target, payload)), ("WARC-Date", date)]
    if target is not None:
        headers.append(("WARC-Target-URI", header_value(target)))
    return Record([*headers, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", payload), ("WARC-Block-Digest", digest(block))], block)


_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|title)\b.*?(?:</\1\s*>|\Z)|<head\b.*?(?:</head\s*>|(?=<body)|\Z)", re.S | re.I)
#: Elements that begin and end a line.
_BLOCKS = frozenset("address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section select table tbody td th thead tr ul".split())
_TAG = re.compile(r"<(?:/?([a-zA-Z][^\s/>]*)[^>]*|[!?][^>]*)(?:>|\Z)")
_TITLE = re.compile(r"<title[^>]*>(.*?)(?:</title|\Z)", re.S | re.I)


def plain_text(page: str) -> str:
    """All text that a page shows: a line for each block, white space in it as one space, no empty lines."""
    first, *rest = _TAG.split(_DROPPED.sub(" ", page).replace("\x00", " "))
    parts = [first]
    for name, text in zip(rest[::2], rest[1::2], strict=True):
        if name and (name in _BLOCKS or name.lower() in _BLOCKS):
            parts.append("\x00")
        parts.append(text)
    text = "".join(parts)
    return "\n".join([" ".join(words) for x in html.unescape(text).split("\x00") if (words := x.split())])


#: Headers that derivatives have of their own, and those of the source that metadata, or records of any type, may keep.
_OWN_HEADERS = frozenset("warc-type warc-record-id warc-date warc-target-uri content-type content-length warc-block-digest warc-payload-digest".split())
_OF_METADATA = frozenset("warc-ip-address warc-concurrent-to".split())
_OF_ANY = frozenset({"warc-warcinfo-id"})


def derive(source: Record) -> tuple[Record, Record]:
    """The metadata and the conversion record of a response; both refer to it and keep its target, date and digest.

    Of the response's other WARC headers, each record keeps those that its type may have, and the metadata's fields list
    all of them (as `warc-header-...`), beside the HTTP status and headers.
    """
    ident = source.get("WARC-Record-ID")
    head, _, body = source.block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    page = body.decode(errors="replace")
    text = plain_text(page)
    payload = source.get("WARC-Payload-Digest") or digest(body)
    title = _TITLE.search(page)
    linked = [("WARC-Refers-To", ident)]
    target = source.get("WARC-Target-URI")
    if target is not None:
        linked += [("WARC-Target-URI", target), ("WARC-Refers-To-Target-URI", target)]
    if date := source.get("WARC-Date"):
        linked += [("WARC-Date", date), ("WARC-Refers-To-Date", date)]
    kept = [(k, v) for k, v in source.headers if k.lower() not in _OWN_HEADERS]
    of_metadata = [h for h in kept if h[0].lower() in _OF_METADATA]
    of_any = [h for h in kept if h[0].lower() in _OF_ANY]
    block = text.encode()
    fields = [*((f"warc-header-{k.lower()}", v) for k, v in kept), ("http-status", status), *((f"http-header-{k.strip().lower()}", v.strip()) for k, _, v in (x.partition(":") for x in lines)), ("source-payload-digest", payload), ("source-length", str(len(body))), ("text-digest", digest(block)), ("text-length", str(len(text)))]
    if title:
        fields.append(("title", header_value(" ".join(html.unescape(title[1]).split()))))
    about = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    metadata = Record([("WARC-Type", "metadata"), ("WARC-Record-ID", identifier("metadata", ident)), *linked, *of_metadata, *of_any, ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", digest(about))], about)
    conversion = Record([("WARC-Type", "conversion"), ("WARC-Record-ID", identifier("conversion", ident)), *linked, *of_any, ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Block-Digest", digest(block)), ("WARC-Source-Payload-Digest", payload)], block)
    return metadata, conversion


def _open_writer(files, local: str):
    files.create_dir(local.rpartition("/")[0], recursive=True)
    return files.open_output_stream(local, buffer_size=1 << 22)


def _write_responses(folder: str, date: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, offset, stream = TaskContext.get().partitionId(), 0, 0, None
        name = f"{folder}/responses-{part:06d}-{uuid.uuid4().hex}.warc.gz"
        with local_filesystem(name) as (files, local):
            for batch in batches:
                rows = []
                for target, page in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                    stream = stream or _open_writer(files, local)
                    made = response((part, place), target, (page.as_py() or "").encode(), date)
                    data = member(serialise(made))
                    stream.write(data)
                    rows.append((name, offset, made.get("WARC-Record-ID"), made.get("WARC-Payload-Digest")))
                    offset += len(data)
                    place += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in zip(*rows, strict=True))], ["key", "url", "file", "offset", "response_id", "payload_digest"])
            if stream is not None:
                stream.close()

    return work


def _derive_files(folder: str):
    """Rows (file) of response files to rows (file) of files of their derivatives; other records are passed by."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = f"{folder}/derived-{uuid.uuid4().hex}.warc.gz"
                with local_filesystem(source) as (files, local), files.open_input_stream(local, buffer_size=CHUNK) as stream, local_filesystem(name) as (out_files, out_local):
                    with _open_writer(out_files, out_local) as out:
                        for record in read(stream):
                            if record.get("WARC-Type") == "response":
                                for made in derive(record):
                                    out.write(member(serialise(made)))
                yield pa.RecordBatch.from_arrays([pa.array([source]), pa.array([name])], ["source", "file"])

    return work


_ROW = "file string, offset long, type string, record_id string, refers_to string, target string, block_digest string, source_digest string, n_chars long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _ROW.split(", ")]
    for batch in batches:
        for name in batch.column(0).to_pylist():
            with local_filesystem(name) as (files, local), files.open_input_stream(local, buffer_size=CHUNK) as stream:
                rows = []
                for r in read(stream):
                    kind = r.get("WARC-Type")
                    source = r.get("WARC-Source-Payload-Digest") or r.get("WARC-Payload-Digest")
                    if kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in r.block.decode().split("\r\n") if ": " in x)
                        source = fields.get("source-payload-digest")
                    rows.append((name, r.offset, kind, r.get("WARC-Record-ID"), r.get("WARC-Refers-To"), r.get("WARC-Target-URI"), r.get("WARC-Block-Digest"), source, len(r.block.decode()) if kind == "conversion" else None))
                    if len(rows) == 2048:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n in ("offset", "n_chars") else pa.string()) for c, n in zip(zip(*rows, strict=True), names, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n in ("offset", "n_chars") else pa.string()) for c, n in zip(zip(*rows, strict=True), names, strict=True)], names)


def write_responses(frame: DataFrame, folder: str, page: str = "html", url: str = "url", key: str = "page_id", date: str = DATE) -> DataFrame:
    """Write each row as a response record; returns key, url, file, offset, response_id, payload_digest.

    Null pages have an empty body, null urls no target; control characters in urls are percent-encoded; repeated rows
    are records of their own; an empty table writes no file.
    """
    kind = dict(frame.dtypes)[key]
    picked = frame.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{page}`").cast("string").alias("html"))
    return materialise(picked.mapInArrow(_write_responses(folder, date), f"key {kind}, url string, file string, offset long, response_id string, payload_digest string"), "responses")


def _spread(files: DataFrame) -> DataFrame:
    tasks = max(12, files.sparkSession.sparkContext.defaultParallelism * 2)
    return files.select("file").distinct().repartition(tasks, "file")


def build(files: DataFrame, folder: str) -> DataFrame:
    """Derive metadata and conversion records from response files (column file); returns (source, file)."""
    return materialise(_spread(files).mapInArrow(_derive_files(folder), "source string, file string"), "derived")


def scan(files: DataFrame) -> DataFrame:
    """The records of WARC files (column file), checked against their lengths and digests."""
    return _spread(files).mapInArrow(_scan, _ROW)


def derivatives(frame: DataFrame, page: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """Write responses, build their derivatives, read these back, and link them.

    Returns key, url, response_id, metadata_id, conversion_id, payload_digest, text_digest, n_chars and linked: whether
    both derivatives carry the response's payload digest.
    """
    folder = fresh_path(frame.sparkSession, "warc")
    responses = write_responses(frame, folder, page, url, key)
    found = scan(build(responses, folder))
    pairs = found.groupBy("refers_to").agg(
        F.max(F.when(F.col("type") == "metadata", F.col("record_id"))).alias("metadata_id"),
        F.max(F.when(F.col("type") == "conversion", F.col("record_id"))).alias("conversion_id"),
        F.max(F.when(F.col("type") == "conversion", F.col("block_digest"))).alias("text_digest"),
        F.max("n_chars").alias("n_chars"),
        F.min("source_digest").alias("low"),
        F.max("source_digest").alias("high"),
    )
    # Spark takes the scan's size for that of its list of files, so it must not choose to send it to all executors.
    out = responses.join(pairs.hint("merge"), responses.response_id == pairs.refers_to, "left")
    linked = F.coalesce((F.col("low") == F.col("payload_digest")) & (F.col("high") == F.col("payload_digest")) & F.col("metadata_id").isNotNull() & F.col("conversion_id").isNotNull(), F.lit(False))
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "response_id", "metadata_id", "conversion_id", "payload_digest", "text_digest", "n_chars", linked.alias("linked"))
