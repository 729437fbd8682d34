"""Token ids as length-delimited binary records, with a separate offset index for shuffled reads.

A record file is a run of frames: length of the payload (u64), masked CRC-32 of those eight bytes (u32), payload,
masked CRC-32 of the payload (u32), all little-endian.  A payload is the document's key (i64), a byte that is 2 or 4
(plus 128 if the key is null), and the ids as unsigned integers of 2 or 4 bytes.  The index is a Parquet table with one row for each record: key,
file, offset and length of the frame, number of ids, and the number of ids before it.

Masking rotates a checksum right by 15 bits and adds 0xA282EAD8, so that checksums of data holding checksums stay
strong.
"""

from __future__ import annotations

import contextlib
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestack.llm.memo import Memo
from lodestack.llm.store import drop, fresh_path, local_filesystem, materialise, trimmed

#: Chunks between spaces, and words, remembered by a worker, in each of two generations.
REMEMBERED_CHUNKS, REMEMBERED_WORDS = 700_000, 300_000
#: Strings given to the library at once.
AT_ONCE = 2048
MARKS = frozenset(".,;:!?|")
#: Letters with one form under NFC, which are lower-cased one by one.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def _byte_letters() -> list[str]:
    """The character for each byte in byte-level vocabularies: printable Latin-1 for itself, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


BYTE_LETTERS = _byte_letters()
#: Bytes buffered before they are written.
BUFFER = 1 << 22
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_KEY = struct.Struct("<qB")
#: Added to the byte of the width in records of rows without a key.
NO_KEY = 0x80
#: Bytes of a record beside its ids.
OVERHEAD = _HEAD.size + _TAIL.size + _KEY.size


class Damaged(ValueError):
    """A record's checksum or length is wrong."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame_record(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, _TAIL.pack(masked(size)), payload, _TAIL.pack(masked(payload))))


def read_records(stream) -> Iterator[tuple[int, bytes]]:
    """Offsets and payloads of all records of a binary stream; checks every length and checksum."""
    at = 0
    while head := stream.read(_HEAD.size):
        if len(head) < _HEAD.size:
            raise Damaged(f"cut short at {at}")
        size, check = _HEAD.unpack(head)
        if masked(head[:8]) != check:
            raise Damaged(f"wrong length at {at}")
        body = stream.read(size + _TAIL.size)
        if len(body) < size + _TAIL.size or masked(body[:size]) != _TAIL.unpack(body[size:])[0]:
            raise Damaged(f"wrong payload at {at}")
        yield at, body[:size]
        at += _HEAD.size + size + _TAIL.size


def read_record(stream, offset: int) -> bytes:
    """One record, as the index names it."""
    stream.seek(offset)
    return next(read_records(stream))[1]


def frame_ids(key: int | None, ids: bytes, width: int) -> bytes:
    """The record of ids that are little-endian integers of `width` bytes."""
    return frame_record(_KEY.pack(key or 0, width | NO_KEY * (key is None)) + ids)


def unpack_ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, width = _KEY.unpack_from(payload)
    return None if width & NO_KEY else key, np.frombuffer(payload, f"<u{width & ~NO_KEY}", offset=_KEY.size)


class Tokens:
    """Ids of whole texts by the tokenizers library, which sees each distinct chunk once.

    Chunks stand between spaces (line feeds count as spaces).  That is exact where the tokenizer turns white space
    into nothing but boundaries: its normaliser maps runs of it to one space, its pre-tokenizer drops it and no
    added token has any; `whole` says that this doesn't hold, and texts are then encoded whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        spec = json.loads(self.tokenizer.to_str())
        steps = lambda x: (x or {}).get("normalizers") or (x or {}).get("pretokenizers") or [x or {}]
        spaced = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " " for s in steps(spec.get("normalizer")))
        harmless = all(s.get("type") in ("NFC", "Lowercase", "Replace") for s in steps(spec.get("normalizer")))
        first = steps(spec.get("pre_tokenizer"))[0]
        dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and first["pattern"].get("Regex", "").endswith("[^\\s\\p{L}\\p{N}]+")
        plain = all(not x["lstrip"] and not x["rstrip"] and " " not in x["content"] and "\n" not in x["content"] for x in spec.get("added_tokens", []))
        self.whole = not (spaced and harmless and dropped and plain and spec.get("post_processor") is None)
        self.chunks = Memo(None, REMEMBERED_CHUNKS)
        self.model = self.tokenizer.model
        self.words = Memo(self._word, REMEMBERED_WORDS)
        lower = any(s.get("type") == "Lowercase" for s in steps(spec.get("normalizer")))
        second = steps(spec.get("pre_tokenizer"))[1:]
        #: Whether words can go straight to the model.
        self.plain = lower and [s.get("type") for s in second] == ["ByteLevel"] and not second[0].get("add_prefix_space") and not second[0].get("use_regex")
        self.marks = dict(zip(sorted(MARKS), self._ids(sorted(MARKS)), strict=True))

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for k in range(0, len(texts), AT_ONCE):
            out += [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts[k : k + AT_ONCE], add_special_tokens=False)]
        return out

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of lower-case letters: normaliser and pre-tokenizer would leave them as they are, and byte them."""
        if not word.isascii():
            word = "".join(map(BYTE_LETTERS.__getitem__, word.encode()))
        return self._bytes([t.id for t in self.model.tokenize(word)])

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of new chunks.  Letters and a mark meet at a boundary of the pre-tokenizer, so each is encoded once."""
        others, out = [], {}
        words, letters, marks = self.words, _LETTERS, self.marks
        for chunk in chunks:
            if self.plain:
                if chunk.isalpha():
                    if chunk.isascii() or letters(chunk):
                        out[chunk] = words[chunk.lower()]
                        continue
                elif chunk and chunk[-1] in MARKS and (head := chunk[:-1]).isalpha() and (head.isascii() or letters(head)):
                    out[chunk] = words[head.lower()] + marks[chunk[-1]]
                    continue
            others.append(chunk)
        out.update(zip(others, self._ids(others), strict=True))
        self.chunks.put_all(out)
        return out

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's begin (one more than texts).  Nulls have none."""
        kind = f"<u{self.width}"
        if self.whole:
            parts = [np.frombuffer(x, kind) for x in self._ids([t or "" for t in texts.to_pylist()])]
            return np.concatenate([np.zeros(0, kind), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        chunks, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        values = list(map(self.chunks.get, chunks))
        gaps = [k for k, v in enumerate(values) if v is None]
        recall = self.chunks.older.get
        for k in gaps:
            values[k] = recall(chunks[k])
        self.chunks.put_all({chunks[k]: values[k] for k in gaps if values[k] is not None})
        gaps = [k for k in gaps if values[k] is None]
        learnt = self._learn([chunks[k] for k in gaps])
        for k in gaps:
            values[k] = learnt[chunks[k]]
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // self.width
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]), pa.array(np.frombuffer(b"".join(values), kind)))
        ids = lists.take(pa.array(at)).flatten().to_numpy() if len(at) else np.zeros(0, kind)
        upto = np.concatenate([[0], np.cumsum(lengths[at])])
        return ids, upto[np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy())])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, little-endian."""
        ids, begin = self.encode_many(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(begin.tolist(), begin[1:].tolist(), strict=False)]


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokens[path] = Tokens(path)
    return _tokens[path]


def _encoded(path: str, bounds: np.ndarray):
    """Rows (key, text) to rows (part, key, ids): the packed ids, and the part of the order that the key belongs to.

    Part p holds the keys from bound p - 1 up to bound p, both included: rows of a key that is the bound of several parts
    may stand in any of these, and are dealt out by a checksum of their ids.  Null keys stand before all others.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path)
        for batch in batches:
            for k, stop in _runs(batch.column(1)):
                some = batch.slice(k, stop - k)
                ids, begin = own.encode_many(some.column(1))
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(begin.astype(np.int64) * own.width), pa.py_buffer(ids)]).cast(pa.binary())
                keys = some.column(0).fill_null(_LOWEST).to_numpy()
                low, high = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
                for i in np.flatnonzero(high > low):
                    low[i] += zlib.crc32(ids[begin[i] : begin[i + 1]].tobytes()) % (high[i] - low[i] + 1)
                yield pa.RecordBatch.from_arrays([pa.array(low, pa.int32()), some.column(0), packed], ["part", "key", "ids"])

    return work


_LOWEST = -(1 << 63)


def _runs(texts: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about `most` bytes; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, stop
        at = stop


def _write(folder: str, width: int, end_id: int | None):
    """Write a partition's records to a file of this attempt; rows (part, key, file, offset, length, n_tokens, inside).

    inside: the ids before the record in its file.

    A file is named by the attempt that wrote it: an attempt that is lost leaves one that no index row names.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = b"" if end_id is None else np.array([end_id], f"<u{width}").tobytes()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.rec"
        offset = inside = 0
        with local_filesystem(name) as (files, local), contextlib.ExitStack() as held:
            stream = None
            for batch in batches:
                if not len(batch):
                    continue
                if stream is None:
                    files.create_dir(local.rpartition("/")[0], recursive=True)
                    stream = held.enter_context(files.open_output_stream(local, buffer_size=BUFFER))
                keys = batch.column(1).to_pylist()
                sizes = np.empty(len(keys), np.int64)
                for i, (key, ids) in enumerate(zip(keys, batch.column(2), strict=True)):
                    record = frame_ids(key, ids.as_buffer().to_pybytes() + end, width)
                    stream.write(record)
                    sizes[i] = len(record)
                offsets = offset + np.cumsum(sizes) - sizes
                counts = (sizes - OVERHEAD) // width
                ends = inside + np.cumsum(counts)
                n = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part)), batch.column(1), pa.array([name] * n), pa.array(offsets), pa.array(sizes), pa.array(counts), pa.array(ends - counts)], ["part", "key", "file", "offset", "length", "n_tokens", "inside"])
                offset += int(sizes.sum())
                inside = int(ends[-1])

    return work


_READ = "file string, offset long, key long, start long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, before) to a row for each record of the file; before: the ids of all records in earlier files."""
    names, kinds = zip(*((x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _READ.split(", ")), strict=True)
    for batch in batches:
        for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with local_filesystem(name) as (files, local), files.open_input_stream(local, buffer_size=BUFFER) as stream:
                rows: list[tuple] = []
                for offset, payload in read_records(stream):
                    key, ids = unpack_ids(payload)
                    rows.append((name, offset, key, start, len(ids), zlib.crc32(ids.astype("<u4"))))
                    start += len(ids)
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)


@dataclass(frozen=True)
class Dataset:
    """Where the records are: a folder of .rec files and the Parquet index."""

    folder: str
    index_path: str

    def index(self, spark: SparkSession) -> DataFrame:
        """One row for each record: key, file, offset, length, n_tokens, start (the ids of all records before it)."""
        return spark.read.parquet(self.index_path)

    def files(self, spark: SparkSession) -> DataFrame:
        """One row for each file, with `before`: the ids of all records in earlier files."""
        return self.index(spark).groupBy("file").agg(F.min("start").alias("before"))

    def scan(self, spark: SparkSession, tasks: int | None = None) -> DataFrame:
        """Read all the files back: file, offset, key, start, n_tokens, ids_crc32; raises `Damaged` on a wrong checksum."""
        wanted = self.files(spark).repartition(tasks or max(12, spark.sparkContext.defaultParallelism * 2), "file")
        return wanted.mapInArrow(_read, _READ)


def _bounds(keys: DataFrame, parts: int) -> np.ndarray:
    """The keys between parts of about equal numbers of rows (by a sketch of the key column alone)."""
    places = [k / parts for k in range(1, parts)]
    found = keys.agg(F.percentile_approx("key", F.lit(places), max(10_000, 20 * parts))).first()[0] if places else None
    return np.array(found or [], np.int64)


def write(frame: DataFrame, tokenizer_path: str, end_id: int | None = 1, text: str = "text", key: str = "doc_id", folder: str | None = None, parts: int | None = None) -> Dataset:
    """Write the ids of every whole text, followed by end_id, in ascending order of the key.

    Files (as many as `parts`, or else as the session's shuffle partitions; fewer for few rows) follow each other by
    name, records in a file by key; rows with equal keys follow each other in any order, and may fill several files;
    null keys come first and stay null.  Null and empty texts have the end id only.  An empty table gives an empty index
    and no files; other columns are not read.

    Texts are encoded where they are read, and only their ids are dealt out by key.
    """
    spark = frame.sparkSession
    folder = folder or fresh_path(spark, "records")
    picked = frame.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    encoded = picked.mapInArrow(trimmed(_encoded(tokenizer_path, _bounds(picked.select("key"), parts))), "part int, key long, ids binary")
    ordered = encoded.repartitionById(parts, "part").sortWithinPartitions("key")
    schema = "part long, key long, file string, offset long, length long, n_tokens long, inside long"
    written = materialise(ordered.mapInArrow(trimmed(_write(folder, tokens(tokenizer_path).width, end_id)), schema), "written")
    # A running sum over as many rows as there are files.
    totals = written.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    index = written.join(before, "part").select("key", "file", "offset", "length", "n_tokens", (F.col("before") + F.col("inside")).alias("start"))
    index.write.parquet(f"{folder}/index")
    drop(written)
    return Dataset(folder, f"{folder}/index")


def round_trip(frame: DataFrame, tokenizer_path: str, end_id: int | None = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write the records and read them back: key, start, n_tokens, ids_crc32, file, offset."""
    spark = frame.sparkSession
    back = write(frame, tokenizer_path, end_id, text, key).scan(spark)
    return back.select(F.col("key").alias(key), "start", "n_tokens", "ids_crc32", F.regexp_extract("file", "[^/]*$", 0).alias("file"), "offset")
