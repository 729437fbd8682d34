"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as the model says, then cut where no merge can ever reach across (see `Codec`), and each
segment's symbols are merged from an agenda of adjacent pairs: highest score first, leftmost among equals.
In each Arrow batch, what was merged anew is held against the sentencepiece library; on demand, whole texts are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm.agenda import Agenda
from lodestack.llm.memo import Memo
from lodestack.llm.store import trimmed

MARK = "▁"
#: Stands for a mark that follows upon another, so that a run's marks aren't cut.
HELD = "\x01"
_REPEATED = re.compile(f"{MARK}{{2,}}")
#: Letters of the first blocks, which a character class can tell fast, and a search for what lies beyond.
NEAR = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
_FAR = re.compile(f"[^\\x00-\u024f{MARK}]").search
NEVER = 1 << 60
#: Runs, and segments, remembered by a Python worker, in each of two generations (some 150 bytes each).
REMEMBERED_RUNS = 500_000
#: Characters of the longest segments whose agenda is a plain list.
SHORT = 24


class Mismatch(ValueError):
    """The agenda and the library differ on a text."""


class Codec:
    """Encoder and decoder of one model file.

    Segments: no merge makes a symbol that is no piece, so two adjacent characters that stand together in no
    piece never meet in a symbol, and what stands left and right of them is merged apart.  The vocabulary is
    searched for such pairs: (other character, mark) always; (letter, non-letter) and its reverse if they hold.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_RUNS):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lib.get_piece_size()
        if any(lib.is_unused(i) for i in range(count)):
            raise ValueError("vocabularies with unused pieces are not covered")
        self.pieces = [lib.id_to_piece(i) for i in range(count)]
        plain = [i for i in range(count) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        levels = {score: level for level, score in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        #: 0 for the best score; equal scores are equal.
        self.levels = {self.pieces[i]: levels[lib.get_score(i)] for i in plain}
        self.bytes = {self.pieces[i]: i for i in range(count) if lib.is_byte(i)}
        self.byte_of = {i: int(p[3:5], 16) for p, i in self.bytes.items()}
        self.names = [str(i) for i in range(count)]
        self.decimal = pa.array(self.names, pa.large_string())
        #: How ids are packed.
        self.kind = "<u2" if count <= 1 << 16 else "<u4"
        self.unknown = lib.unk_id()
        self.silent = {i for i in range(count) if lib.is_control(i)}
        pairs = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        if any(a != MARK and b == MARK for a, b in pairs):
            self.cut = self.cut_near = None
        elif any(a != MARK and a.isalpha() != b.isalpha() for a, b in pairs):
            self.cut = self.cut_near = re.compile(f"{MARK}*[^{MARK}]*")
        else:
            others = "".join(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha())
            self.cut = re.compile(rf"{MARK}*(?:[^\W_{others}]+|(?:(?!{MARK})[\W_{others}])+)|{MARK}+")
            self.cut_near = re.compile(f"{MARK}*(?:[{NEAR}]+|[^{NEAR}{MARK}]+)|{MARK}+")
        self.dummy = MARK if lib.normalize("a") == f"{MARK}a" else ""
        self.many = Agenda(self.ids, self.levels)
        #: Runs merged since the last check.
        self.fresh: list[tuple[str, bytes]] = []
        self.segment = Memo(None, remembered)
        self.run = Memo(None, remembered)

    def agenda(self, text: str) -> list[str]:
        """Merge the characters of a segment: best score first, then leftmost, until no pair is a piece."""
        symbols: list[str] = list(text)
        get = self.levels.get
        if len(symbols) <= SHORT:
            open_ = [get(both, NEVER) for both in map(add, symbols, symbols[1:])]
            while open_ and (level := min(open_)) < NEVER:
                i = open_.index(level)
                symbols[i] += symbols.pop(i + 1)
                del open_[i]
                if i:
                    open_[i - 1] = get(symbols[i - 1] + symbols[i], NEVER)
                if i < len(open_):
                    open_[i] = get(symbols[i] + symbols[i + 1], NEVER)
            return symbols
        n = len(symbols)
        heap = [(level, i, both) for i, both in enumerate(map(add, symbols, symbols[1:])) if (level := get(both)) is not None]
        heapify(heap)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        while heap:
            _, i, both = heappop(heap)
            j = after[i]
            if j < 0 or not symbols[i] or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, ""
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (level := get(s := both + symbols[k])) is not None:
                    heappush(heap, (level, i, s))
            if (k := before[i]) >= 0 and (level := get(s := symbols[k] + both)) is not None:
                heappush(heap, (level, k, s))
        return [s for s in symbols if s]

    def _segment(self, text: str) -> bytes:
        """A segment's ids, packed."""
        out: list[int] = []
        for symbol in self.agenda(text):
            if (i := self.ids.get(symbol)) is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[f"<0x{b:02X}>"] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        return np.array(out, self.kind).tobytes()

    def _merged(self, segments: list[str]) -> list[bytes]:
        """The packed ids of segments."""
        return [self._segment(s) if v is None else v for s, v in zip(segments, self.many.merge(segments, self.kind), strict=True)]

    def _segments(self, cuts: Iterable[list[str]], words: list[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """The packed ids of all segments in the cuts, and of words, each after a mark: as these are runs too, they are
        remembered as such.  What isn't remembered is merged at once."""
        parts: dict = dict.fromkeys(chain.from_iterable(cuts))
        now, before, runs, older = self.segment, self.segment.older, self.run, self.run.older
        new = []
        for p in parts:
            if p[0] == MARK and p[1:].isalpha():
                v = runs.get(p[1:]) or older.get(p[1:])
            else:
                v = now.get(p) or before.get(p)
            if v is None:
                new.append(p)
            parts[p] = v
        wanted = dict.fromkeys([MARK + w for w in words])
        wanted.update(dict.fromkeys(new))
        merged = dict(zip(wanted, self._merged(list(wanted)), strict=True))
        for p in new:
            parts[p] = merged[p]
        now.put_all({p: parts[p] for p in new if p[0] != MARK or not p[1:].isalpha()})
        found = {w: merged[MARK + w] for w in words}
        runs.put_all({p[1:]: parts[p] for p in new if p[0] == MARK and p[1:].isalpha()})
        return parts, found

    def _learn(self, runs: list[str]) -> dict[str, bytes]:
        """The packed ids of new runs; a run stands between two marks, with the first one of these, and marks that follow
        upon it are written as `HELD`."""
        cuts = {r: self._cuts(MARK + r.replace(HELD, MARK)) for r in runs if not r.isalpha()}
        known, out = self._segments(cuts.values(), [r for r in runs if r.isalpha()])
        for r, cut in cuts.items():
            out[r] = known[cut[0]] if len(cut) == 1 else b"".join([known[p] for p in cut])
        self.run.put_all(out)
        self.fresh += out.items()
        return out

    def check_fresh(self) -> None:
        """Hold all runs merged since the last call against the library, which puts a mark before each."""
        fresh = [x for x in self.fresh if x[0]]
        theirs = self.library.encode([r.replace(HELD, " ") for r, _ in fresh], num_threads=1)
        lengths = np.fromiter(map(len, theirs), np.int64, len(theirs))
        flat = np.fromiter(chain.from_iterable(theirs), np.int64, int(lengths.sum()))
        own = np.frombuffer(b"".join([v for _, v in fresh]), self.kind)
        sizes = np.fromiter((len(v) for _, v in fresh), np.int64, len(fresh)) // np.dtype(self.kind).itemsize
        if not np.array_equal(lengths, sizes) or not np.array_equal(flat, own):
            for (r, v), ids in zip(fresh, theirs, strict=True):
                if np.frombuffer(v, self.kind).tolist() != ids:
                    raise Mismatch(f"ids differ from the library's for {r[:80]!r}")
        self.fresh.clear()

    def _cuts(self, text: str) -> list[str]:
        """The segments of normalised text."""
        if self.cut is None:
            return [text]
        cut = self.cut if _FAR(text) else self.cut_near
        return [part for part in cut.findall(text) if part]

    def _apart(self, normal: str) -> np.ndarray:
        """The ids of a normalised text, segment by segment."""
        known, _ = self._segments([parts := self._cuts(normal)], [])
        return np.frombuffer(b"".join(map(known.__getitem__, parts)), self.kind)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's begin (one more than texts)."""
        normals = self.library.normalize(texts)
        bodies: list[str | None] = []
        apart: dict[int, np.ndarray] = {}
        for k, normal in enumerate(normals):
            if self.cut is None or not normal.startswith(MARK) or HELD in normal:
                if normal:
                    apart[k] = self._apart(normal)
                bodies.append(None)
            else:
                if MARK + MARK in normal:
                    normal = _REPEATED.sub(lambda m: MARK + HELD * (len(m[0]) - 1), normal)
                bodies.append(normal[1:])
        split = pc.split_pattern(pa.array(bodies, pa.large_string()), MARK)
        coded = split.flatten().dictionary_encode()
        runs, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        values = list(map(self.run.get, runs))
        gaps = [(k, r) for k, (r, v) in enumerate(zip(runs, values, strict=True)) if v is None]
        new = []
        for k, r in gaps:
            if (v := self.run.recall(r)) is None:
                new.append(r)
            else:
                values[k] = v
        if new:
            learnt = self._learn(new)
            for k, r in gaps:
                if values[k] is None:
                    values[k] = learnt[r]
        size = np.dtype(self.kind).itemsize
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // size
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]), pa.array(np.frombuffer(b"".join(values), self.kind)))
        ids = lists.take(pa.array(at)).flatten().to_numpy() if len(at) else np.zeros(0, self.kind)
        upto = np.concatenate([[0], np.cumsum(lengths[at])])
        begin = upto[np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy())])]
        if apart:
            pieces = [apart[k] if k in apart else ids[begin[k] : begin[k + 1]] for k in range(len(texts))]
            ids, begin = np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        return ids, begin

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def digests(self, ids: np.ndarray, begin: np.ndarray) -> list[str]:
        """The SHA-256 of each text's ids as decimals joined by commas."""
        lists = pa.LargeListArray.from_arrays(pa.array(begin, pa.int64()), self.decimal.take(pa.array(ids)))
        _, offsets, data = pc.binary_join(lists, pa.scalar(",", pa.large_string())).buffers()
        bounds = np.frombuffer(offsets, np.int64)[: len(begin)].tolist()
        held = memoryview(data) if data is not None else b""
        return [hashlib.sha256(held[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]

    def decimals(self, ids: list[int]) -> str:
        return ",".join(map(self.names.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """As the library's decode(ids): bytes join to UTF-8, marks are spaces, the mark put in front goes."""
        parts: list[str] = []
        held = bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                held.append(b)
                continue
            if held:
                parts.append(held.decode(errors="replace"))
                held.clear()
            if i == self.unknown:
                parts.append(" ⁇ ")
            elif i not in self.silent:
                parts.append(self.pieces[i])
        if held:
            parts.append(held.decode(errors="replace"))
        text = "".join(parts)
        return (text[1:] if self.dummy and text.startswith(MARK) else text).replace(MARK, " ")


_codecs: dict[tuple[str, int], Codec] = {}


def codec(path: str, remembered: int = REMEMBERED_RUNS) -> Codec:
    """One codec for each model in a Python worker."""
    if (path, remembered) not in _codecs:
        _codecs[path, remembered] = Codec(path, remembered)
    return _codecs[path, remembered]


#: Characters of the texts that are worked on at once.
AT_ONCE = 1 << 21


def _groups(texts: list[str], most: int = AT_ONCE) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_decode(frame: DataFrame, model_path: str, text: str = "text", key: str = "doc_id", keep_ids: bool = False, keep_text: bool = False, check: str = "runs", remembered: int = REMEMBERED_RUNS, forget: bool = False, at_once: int = AT_ONCE) -> DataFrame:
    """Encode each whole text, decode the ids, and return digests of both.

    Returns key, n_tokens, ids_sha256, decoded_sha256; with keep_ids also `ids` (array of int), with keep_text
    also `decoded`.  Null texts count as empty and give no ids.  Repeated rows and equal or null keys stay rows of
    their own; an empty table gives an empty result; further columns, whatever their names, are not read.

    check: "runs" holds every run of characters between two marks that a batch has merged anew against the
    library (runs are independent, so that covers the texts); "texts" also encodes each whole text by the library.
    A difference ends the job with `Mismatch`.  remembered: runs that a worker remembers, which trades memory for time;
    forget: drop them when a partition ends, so that idle workers are small; at_once: characters of the texts that are
    worked on together.
    """
    kind = dict(frame.dtypes)[key]
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids + ", decoded string" * keep_text

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, remembered)
        for batch in batches:
            rows: dict[str, list] = {"n": [], "ids": [], "text": [], "kept": [], "decoded": []}
            for group in _groups([x or "" for x in batch.column(1).to_pylist()], at_once):
                every, begin = own.encode_many(group)
                bounds = begin.tolist()
                rows["n"] += np.diff(begin).tolist()
                rows["ids"] += own.digests(every, begin)
                theirs = own.library.encode(group, num_threads=1) if check == "texts" or own.cut is None or not own.dummy else None
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    ids = every[a:b].tolist()
                    if theirs is not None and ids != theirs[k]:
                        raise Mismatch(f"ids differ from the library's for a text of {len(group[k])} characters: {group[k][:80]!r}")
                    decoded = own.library.decode(ids) if ids else ""
                    rows["text"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep_ids:
                        rows["kept"].append(ids)
                    if keep_text:
                        rows["decoded"].append(decoded)
                own.check_fresh()
            arrays = [batch.column(0), pa.array(rows["n"], pa.int64()), pa.array(rows["ids"], pa.string()), pa.array(rows["text"], pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                arrays, names = [*arrays, pa.array(rows["kept"], pa.list_(pa.int32()))], [*names, "ids"]
            if keep_text:
                arrays, names = [*arrays, pa.array(rows["decoded"], pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)
        if forget:
            own.run.forget()
            own.segment.forget()

    return frame.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(trimmed(work), schema)
