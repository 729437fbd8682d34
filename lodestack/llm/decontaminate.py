"""Benchmark passages in documents: latent semantic retrieval, then common subsequences and answer checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import textvec as tv
from lodestack.llm.store import drop, materialise, trimmed

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Words of a block; passages are runs of blocks.
BLOCK = 8
#: Blocks of the passages of which statistics are made.
PASSAGE = 8
#: Sizes of the passages that are searched, in blocks: each is a sum of two smaller ones; longer items are found by parts.
LADDER = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
#: Items that are worked on together, and the distinct words they may have; more are worked off in several blocks.  A
#: worker holds some 1200 bytes for each word (and the driver as many).
MOST_ITEMS, MOST_VOCABULARY = 20_000, 1 << 17
#: Passages that are held against an item in the latent space at once.
MOST_PAIRS = 1 << 16
#: Neighbouring windows that are first held against an item as one.
TOGETHER = 16
#: Items whose rare words are looked up at once.
LOOKED_UP = 64
#: Words worked on at once.
MOST_WORDS = 1 << 16


@dataclass(frozen=True)
class Settings:
    """rank, extra: dimensions of the latent space and oversampling of the random test matrix.  max_df: words in more
    of the passages (and more than 50) carry no weight.  cosine: least similarity of a candidate passage.  overlap,
    answer: least shares of the item's words, and of those of its answer, in a common subsequence."""

    rank: int = 96
    extra: int = 16
    max_df: float = 0.01
    cosine: float = 0.5
    overlap: float = 0.6
    answer: float = 0.5
    answer_share: float = 0.3
    seed: int = 7


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters, digits and non-ASCII) of lower-cased texts, and each text's first."""
    starts, ends, first = tv.spans(_WORD[data], offs)
    return tv.hashes(data, starts, ends), first


@dataclass(frozen=True)
class Items:
    """The benchmark: ids, the vocabulary (sorted hashes), and each item's words as 1-based places in it."""

    ids: list
    vocabulary: np.ndarray
    words: list[np.ndarray]

    @classmethod
    def blocks(cls, benchmark: DataFrame, text: str, key: str) -> Iterator[Items]:
        """The items that have words, in blocks within both bounds (an item with more words is a block by itself)."""
        rows = benchmark.select(F.col(f"`{key}`").alias("key"), F.lower(F.col(f"`{text}`").cast("string")).alias("text")).toLocalIterator()
        ids, hashed, known = [], [], set()
        while some := list(islice(rows, 1000)):
            every, first = word_hashes(*tv.buffers(pa.array([r["text"] for r in some], pa.string())))
            for k, row in enumerate(some):
                if first[k] == first[k + 1]:
                    continue
                own = every[first[k] : first[k + 1]]
                fresh = set(own.tolist()) - known
                if ids and (len(ids) == MOST_ITEMS or len(known) + len(fresh) > MOST_VOCABULARY):
                    yield cls._made(ids, hashed)
                    ids, hashed, known, fresh = [], [], set(), set(own.tolist())
                ids.append(row["key"])
                hashed.append(own)
                known |= fresh
        if ids:
            yield cls._made(ids, hashed)

    @classmethod
    def _made(cls, ids: list, hashed: list[np.ndarray]) -> Items:
        vocabulary = np.unique(np.concatenate(hashed))
        return cls(ids, vocabulary, [np.searchsorted(vocabulary, h).astype(np.int32) + 1 for h in hashed])


def _placed(vocabulary: np.ndarray):
    """Rows (row, key, words): each text's words as little-endian 16- or 32-bit places in the vocabulary, 0 elsewhere."""
    kind = np.uint16 if len(vocabulary) < 65535 else np.uint32

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 36
        seen = np.zeros(1 << 22, bool)
        seen[(vocabulary & tv.U64((1 << 22) - 1)).astype(np.int64)] = True
        for batch in batches:
            for a, b, data, offs in tv.slices(batch.column(1), 1 << 21):
                hashed, first = word_hashes(data, offs)
                out = np.zeros(len(hashed), kind)
                maybe = np.flatnonzero(seen[(hashed & tv.U64((1 << 22) - 1)).astype(np.int64)])
                at = np.searchsorted(vocabulary, hashed[maybe])
                at[at == len(vocabulary)] = 0
                hit = vocabulary[at] == hashed[maybe]
                out[maybe[hit]] = at[hit] + 1
                size = out.itemsize
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((first * size).astype(np.int64)), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + b - a)), batch.column(0).slice(a, b - a), packed.cast(pa.binary())], ["row", "key", "words"])
                row += b - a

    return work, kind


def _groups(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows: their batch, the words, and each row's first word."""
    for batch in batches:
        each = [np.frombuffer(v.as_buffer(), kind) for v in batch.column(2)]
        sizes = np.array([len(v) for v in each], np.int64)
        at = 0
        while at < len(each):
            stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), MOST_WORDS, "right")))
            yield batch.slice(at, stop - at), np.concatenate(each[at:stop]).astype(np.int64), np.concatenate([[0], np.cumsum(sizes[at:stop])])
            at = stop


def _blocks(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of every word (blocks don't cross rows), and each row's first block."""
    counts = -(-np.diff(first) // width)
    begin = np.concatenate([[0], np.cumsum(counts)])
    inside = np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))
    return np.repeat(begin[:-1], np.diff(first)) + inside // width, begin


def _passage_counts(kind: type, size: int):
    """For each word of the vocabulary, in how many passages it is; place 0 counts the passages."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for _, words, first in _groups(batches, kind):
            passage, begin = _blocks(first, BLOCK * PASSAGE)
            total[0] += begin[-1]
            held = np.flatnonzero(words)
            pairs = np.unique(passage[held] * (size + 1) + words[held])
            total += np.bincount(pairs % (size + 1), minlength=size + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["word", "n"])

    return work


def _sketch(kind: type, weights: np.ndarray, test: np.ndarray):
    """Partial sums of A'(A T) and of (A T)'(A T), for the unit rows A of TF-IDF passages and a test matrix T."""
    size, width = test.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, gram = np.zeros((size, width)), np.zeros((width, width))
        for _, words, first in _groups(batches, kind):
            passage, begin = _blocks(first, BLOCK * PASSAGE)
            held = np.flatnonzero(weights[words])
            if not len(held):
                continue
            pairs, tf = np.unique(passage[held] * size + words[held], return_counts=True)
            row, word = pairs // size, pairs % size
            value = (1 + np.log(tf)) * weights[word]
            norm = np.sqrt(np.bincount(row, value * value, minlength=begin[-1]))
            value = (value / norm[row]).astype(np.float32)
            rows, at = np.unique(row, return_index=True)
            y = np.add.reduceat(test[word] * value[:, None], at, axis=0)
            gram += y.T @ y
            order = np.argsort(word, kind="stable")
            back = y[np.searchsorted(rows, row[order])] * value[order][:, None]
            uses, at = np.unique(word[order], return_index=True)
            total[uses] += np.add.reduceat(back, at, axis=0)
        some = np.flatnonzero(np.abs(total).max(axis=1))
        vectors = [*total[some], *gram]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([some, size + np.arange(width)])), pa.array([v.astype(np.float64).tobytes() for v in vectors], pa.binary())], ["word", "vector"])

    return work


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each word; a partition holds all rows of its words."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for word, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(vector.as_buffer(), np.float64)
            total[word] = total[word] + own if word in total else own
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["word", "vector"])


def latent_space(placed: DataFrame, kind: type, size: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """A vector for each word (row 0: none): its TF-IDF weight times its row of the right singular vectors; and the
    number of passages that hold it.

    One pass counts passages; a second makes, from all passages, the sketch of a randomised eigendecomposition of A'A
    (Nystrom: with Z = A'A T, A'A is about Z (T'Z)^-1 Z').  Sums of at most vocabulary x (rank + extra) numbers meet
    on the driver, whatever the corpus.
    """
    spark = placed.sparkSession
    tasks = placed.coalesce(max(1, min(placed.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism)))
    counted = tasks.mapInArrow(_passage_counts(kind, size), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(size + 1)
    df[counted["word"].to_numpy()] = counted["n"].to_numpy()
    passages, df[0] = df[0], 0
    weights = np.where(df > max(settings.max_df * passages, 50), 0, np.log((1 + passages) / (1 + df)) + 0.1)
    weights[0] = 0
    width = min(settings.rank + settings.extra, size)
    test = np.random.default_rng(settings.seed).standard_normal((size + 1, width)).astype(np.float32)
    parts = tasks.mapInArrow(trimmed(_sketch(kind, weights.astype(np.float32), test)), "word long, vector binary")
    summed = parts.repartition(8, "word").mapInArrow(_added, "word long, vector binary").toArrow()
    z, gram = np.zeros((size + 1, width)), np.zeros((width, width))
    for word, vector in zip(summed["word"].to_pylist(), summed["vector"], strict=True):
        own = np.frombuffer(vector.as_buffer(), np.float64)
        if word <= size:
            z[word] = own
        else:
            gram[word - size - 1] = own
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    good = values > max(values[-1], 1e-30) * 1e-10
    right, _, _ = np.linalg.svd(z @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    right = right[:, : settings.rank]
    return (right * weights[:, None]).astype(np.float32), df


def common_subsequence(masks: dict[int, int], length: int, words: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel; masks: each word's places in the pattern."""
    full = (1 << length) - 1
    row = full
    for w in words.tolist():
        if hit := masks.get(w):
            both = row & hit
            row = ((row + both) | (row - both)) & full
    return length - row.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def least_common(length: int, settings: Settings) -> int:
    """The fewest words that are enough of an item."""
    out = max(1, int(settings.overlap * length))
    return out if out / length >= settings.overlap else out + 1


@dataclass(frozen=True)
class Rare:
    """Each item's rarest words, so many that any common subsequence that is long enough has `hits` of them.

    A subsequence of `need` words leaves out length - need of the item's words, so of length - need + hits words it has
    at least `hits`, whichever they are.  The rarity of words decides only about the work, not about what is found.
    blocks: for each LOOKED_UP items, where each word's items begin, and those items.
    """

    hits: np.ndarray
    blocks: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, words_of: list[np.ndarray], df: np.ndarray, settings: Settings) -> Rare:
        hits, chosen = np.ones(len(words_of), np.int64), []
        for i, words in enumerate(words_of):
            need = least_common(len(words), settings)
            hits[i] = max(1, need // 4)
            own, times = np.unique(words, return_counts=True)
            order = np.argsort(df[own], kind="stable")
            enough = int(np.searchsorted(np.cumsum(times[order]), len(words) - need + hits[i])) + 1
            chosen.append(own[order[:enough]])
        blocks = []
        for k in range(0, len(chosen), LOOKED_UP):
            some = chosen[k : k + LOOKED_UP]
            words, items = np.concatenate(some).astype(np.int64), np.repeat(np.arange(k, k + len(some)), [len(x) for x in some])
            order = np.argsort(words, kind="stable")
            blocks.append((np.concatenate([[0], np.cumsum(np.bincount(words, minlength=len(df)))]).astype(np.int32), items[order].astype(np.int32)))
        return cls(hits, blocks)

    def runs(self, words: np.ndarray, row_of: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, item, and the first and last start of windows of `reach` words that hold enough rare words."""
        out: list[tuple[np.ndarray, ...]] = []
        for begin, items in self.blocks:
            at = np.flatnonzero(begin[words + 1] > begin[words])
            counts = (begin[words[at] + 1] - begin[words[at]]).astype(np.int64)
            if not len(at):
                continue
            place = np.repeat(at, counts)
            item = items[np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begin[words[at]], counts)]
            order = np.argsort(item, kind="stable")
            place, item = place[order], item[order]
            last = np.arange(len(place)) + self.hits[item] - 1
            inside = np.flatnonzero(last < len(place))
            end = last[inside]
            fits = (item[end] == item[inside]) & (place[end] - place[inside] < reach[item[inside]]) & (row_of[place[end]] == row_of[place[inside]])
            inside, end = inside[fits], end[fits]
            if not len(inside):
                continue
            i, r = item[inside], row_of[place[inside]]
            low, high = place[end] - reach[i] + 1, place[inside]
            new = np.ones(len(i), bool)
            new[1:] = (i[1:] != i[:-1]) | (r[1:] != r[:-1]) | (low[1:] > high[:-1])
            first = np.flatnonzero(new)
            stop = np.append(first[1:], len(i)) - 1
            out.append((r[first], i[first].astype(np.int64), low[first], high[stop]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4


def _spans_of(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of entries whose counts add up to about `most`; one with more stands alone."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, stop
        at = stop


def _search(kind: type, words_of: list[np.ndarray], space: np.ndarray, df: np.ndarray, settings: Settings):
    """Rows (row, key, item, start, end, cosine, overlap, answer) of confirmed passages, the best for each item."""
    lengths = np.array([len(w) for w in words_of])
    ladder = np.array(LADDER)
    # The passage sizes (in blocks) in which an item is looked for: the next to its length.
    sizes = ladder[np.minimum(np.searchsorted(ladder, -(-lengths // BLOCK)), len(ladder) - 1)]
    items = np.stack([space[w].sum(axis=0) for w in words_of])
    norms = np.linalg.norm(items, axis=1)
    # Of an item beyond the longest passage only a part can be in one.
    covered = np.sqrt(np.minimum(1, sizes * BLOCK / np.maximum(lengths, 1)))
    units = (items / np.maximum(norms, 1e-12)[:, None]).astype(np.float32)
    masks = [_masks(w) for w in words_of]
    tails = [min(len(w), max(3, int(np.ceil(settings.answer_share * len(w))))) for w in words_of]
    answers = [_masks(w[-t:]) for w, t in zip(words_of, tails, strict=True)]
    weightless = ~space.any(axis=1)
    rare = Rare.of(words_of, df, settings)
    # As many words as the widest window around a candidate passage.
    reach = np.maximum(sizes * BLOCK, lengths) + 2 * (lengths // 2 + BLOCK)

    def candidates(words: np.ndarray, first: np.ndarray, block: np.ndarray, begin: np.ndarray, runs: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
        """Of the passages that touch a window of an item's rare words, those close to the item in the latent space.

        Rows, items, first and last words, cosines, and whether a run of neighbouring passages begins.
        """
        row_of = np.repeat(np.arange(len(first) - 1), np.diff(begin))
        total = len(row_of)
        usable = norms[runs[1]] > 0
        r, item, low, high = (x[usable] for x in runs)
        held = np.flatnonzero(~weightless[words])
        if len(held) and len(r):
            sums = {1: np.zeros((total, space.shape[1]), np.float32)}
            which, at = np.unique(block[held], return_index=True)
            sums[1][which] = np.add.reduceat(space[words[held]], at, axis=0)
            left = begin[row_of + 1] - np.arange(total)
            for n in LADDER[: LADDER.index(int(sizes[item].max())) + 1]:
                if n > 1:
                    one, two = (n // 2, n // 2) if n & (n - 1) == 0 else (2 * n // 3, n // 3)
                    sums[n] = sums[one].copy()
                    sums[n][:-one] += np.where((left > one)[:-one, None], sums[two][one:], 0)
                    for old in [k for k in sums if k < n // 2]:
                        del sums[old]
                mine = np.flatnonzero(sizes[item] == n)
                if not len(mine):
                    continue
                rows, which = r[mine], item[mine]
                start = begin[rows] + np.maximum(0, low[mine] - first[rows]) // BLOCK
                stop = np.minimum(begin[rows + 1], begin[rows] + (high[mine] + reach[which] - 1 - first[rows]) // BLOCK + 1)
                counts = np.maximum(1, stop - start - n + 1)
                for k, end in _spans_of(counts, MOST_PAIRS):
                    some = counts[k:end]
                    b = np.repeat(start[k:end] - np.cumsum(some) + some, some) + np.arange(int(some.sum()))
                    pairs = np.unique(np.repeat(which[k:end], some) * total + b)
                    i, b = pairs // total, pairs % total
                    norm = np.linalg.norm(sums[n][b], axis=1)
                    cosine = np.einsum("ij,ij->i", sums[n][b], units[i]) / np.maximum(norm, 1e-12)
                    near = (cosine >= settings.cosine * covered[i]) & (norm >= 0.5 * norms[i] * covered[i])
                    b, i, c = b[near], i[near], cosine[near]
                    if not len(b):
                        continue
                    new = np.ones(len(b), bool)
                    new[1:] = (b[1:] != b[:-1] + 1) | (i[1:] != i[:-1]) | (row_of[b[1:]] != row_of[b[:-1]])
                    at = first[row_of[b]] + (b - begin[row_of[b]]) * BLOCK
                    yield row_of[b], i, at, at + n * BLOCK, c, new

    def confirm(best: dict, words: np.ndarray, bounds: tuple[int, int], r: int, i: int, lows: list[int], width: int, cosines: list[float] | None) -> None:
        """Hold all windows (first words, ascending, and width) of a run against an item; the best is kept."""
        length, (begin, end) = int(lengths[i]), bounds
        for k in range(0, len(lows), TOGETHER):
            some = lows[k : k + TOGETHER]
            # No window has a longer common subsequence than what holds them all.
            if len(some) > 1 and common_subsequence(masks[i], length, words[max(begin, some[0]) : min(end, some[-1] + width)]) / length < settings.overlap:
                continue
            for n, low in enumerate(some, k):
                if (r, i) in best and best[r, i][3] == 1:
                    return
                low, high = max(begin, low), min(end, low + width)
                part = words[low:high]
                share = common_subsequence(masks[i], length, part) / length
                if share >= settings.overlap and ((r, i) not in best or share > best[r, i][3]):
                    answer = common_subsequence(answers[i], tails[i], part) / tails[i]
                    if answer >= settings.answer:
                        if cosines is None:
                            vector = space[part].sum(axis=0)
                            cosine = float(vector @ units[i] / max(np.linalg.norm(vector), 1e-12))
                        else:
                            cosine = cosines[n]
                        best[r, i] = (low - begin, high - begin, cosine, share, answer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, first in _groups(batches, kind):
            best: dict[tuple[int, int], tuple] = {}
            block, begin = _blocks(first, BLOCK)
            windows = rare.runs(words, np.repeat(np.arange(len(first) - 1), np.diff(first)), reach)
            for *found, new in candidates(words, first, block, begin, windows):
                starts = [*np.flatnonzero(new).tolist(), len(new)]
                rows, which, lows, highs, cosines = (x.tolist() for x in found)
                for a, b in zip(starts[:-1], starts[1:], strict=True):
                    r, i = rows[a], which[a]
                    margin = int(lengths[i]) // 2 + BLOCK
                    confirm(best, words, (int(first[r]), int(first[r + 1])), r, i, [x - margin for x in lows[a:b]], highs[a] - lows[a] + 2 * margin, cosines[a:b])
            for r, i, low, high in zip(*(x.tolist() for x in windows), strict=True):
                if (r, i) not in best or best[r, i][3] < 1:
                    confirm(best, words, (int(first[r]), int(first[r + 1])), r, i, list(range(low, high + 1, BLOCK)), int(reach[i]) + BLOCK - 1, None)
            if best:
                rows, which = zip(*best, strict=True)
                picked = batch.select([0, 1]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(which), *(pa.array(x) for x in zip(*best.values(), strict=True))], ["row", "key", "item", "start", "end", "cosine", "overlap", "answer"])

    return work


def contaminated(frame: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", settings: Settings = Settings()) -> DataFrame:
    """Passages of documents that repeat or paraphrase benchmark items.

    Returns one row for each document row and item: key, item_key, start_word and end_word (of the passage's
    surroundings), cosine, overlap and answer.  Null and empty texts, and items without words, match nothing;
    repeated documents and items match each for itself; an empty corpus or benchmark gives an empty result; other
    columns are not read.

    Texts are read once for each block of items: their words become places in the benchmark's vocabulary (words that no item has can be in
    no common subsequence).  Passages of 64 words fit the latent space; passages about as long as each item, at
    every eighth word, are held against the item there, if an index of each item's rarest words finds enough of these
    nearby (without them no check could succeed).  Each candidate is checked; it counts if the longest common subsequence has
    `overlap` of the item's words and `answer` of its last `answer_share`.  So that nothing depends on the cosine, its
    threshold or the weights, windows of twice an item's length that hold enough of its rarest words are checked the
    same way: the result has every passage, up to that width, that the checks accept.
    """
    spark: SparkSession = frame.sparkSession
    kinds, item_kind = dict(frame.dtypes), dict(benchmark.dtypes)[item_key]
    schema = f"`{key}` {kinds[key]}, `{item_key}` {item_kind}, start_word long, end_word long, cosine double, overlap double, answer double"

    def found(items: Items) -> tuple[DataFrame, DataFrame]:
        """The passages of some items, and the table that they are found in."""
        work, kind = _placed(items.vocabulary)
        placed = materialise(frame.select(F.col(f"`{key}`").alias("key"), F.lower(F.col(f"`{text}`").cast("string")).alias("text")).mapInArrow(trimmed(work), f"row long, key {kinds[key]}, words binary"), "placed")
        space, df = latent_space(placed, kind, len(items.vocabulary), settings)
        rows = placed.mapInArrow(trimmed(_search(kind, items.words, space, df, settings)), f"row long, key {kinds[key]}, item long, start long, end long, cosine double, overlap double, answer double")
        names = spark.createDataFrame([(i, v) for i, v in enumerate(items.ids)], f"item long, item_id {item_kind}")
        return rows.join(F.broadcast(names), "item").select(F.col("key").alias(key), F.col("item_id").alias(item_key), F.col("start").alias("start_word"), F.col("end").alias("end_word"), "cosine", "overlap", "answer"), placed

    def written(items: Items) -> DataFrame:
        rows, placed = found(items)
        out = materialise(rows, "found")
        drop(placed)
        return out

    blocks = Items.blocks(benchmark, item_text, item_key)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return spark.createDataFrame([], schema)
    if second is None:
        return found(first)[0]
    # The results of a block are written before the next, so that the driver holds few blocks at once.
    each = [written(first), written(second)]
    del first, second
    each += [written(items) for items in blocks]
    return reduce(DataFrame.unionByName, each)
