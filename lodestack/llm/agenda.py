"""Many short segments merged at once, each by its own score-ordered agenda of adjacent symbol pairs.

A segment is a row of a matrix.  Its agenda is the row of levels of its open pairs (0 for the best score): each round
takes the best pair of every row, the leftmost among equals, merges it, and opens the pairs that the new symbol makes
with its neighbours.  Rows without open pairs are done.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np

#: The level of a pair that makes no piece.
NEVER = np.int32(1 << 30)
#: Segments up to so many characters are merged in matrices of that width; longer ones elsewhere.
WIDTHS = (8, 16, 32)
#: Cells of a matrix worked on at once.
MOST_CELLS = 1 << 17


class PairTable:
    """A fixed map from 64-bit keys to numbers, looked up for whole arrays: hash tables for what collides above."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.tables: list[tuple[np.uint64, np.uint64, np.ndarray, np.ndarray]] = []
        factor = 0x9E3779B97F4A7C15
        while len(keys):
            bits = max(4, int(len(keys) * 8).bit_length())
            slots = (keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(64 - bits)
            _, first = np.unique(slots, return_index=True)
            held, given = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
            held[slots[first]], given[slots[first]] = keys[first], values[first]
            self.tables.append((np.uint64(factor), np.uint64(64 - bits), held, given))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, factor = keys[rest], values[rest], (factor * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the keys; -1 for those that the map doesn't have."""
        out = np.full(len(keys), -1, np.int32)
        wide = keys.view(np.uint64)
        for factor, shift, held, given in self.tables:
            slots = (wide * factor >> shift).view(np.int64)
            hit = held[slots] == keys
            out[hit] = given[slots[hit]]
        return out


class Agenda:
    """Merges for a vocabulary: `levels` ranks each piece by its score, best first, `ids` numbers them."""

    def __init__(self, ids: Mapping[str, int], levels: Mapping[str, int]):
        letters = sorted({c for p in ids for c in p} - set(ids))
        self.count = 1 + max(ids.values())
        number = {**ids, **{c: self.count + k for k, c in enumerate(letters)}}
        self.total = self.count + len(letters)
        #: The symbol of each character; -1 if no piece has it.
        self.symbol = np.full(0x110000, -1, np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i
        #: The level of each symbol as the outcome of a merge; the last one answers for -1.
        self.level = np.full(self.total + 1, NEVER, np.int32)
        keys, made = [], []
        for p, i in ids.items():
            self.level[i] = levels[p]
            for k in range(1, len(p)):
                if (a := number.get(p[:k])) is not None and (b := number.get(p[k:])) is not None:
                    keys.append(a * self.total + b)
                    made.append(i)
        self.pairs = PairTable(np.array(keys, np.int64), np.array(made, np.int32))

    def _made(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What adjacent symbols make: the piece's number or -1."""
        keys = a.astype(np.int64) * self.total + b
        keys[(a < 0) | (b < 0)] = -2
        return self.pairs(keys)

    def _matrix(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
        """Merge segments of at most `width` characters; a row's symbols, -1 unknown characters, -2 nothing."""
        n, wide = len(starts), width + 1  # the last column is never a symbol
        inside = np.arange(wide) < lengths[:, None]
        symbols = np.full((n, wide), -1, np.int32)
        at = np.minimum(starts[:, None] + np.arange(wide), len(points) - 1)
        symbols[inside] = self.symbol[points[at[inside]]]
        made = np.full((n, wide), -1, np.int32)
        made[:, :-1] = self._made(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, width)
        level = self.level[made]
        after = np.broadcast_to(np.arange(1, wide + 1, dtype=np.int16), (n, wide)).copy()
        before = np.broadcast_to(np.arange(-1, wide - 1, dtype=np.int16) % wide, (n, wide)).astype(np.int16)
        after[np.arange(n), lengths - 1] = width
        symbols[~inside] = -2
        symbols[:, width] = -1
        flat, made, after, before = symbols.ravel(), made.ravel(), after.ravel(), before.ravel()
        level_flat = level.ravel()
        live = np.arange(n)
        while len(live):
            held = level[live] if len(live) < n else level
            place = held.argmin(axis=1)
            row = live * wide
            here = row + place
            open_ = level_flat[here] < NEVER
            if not open_.all():
                live, row, place, here = live[open_], row[open_], place[open_], here[open_]
                if not len(live):
                    break
            new = made[here]
            gone = row + after[here]
            right_place = after[gone]
            right, left = row + right_place, row + before[here]
            flat[here], flat[gone] = new, -2
            level_flat[gone] = NEVER
            after[here] = right_place
            before[right] = place
            both = self._made(np.concatenate([new, flat[left]]), np.concatenate([flat[right], new]))
            made[here], made[left] = both[: len(new)], both[len(new) :]
            level_flat[here], level_flat[left] = self.level[made[here]], self.level[made[left]]
        symbols[:, width] = -2
        return symbols

    def merge(self, segments: Sequence[str], kind: str) -> list[bytes | None]:
        """The packed ids of each segment's pieces; None for a segment that has a symbol that is no piece, or is too long."""
        out: list[bytes | None] = [None] * len(segments)
        size = np.dtype(kind).itemsize
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        low = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            step = MOST_CELLS // (width + 1)
            for k in range(0, len(chosen), step):
                part = chosen[k : k + step]
                symbols = self._matrix(points, starts[part], lengths[part], width)
                kept = symbols != -2
                ends = np.cumsum(kept.sum(axis=1)) * size
                ids = symbols[kept].astype(kind).tobytes()
                odd = (symbols == -1) | (symbols >= self.count)
                good = ~odd.any(axis=1)
                bounds = ends.tolist()
                begin = 0
                for i, end, fine in zip(part.tolist(), bounds, good.tolist(), strict=True):
                    if fine:
                        out[i] = ids[begin:end]
                    begin = end
        return out
