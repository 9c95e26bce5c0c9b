"""Elias-Fano sequences and a two-level trie of them, queried with numpy arrays."""

from __future__ import annotations

import mmap

import numpy as np

def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each value, one after the other, in 64-bit words."""
    words = np.zeros(len(values) * width // 64 + 2, dtype=np.uint64)
    if width:
        at = np.arange(len(values), dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        over = (at & 63) + width > 64
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


#: Words whose ones are counted together; one number each is kept beside the bits.
BLOCK = 8
#: Queries answered at once, which bounds the memory that they take.
AT_ONCE = 1 << 16
_PLACE_IN_BYTE = np.array(
    [([i for i in range(8) if byte >> i & 1] + [0] * 8)[:8] for byte in range(256)], dtype=np.int64
)


def _step(counts: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column of each row in which the ``rank``-th one (from 0) lies, and its rank within that column."""
    upto = np.cumsum(counts, axis=1, dtype=np.int64)
    column = (upto <= rank[:, None]).sum(axis=1)
    rows = np.arange(len(rank))
    return column, rank - (upto[rows, column] - counts[rows, column])


class Bits:
    """A bit vector in 64-bit words, a multiple of ``BLOCK`` of them, with select over ones and zeros.

    Beside the words, which may be mapped, it holds the number of ones before each block of 512 bits: a
    query finds its block by halving, its word and byte by counting, and its place in the byte in a table.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        ones = np.bitwise_count(words).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        kind = np.uint32 if len(words) < 1 << 26 else np.int64
        self.ones_before = np.concatenate([[0], np.cumsum(ones)]).astype(kind)
        self.zeros_before = (64 * BLOCK * np.arange(len(self.ones_before)) - self.ones_before).astype(kind)
        self.n_zeros = int(self.zeros_before[-1])

    def _select(self, ranks: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        found = np.empty(len(ranks), dtype=np.int64)
        for first in range(0, len(ranks), AT_ONCE):
            rank = ranks[first : first + AT_ONCE].astype(np.int64)
            block = np.searchsorted(before, rank, side="right") - 1
            rank = rank - before[block].astype(np.int64)
            words = self.words.reshape(-1, BLOCK)[block]
            words = ~words if flip else words
            column, rank = _step(np.bitwise_count(words), rank)
            parts = np.ascontiguousarray(words[np.arange(len(rank)), column]).view(np.uint8).reshape(-1, 8)
            byte, rank = _step(np.bitwise_count(parts), rank)
            bit = _PLACE_IN_BYTE[parts[np.arange(len(rank)), byte], rank]
            found[first : first + AT_ONCE] = ((block * BLOCK + column) * 8 + byte) * 8 + bit
        return found

    def one(self, ranks: np.ndarray) -> np.ndarray:
        """Places of the ``ranks``-th ones, from 0."""
        return self._select(ranks, self.ones_before, False)

    def zero(self, ranks: np.ndarray) -> np.ndarray:
        """Places of the ``ranks``-th zeros, from 0."""
        return self._select(ranks, self.zeros_before, True)


class EliasFano:
    """An ascending sequence in about 2 + log2(largest / length) bits an entry.

    The low bits of the entries are stored one after the other. The high bits are a bit vector: a one
    for each entry and a zero where the high part steps up by one. Opening a sequence reads the high bits
    once, for two counts per 512 of them; nothing else is copied out of the buffer.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        self.bits = Bits(high)

    @classmethod
    def of(cls, ascending: np.ndarray) -> EliasFano:
        values = ascending.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(width)).astype(np.int64)
        steps = int(high[-1]) if n else 0
        words = np.zeros((n + steps + 1) // (64 * BLOCK) * BLOCK + BLOCK, dtype=np.uint64)
        places = high + np.arange(n)
        np.bitwise_or.at(words, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
        low = _packed(values & np.uint64((1 << width) - 1), width)
        return cls(n, width, low, words)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if self.width == 0:
            return np.zeros(len(i), dtype=np.uint64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        value |= np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return value & np.uint64((1 << self.width) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Entries at places ``i``."""
        high = (self.bits.one(i) - i).astype(np.uint64)
        return (high << np.uint64(self.width)) | self._low(i)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first entry that is ``values`` or more, and whether it is equal.

        The place is right among the entries that share the value's high part, which a select of zeros
        bounds; their low bits are searched by halving. Without an equal entry the place only says
        where that search ended.
        """
        high = (values >> np.uint64(self.width)).astype(np.int64)
        outside = high >= self.bits.n_zeros
        high = np.where(outside, 0, high)
        # Before the k-th zero (from 0) stand k zeros and the entries of high parts up to k.
        before = np.maximum(high, 1) - 1
        start = np.where(high > 0, self.bits.zero(before) - before, 0)
        stop = self.bits.zero(high) - high
        start = np.minimum(start, self.n)
        stop = np.minimum(stop, self.n)
        wanted = values & np.uint64((1 << self.width) - 1)
        left, right = start.copy(), stop.copy()
        while (busy := np.flatnonzero(left < right)).size:
            middle = (left[busy] + right[busy]) >> 1
            below = self._low(middle) < wanted[busy]
            left[busy[below]] = middle[below] + 1
            right[busy[~below]] = middle[~below]
        inside = (left < stop) & ~outside
        equal = inside.copy()
        equal[inside] = self._low(left[inside]) == wanted[inside]
        return left, equal

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.width, len(self.low), len(self.high)], dtype=np.uint64)
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_buffer(cls, buffer, at: int) -> tuple[EliasFano, int]:
        """The sequence that starts at byte ``at`` of a buffer, without a copy, and where it ends."""
        n, width, low, high = (int(x) for x in np.frombuffer(buffer, np.uint64, 4, at))
        at += 32
        first = np.frombuffer(buffer, np.uint64, low, at)
        second = np.frombuffer(buffer, np.uint64, high, at + 8 * low)
        return cls(n, width, first, second), at + 8 * (low + high)


class PairTrie:
    """Contexts and their successors with a 16-bit code each, read from a buffer.

    The first level holds the contexts and pointers to where their successors begin. In the second,
    the successors of a context are stored relative to it: on top of the last entry of the context
    before, so that the level ascends throughout.
    """

    def __init__(self, buffer):
        self.contexts, at = EliasFano.from_buffer(buffer, 0)
        self.pointers, at = EliasFano.from_buffer(buffer, at)
        self.successors, at = EliasFano.from_buffer(buffer, at)
        self.codes = np.frombuffer(buffer, np.uint16, self.successors.n, at)

    @staticmethod
    def levels(context: np.ndarray, successor: np.ndarray, codes: np.ndarray) -> bytes:
        """Bytes of the trie of distinct pairs in ascending order."""
        start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, int)
        lengths = np.diff(np.append(start, len(context)))
        last = successor[start + lengths - 1] if len(start) else successor[:0]
        base = np.concatenate([[0], np.cumsum(last, dtype=np.uint64)[:-1]]).astype(np.uint64) if len(start) else last
        parts = (
            EliasFano.of(context[start]),
            EliasFano.of(np.append(start, len(context))),
            EliasFano.of(successor + np.repeat(base, lengths)),
        )
        return b"".join(p.to_bytes() for p in parts) + codes.astype(np.uint16).tobytes()

    @classmethod
    def mapped(cls, levels: bytes) -> PairTrie:
        """The trie in a memory map of its own, which belongs to no file and goes with the last use."""
        area = mmap.mmap(-1, len(levels))
        area.write(levels)
        return cls(area)

    @classmethod
    def from_file(cls, path: str) -> PairTrie:
        """The trie of a stored part, mapped from its file."""
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def lookup(self, context: np.ndarray, of_context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Codes of pairs: entry ``i`` asks for ``successor[i]`` after ``context[of_context[i]]``; 0 if absent."""
        found = np.zeros(len(successor), dtype=np.uint16)
        if not self.contexts.n or not len(successor):
            return found
        place, known = self.contexts.find(context)
        place = np.where(known, place, 0)
        start = self.pointers.access(place).astype(np.int64)
        stop = self.pointers.access(place + 1).astype(np.int64)
        base = np.where(start > 0, self.successors.access(np.maximum(start, 1) - 1), np.uint64(0))
        asked = np.flatnonzero(known[of_context])
        of = of_context[asked]
        at, equal = self.successors.find(successor[asked] + base[of])
        hit = equal & (at >= start[of]) & (at < stop[of])
        # Two contexts can hold equal entries where one ends and the next begins.
        again = np.flatnonzero(equal & ~hit & (at < start[of]))
        if again.size:
            moved = start[of[again]]
            there = self.successors.access(np.minimum(moved, self.successors.n - 1))
            same = (moved < stop[of[again]]) & (there == successor[asked[again]] + base[of[again]])
            at[again[same]] = moved[same]
            hit[again[same]] = True
        found[asked[hit]] = self.codes[at[hit]]
        return found
