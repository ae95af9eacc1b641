"""Elias-Fano sequences and an n-gram trie made of them, over numpy buffers.

A trie is one byte string. Opened over a memory map, a query touches only the
pages that its binary searches need.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

#: Every so many values the place of their high bits is noted.
SAMPLE = 32
#: Values of a level, at most, that a process decodes as a whole to search it.
DECODED = 2**24
#: Values whose low bits are packed together; a multiple of 8.
BLOCK = 2**16
_POPCOUNT = np.array([bin(k).count("1") for k in range(256)], np.uint8)


def _select_in_byte() -> np.ndarray:
    """[byte, k]: place of its k-th set bit."""
    table = np.zeros((256, 8), np.uint8)
    for byte in range(256):
        places = [k for k in range(8) if byte >> k & 1]
        table[byte, : len(places)] = places
    return table


_SELECT = _select_in_byte()
_EIGHT = np.arange(8)


@dataclass
class EliasFano:
    """A non-decreasing sequence of integers below ``universe``, with random access.

    The low bits of each value are packed; the high bits are a bit row in which
    value k with high part h sets bit h + k.
    """

    n: int
    low_bits: int
    lows: np.ndarray
    highs: np.ndarray
    samples: np.ndarray
    _marks: np.ndarray | None = None
    _decoded: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, (max(1, int(universe)) // max(1, n)).bit_length() - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        places = high + np.arange(n)
        marked = np.zeros(8 * ((int(places[-1]) if n else 0) // 8 + 17), np.uint8)
        marked[places] = 1
        bits = np.packbits(marked, bitorder="little")
        lows = np.zeros((n * low_bits + 7) // 8 + 8, np.uint8)
        for k in range(0, n if low_bits else 0, BLOCK):
            part = values[k : k + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
            packed = np.packbits(np.unpackbits(part, axis=1, count=low_bits, bitorder="little"), bitorder="little")
            lows[k * low_bits // 8 :][: len(packed)] = packed
        return cls(n, low_bits, lows, bits, places[::SAMPLE].astype(np.uint64))

    def take(self, at: np.ndarray) -> np.ndarray:
        """The values at these places."""
        at = np.asarray(at, np.int64)
        place = self.samples[at // SAMPLE].astype(np.int64)
        byte = place >> 3
        # Set bits to skip, counted from the start of the sample's byte; eight bytes at a time.
        skip = at % SAMPLE + _POPCOUNT[self.highs[byte] & ((1 << (place & 7)) - 1).astype(np.uint8)]
        out = np.empty(len(at), np.int64)
        active = np.arange(len(at))
        while len(active):
            row = self.highs[byte[active][:, None] + _EIGHT]
            upto = np.cumsum(_POPCOUNT[row], axis=1, dtype=np.int64)
            found = upto[:, -1] > skip[active]
            after = active[~found]
            skip[after] -= upto[~found, -1]
            byte[after] += 8
            here, row, upto = active[found], row[found], upto[found]
            k = (upto <= skip[here][:, None]).sum(1)
            rows = np.arange(len(here))
            rest = skip[here] - np.where(k > 0, upto[rows, np.maximum(k - 1, 0)], 0)
            out[here] = (byte[here] + k << 3) + _SELECT[row[rows, k], rest]
            active = after
        place = out
        return ((place - at).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)

    def decoded(self) -> np.ndarray:
        """The whole sequence, kept: for many searches in one process."""
        if self._decoded is None:
            self._decoded = self.all()
        return self._decoded

    def marks(self) -> np.ndarray:
        """Every SAMPLE-th value, to begin searches with."""
        if self._marks is None:
            self._marks = self.take(np.arange(0, self.n, SAMPLE))
        return self._marks

    def successor(self, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the first values from ``low`` to before ``high`` that are not smaller; else ``high``."""
        block = np.searchsorted(self.marks(), wanted, "left")
        start, end = np.maximum(low, (block - 1) * SAMPLE), np.minimum(high, block * SAMPLE)
        low, high = np.minimum(start, high), np.maximum(end, np.minimum(start, high))
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            smaller = self.take(middle) < wanted[open_]
            low[open_[smaller]] = middle[smaller] + 1
            high[open_[~smaller]] = middle[~smaller]
            open_ = open_[low[open_] < high[open_]]
        return low

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        start = at * self.low_bits
        byte, shift = start >> 3, (start & 7).astype(np.uint64)
        # Eight bytes from each byte on hold 57 bits whatever the shift.
        word = np.ndarray(len(self.lows) - 7, "<u8", np.ascontiguousarray(self.lows), 0, (1,))[byte] >> shift
        if self.low_bits > 57:
            over = np.flatnonzero(shift)
            word[over] |= self.lows[byte[over] + 8].astype(np.uint64) << (np.uint64(64) - shift[over])
        return word & np.uint64((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """The whole sequence, in one pass."""
        places = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        at = np.arange(self.n, dtype=np.int64)
        return ((places - at).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(at)

    def to_bytes(self) -> bytes:
        head = struct.pack("<5q", self.n, self.low_bits, len(self.lows), len(self.highs), len(self.samples))
        return head + self.samples.astype("<u8").tobytes() + self.lows.tobytes() + self.highs.tobytes()

    @classmethod
    def opened(cls, buffer: np.ndarray, start: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at a byte of a buffer, and where it ends."""
        n, low_bits, n_lows, n_highs, n_samples = struct.unpack("<5q", buffer[start : start + 40].tobytes())
        a = start + 40
        b = a + 8 * n_samples
        c = b + n_lows
        d = c + n_highs
        samples = np.frombuffer(buffer[a:b].tobytes(), "<u8")
        return cls(n, low_bits, buffer[b:c], buffer[c:d], samples), d


class NgramTrie:
    """N-grams of word ids with a code each, in one level per word.

    A level lists each node's successors, node after node, as one monotone
    sequence: the parent's rank times ``base`` plus the word. Relative to its
    context a successor is thus a small number. Pointers, monotone too, say where
    a node's successors begin.
    """

    def __init__(self, base: int, levels: list[EliasFano], pointers: list[EliasFano], codes: np.ndarray):
        self.base, self.levels, self.pointers, self.codes = base, levels, pointers, codes

    @classmethod
    def of(cls, grams: np.ndarray, codes: np.ndarray, base: int) -> NgramTrie:
        """Of distinct n-grams in ascending order, one per row, words below ``base``."""
        n, order = grams.shape
        parents, levels, pointers = np.zeros(n, np.int64), [], []
        above = 1
        for k in range(order):
            keys = parents * base + grams[:, k]
            new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
            nodes, ranks = keys[new], np.cumsum(new) - 1
            levels.append(EliasFano.of(nodes, above * base))
            if k:
                starts = np.searchsorted(nodes, np.arange(above + 1) * base)
                pointers.append(EliasFano.of(starts, len(nodes) + 1))
            parents, above = ranks.astype(np.int64), len(nodes)
        return cls(base, levels, pointers, np.asarray(codes, np.uint16))

    def find(self, grams: np.ndarray, decode_up_to: int = DECODED) -> np.ndarray:
        """Ranks of n-grams, -1 for those that are not there.

        A word is searched among its context's successors. Levels of up to
        ``decode_up_to`` values are decoded once and searched in memory, larger
        ones are searched where they lie.
        """
        found = np.zeros(len(grams), np.int64)
        for k, level in enumerate(self.levels):
            at = np.flatnonzero(found >= 0)
            parent, word = found[at], grams[at, k].astype(np.int64)
            wanted = (parent * self.base + word).astype(np.uint64)
            if level.n <= decode_up_to:
                values = level.decoded()
                low = np.searchsorted(values, wanted)
                there = low < level.n
                hit = np.flatnonzero(there)[values[low[there]] == wanted[there]]
                found[at] = -1
                found[at[hit]] = low[hit]
                continue
            if k:
                contexts, of = np.unique(parent, return_inverse=True)
                low = self.pointers[k - 1].take(contexts).astype(np.int64)[of]
                end = self.pointers[k - 1].take(contexts + 1).astype(np.int64)[of]
            else:
                low, end = np.zeros(len(at), np.int64), np.full(len(at), level.n, np.int64)
            low = level.successor(wanted, low, end)
            there = np.flatnonzero(low < end)
            hit = there[level.take(low[there]) == wanted[there]]
            found[at] = -1
            found[at[hit]] = low[hit]
        return found

    def to_bytes(self) -> bytes:
        head = struct.pack("<3q", self.base, len(self.levels), len(self.codes))
        parts = [*self.levels, *self.pointers]
        return head + self.codes.astype("<u2").tobytes() + b"".join(p.to_bytes() for p in parts)

    @classmethod
    def opened(cls, buffer: np.ndarray) -> NgramTrie:
        """Over a buffer of bytes, such as a memory map."""
        base, order, n = struct.unpack("<3q", buffer[:24].tobytes())
        end = 24 + 2 * n
        codes, parts = buffer[24:end].view("<u2"), []
        for _ in range(2 * order - 1):
            part, end = EliasFano.opened(buffer, end)
            parts.append(part)
        return cls(base, parts[:order], parts[order:], codes)
