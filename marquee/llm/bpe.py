"""Byte-level BPE, encoded and decoded up a tree.

Encodings of neighbouring texts form a monoid: a text is halved until a plain
encoder is cheap, and two neighbours are joined by encoding anew only a window
about their border. The window grows until the tokens outside it are proven to
stay: a row of tokens is the encoding of its bytes exactly if each two
neighbours, encoded alone, stay the two tokens that they are. (The first merge
across a border would have the same rank and be found in the same order with
only its two tokens present; so where no pair merges, nothing does.) Pairs
outside the window are known to stay, so only its two ends are looked at.

Decoding concatenates the tokens' bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.common import releasing

#: Bytes that the plain encoder takes at the tree's leaves.
LEAF = 8
#: The rank of what is no token.
NONE = 2**62
#: Leaves and windows of up to so many bytes are remembered: they recur far more
#: often than whole pieces.
RECALLED = 8
#: Entries of each memo in a Python worker, which is emptied when full: what is
#: frequent is back at once, and the rest is not worth its memory.
MEMO = 50_000
#: Bytes of text, about, that one output batch is made from; equal pieces in it are encoded once.
BATCH_BYTES = 16 * 2**20
#: A vocabulary is sent to all executors; this bounds it.
MAX_VOCABULARY_BYTES = 64 * 2**20


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and their ranks, of lines "base64 rank"."""
    pairs = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Vocabulary:
    """Encodes and decodes by one table of ranks. All 256 bytes must be tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._pairs: dict[tuple[int, int], tuple[int, ...]] = {}
        self._short: dict[bytes, tuple[int, ...]] = {}

    def plain(self, data: bytes) -> tuple[int, ...]:
        """Merges the pair of lowest rank, the leftmost of equals, until none is left."""
        ranks = self.ranks
        if len(data) > 48:
            return self._by_heap(data)
        rank_of = ranks.get
        parts = [data[k : k + 1] for k in range(len(data))]
        pairs = [rank_of(data[k : k + 2], NONE) for k in range(len(data) - 1)]  # of each part and the next
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            at = pairs.index(best)
            parts[at] += parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + parts[at], NONE)
            if at < len(pairs):
                pairs[at] = rank_of(parts[at] + parts[at + 1], NONE)
        return tuple([ranks[p] for p in parts])

    def _by_heap(self, data: bytes) -> tuple[int, ...]:
        """The same for a long window, where looking at all pairs again is too slow."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def push(k: int) -> None:
            middle = end[k]
            if middle < n:
                rank = ranks.get(data[k : end[middle]])
                if rank is not None:
                    heapq.heappush(heap, (rank, k, end[middle]))

        for k in range(n - 1):
            push(k)
        while heap:
            _, k, stop = heapq.heappop(heap)
            middle = end[k]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two has changed since
            end[k], end[middle] = stop, 0
            if stop < n:
                before[stop] = k
            push(k)
            if before[k] >= 0:
                push(before[k])
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k : end[k]]])
            k = end[k]
        return tuple(out)

    def window(self, data: bytes) -> tuple[int, ...]:
        """The encoding of a leaf or window, remembered if it is short."""
        if len(data) > RECALLED:
            return self.plain(data)
        found = self._short.get(data)
        if found is None:
            found = self.plain(data)
            if len(self._short) >= MEMO:
                self._short.clear()
            self._short[data] = found
        return found

    def pair(self, left: int, right: int) -> tuple[int, ...]:
        """The encoding of two tokens' bytes."""
        known = self._pairs.get((left, right))
        if known is None:
            known = self.plain(self.tokens[left] + self.tokens[right])
            if len(self._pairs) >= MEMO:
                self._pairs.clear()
            self._pairs[left, right] = known
        return known

    def stays(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        return self.pair(left, right) == (left, right)

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbours' bytes, from their encodings."""
        width = 1
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.pair(left[-1], right[0]) if width == 1 else self.window(self.decode(left[a:] + right[:b]))
            if (a == 0 or self.stays(left[a - 1], window[0])) and (b == len(right) or self.stays(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def encode_bytes(self, data: bytes) -> tuple[int, ...]:
        """Encodes halves and joins them; of no bytes, no tokens."""
        if len(data) <= LEAF:
            return self.window(data)
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    def piece(self, piece: str) -> tuple[int, ...]:
        """One match of the pattern: a token if it is one as a whole, else its encoding."""
        data = piece.encode()
        rank = self.ranks.get(data)
        found = (rank,) if rank is not None else self.encode_bytes(data)
        if len(data) <= 64:
            if len(self._pieces) >= MEMO:
                self._pieces.clear()
            self._pieces[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        """The tokens of a whole text; pieces are encoded apart from each other."""
        known, piece = self._pieces.get, self.piece
        return [rank for p in self.split(text) for rank in (known(p) or piece(p))]

    def encode_all(self, pieces: list[str]) -> pa.ListArray:
        """The tokens of each piece."""
        known, piece = self._pieces.get, self.piece
        flat, ends = array("i"), [0]
        for p in pieces:
            flat.extend(known(p) or piece(p))
            ends.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32), pa.int32()))

    def decode(self, ids: list[int] | tuple[int, ...]) -> bytes:
        """Halves decoded and concatenated."""
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_LOADED: dict[tuple[int, str], Vocabulary] = {}


def _vocabulary(content: bytes, pattern: str) -> Vocabulary:
    """The vocabulary of a Python worker, made once and kept with its memos."""
    key = (zlib.crc32(content), pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(read_ranks(content), pattern)
    return _LOADED[key]


def _shared(docs: DataFrame, ranks_path: str):
    with open(ranks_path, "rb") as file:
        content = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{ranks_path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return docs.sparkSession.sparkContext.broadcast(content)


def _cuts(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Row ranges of about BATCH_BYTES each; a longer row is alone."""
    cuts, start, total = [], 0, 0
    for k, size in enumerate(sizes):
        if total and total + size > BATCH_BYTES:
            cuts.append((start, k))
            start, total = k, 0
        total += int(size)
    if start < len(sizes):
        cuts.append((start, len(sizes)))
    return cuts


def _without(docs: DataFrame, name: str) -> DataFrame:
    return docs.select(*[c for c in docs.columns if c.lower() != name.lower()])


def _ids(texts: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    """The tokens of each text, of which all different pieces are encoded once."""
    pieces, ends = [pa.array([], pa.large_string())], [0]
    for value in texts:
        pieces.append(pa.array(vocabulary.split(value.as_py() or ""), pa.large_string()))
        ends.append(ends[-1] + len(pieces[-1]))
    parts = pa.chunked_array(pieces).dictionary_encode().chunks  # with one dictionary
    del pieces
    tokens = vocabulary.encode_all(parts[0].dictionary.to_pylist()).take(pa.concat_arrays([p.indices for p in parts]))
    return pa.ListArray.from_arrays(tokens.offsets.take(pa.array(ends)), tokens.values)


def _bytes(ids: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    rows = (value.values.to_numpy(zero_copy_only=False).tolist() if value.is_valid else [] for value in ids)
    return pa.array([vocabulary.decode(row) for row in rows], pa.binary())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids array<int>``, the tokens of each whole text.

    NULL and empty texts have no tokens. Other columns stay as they are, one
    named ``ids`` is replaced. No shuffle: rows are encoded where they are.
    With ``decoded`` there is also what ``decode`` gives for the ids, from the same
    task's one Python worker.
    """
    shared = _shared(docs, ranks_path)
    names = ["ids", "decoded"] if decoded else ["ids"]
    rows = reduce(_without, names, docs)
    at = rows.columns.index(text)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value, pattern)
        for batch in stream:
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0))
            for start, stop in _cuts(sizes):
                part = batch.slice(start, stop - start)
                found = [_ids(part.column(at), vocabulary)]
                if decoded:
                    found.append(_bytes(found[0], vocabulary))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, *names])

    kinds = (T.ArrayType(T.IntegerType()), T.BinaryType())
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, kind) for n, kind in zip(names, kinds)]])
    return rows.mapInArrow(releasing(batches), schema)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded binary``, the bytes of each row's tokens.

    NULL and empty rows decode to no bytes. An id that is no token is an error.
    """
    shared = _shared(tokens, ranks_path)
    rows = _without(tokens, "decoded")
    at = rows.columns.index(ids)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value, pattern)
        for batch in stream:
            sizes = 4 * np.asarray(pa.compute.fill_null(pa.compute.list_value_length(batch.column(at)), 0))
            for start, stop in _cuts(sizes):
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, _bytes(part.column(at), vocabulary)], [*part.schema.names, "decoded"])

    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(releasing(batches), schema)
