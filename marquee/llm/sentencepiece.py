"""SentencePiece models of merge type: exact encoding by backtracking, and decoding.

A row of pieces is a text's encoding exactly if each piece is its own encoding and
each two neighbours, merged anew from their characters, become these two again.
(The first merge across a border would have the same score and come in the same
order with only its two pieces present; so where no pair merges across, none does.)
Therefore every prefix of a text has one such row, and a search finds the text's:

* An Aho-Corasick automaton over the reversed pieces, run backwards, gives the
  longest piece that begins at each character; shorter ones that begin there are
  its prefixes, by a table.
* The search takes the longest piece that is compatible with the one before it.
  Where none is, the position is marked in a bit field and the last piece is
  replaced by the next shorter one. As the row before a position is the only one,
  a marked position fails whatever leads to it, and each is visited once.
* If no piece holds a space after anything else, no merge crosses the border in
  front of a space: texts are cut there, and recurring parts remembered. So they are
  between a letter and a sign that no piece holds right after a letter.

Characters that are no piece become the pieces of their bytes.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from marquee.llm.common import row_ranges

#: What stands for a space.
SPACE = "▁"
#: What is decoded from a byte that belongs to no character.
NO_CHARACTER = "�"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Entries of the memos of parts and pairs in a Python worker, each of which is emptied
#: when full; parts of more characters are not remembered.
MEMO_PARTS, MEMO_PAIRS, RECALLED = 300_000, 400_000, 48
#: The pairs of a piece of which none is known.
NONE: dict[str, bool] = {}
#: Bytes of text, about, that one output batch is made from.
BATCH_BYTES = 4 * 2**20
#: A model is sent to all executors; this bounds it.
MAX_MODEL_BYTES = 64 * 2**20


class Model:
    """Encodes and decodes by one model file.

    Taken are models of merge type with byte fallback, a space in front of each
    text, text as it is (no normalisation, no white space removed) and no pieces
    defined by users; any other is a ValueError.
    """

    def __init__(self, content: bytes):
        model = proto.ModelProto.FromString(content)
        taken = (
            model.trainer_spec.model_type == proto.TrainerSpec.BPE
            and model.trainer_spec.byte_fallback
            and not model.trainer_spec.treat_whitespace_as_suffix
            and model.normalizer_spec.add_dummy_prefix
            and model.normalizer_spec.escape_whitespaces
            and not model.normalizer_spec.remove_extra_whitespaces
            and not model.normalizer_spec.precompiled_charsmap
            and not model.denormalizer_spec.precompiled_charsmap
            and not any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces)
        )
        if not taken:
            raise ValueError("not a merge-type model with byte fallback and unchanged text")
        self.begin, self.end = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.unknown_surface = model.trainer_spec.unk_surface
        self.names = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == BYTE}
        self.values = {k: value for value, k in self.bytes.items()}
        self._parts: dict[str, bytes] = {}
        self._pairs: dict[str, dict[str, bool]] = {}
        self._known_pairs = 0

    @cached_property
    def surfaces(self) -> list[str]:
        """What each id stands for by itself; control pieces and bytes of longer characters have no text."""
        of = {
            NORMAL: lambda k: self.names[k],
            UNKNOWN: lambda k: self.unknown_surface,
            BYTE: lambda k: chr(self.values[k]) if self.values[k] < 128 else "",
        }
        return [of[kind](k) if kind in of else "" for k, kind in enumerate(self.kinds)]

    @cached_property
    def special(self) -> frozenset[int]:
        """Ids whose text depends on others: bytes of longer characters, and what is put for unknown pieces."""
        return frozenset(k for k, kind in enumerate(self.kinds) if kind == UNKNOWN or kind == BYTE and self.values[k] >= 128)

    @cached_property
    def made(self) -> set[str]:
        """The pieces that merges make out of their characters; others never occur."""
        return {p for p in self.ids if len(p) == 1 or self.merged(p) == [p]}

    @cached_property
    def shorter(self) -> dict[str, str | None]:
        """For each piece the longest other one that it begins with."""
        made = self.made
        return {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in made), None) for p in made}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds pieces in reversed texts, the longest of those that end at a place first."""
        automaton = ahocorasick.Automaton()
        for piece in self.made:
            automaton.add_word(piece[::-1], piece)
        automaton.make_automaton()
        return automaton

    @cached_property
    def letters(self) -> str:
        """The letters in pieces."""
        return "".join(sorted({c for p in self.ids for c in p if c.isalpha()}))

    @cached_property
    def apart(self) -> str:
        """Signs that no piece holds right after a letter, so that no merge joins them to one."""
        after = {b for p in self.ids for a, b in zip(p, p[1:]) if a in self.letters}
        return "".join(sorted({c for p in self.ids for c in p} - after - {SPACE, *self.letters}))

    @cached_property
    def parts(self) -> Callable[[str], list[str]]:
        """Cuts a text where no merge can cross.

        That is in front of spaces, if no piece holds one after anything else, and
        between a letter and a sign of ``apart``.
        """
        if any(SPACE in p.lstrip(SPACE) for p in self.made):
            return lambda text: [text]
        if not self.letters:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        letters, apart = f"[{self.letters}]", re.escape(self.apart)
        other = f"[^{SPACE}{self.letters}]*+"
        going_on = f"(?:{other}{letters}++(?=[^{SPACE}{apart}]))*+"  # what follows its letters may be joined to them
        return re.compile(rf"(?!\Z){SPACE}*+{going_on}{other}{letters}*+").findall

    def merged(self, text: str) -> list[str]:
        """Merges neighbours of the highest score, the leftmost of equals, until none is left."""
        scores, parts = self.scores, list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether two pieces side by side are what their characters merge to."""
        known = self._pairs.get(left, NONE).get(right)
        if known is None:
            known = self.merged(left + right) == [left, right]
            if self._known_pairs >= MEMO_PAIRS:
                self._pairs.clear()
                self._known_pairs = 0
            self._pairs.setdefault(left, {})[right] = known
            self._known_pairs += 1
        return known

    def searched(self, text: str) -> list[str]:
        """The pieces of a text without cuts, by backtracking."""
        size, last = len(text), len(text) - 1
        # The longest piece that begins at each character, by its distance from the end.
        longest = dict([*self.automaton.iter(text[::-1])][::-1]).get
        compatible, shorter, pairs = self.compatible, self.shorter.get, self._pairs.get
        failed = bytearray(size // 8 + 1)
        row: list[str] = []
        at, piece, allowed = 0, longest(last) or text[0], anything
        while at < size:
            while piece is not None:
                known = allowed(piece)
                if known is None:
                    known = compatible(row[-1], piece)
                if known:
                    end = at + len(piece)
                    if not failed[end >> 3] >> (end & 7) & 1:
                        break
                piece = shorter(piece)
            if piece is not None:
                row.append(piece)
                at = end
                if at < size:
                    allowed = pairs(piece, NONE).get
                    piece = longest(last - at) or text[at]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                back = row.pop()  # never empty: the first piece of the encoding does not fail
                at -= len(back)
                allowed = pairs(row[-1], NONE).get if row else anything
                piece = shorter(back)
        return row

    def part(self, text: str) -> bytes:
        """The ids of a part that no merge leaves, as little-endian words."""
        ids: list[int] = []
        for piece in [text] if text in self.made else self.searched(text):
            known = self.ids.get(piece)
            if known is None:
                ids += [self.bytes[b] for b in piece.encode()]
            else:
                ids.append(known)
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(text) <= RECALLED:
            if len(self._parts) >= MEMO_PARTS:
                self._parts.clear()
            self._parts[text] = out
        return out

    def packed(self, text: str) -> bytes:
        """The ids of a whole text, without begin and end, as little-endian words."""
        if not text:
            return b""
        known, part = self._parts.get, self.part
        return b"".join([known(p) or part(p) for p in self.parts(SPACE + text.replace(" ", SPACE))])

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, without begin and end."""
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of any ids.

        Begin, end and other control pieces have no text; bytes that are no
        character give a replacement character each; the space in front goes.
        """
        surfaces, kinds = self.surfaces, self.kinds
        if self.special.isdisjoint(ids):
            return "".join([surfaces[k] for k in ids]).removeprefix(SPACE).replace(SPACE, " ")
        out: list[str] = []
        held = bytearray()
        for k in ids:
            if kinds[k] == BYTE:
                held.append(self.values[k])
                continue
            if held:
                out.append(characters(bytes(held)))
                held.clear()
            if not out:
                # Only a piece at the very start loses the space that was put in front.
                if surfaces[k]:
                    out.append(surfaces[k].removeprefix(SPACE) if kinds[k] == NORMAL else surfaces[k])
            else:
                out.append(surfaces[k])
        if held:
            out.append(characters(bytes(held)))
        return "".join(out).replace(SPACE, " ")


def anything(_piece: str) -> bool:
    """What may stand first in a text."""
    return True


def characters(data: bytes) -> str:
    """UTF-8 read as far as it goes; each byte that is no part of a character is replaced."""
    try:
        return data.decode()
    except UnicodeDecodeError as error:
        good = data[: error.start].decode()
        return good + NO_CHARACTER + characters(data[error.start + 1 :])


_LOADED: dict[int, Model] = {}


def _model(content: bytes) -> Model:
    """The model of a Python worker, made once and kept with its memos."""
    key = zlib.crc32(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Model(content)
    return _LOADED[key]


def _shared(rows: DataFrame, path: str):
    with open(path, "rb") as file:
        content = file.read(MAX_MODEL_BYTES + 1)
    if len(content) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return rows.sparkSession.sparkContext.broadcast(content)


def _without(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c.lower() != name])


def encode(docs: DataFrame, model_path: str, text: str = "text", packed: str | None = None) -> DataFrame:
    """``docs`` with ``ids array<int>``: begin, the pieces of each whole text, end.

    NULL counts as empty; an empty text has begin and end only. ``packed`` names a
    further column for the same ids as little-endian unsigned 32-bit words, one after
    the other. Other columns stay as they are, those of the new names are replaced.
    No shuffle: rows are encoded where they are.
    """
    shared = _shared(docs, model_path)
    new = [T.StructField("ids", T.ArrayType(T.IntegerType()))] + ([T.StructField(packed, T.BinaryType())] if packed else [])
    rows = docs
    for field in new:
        rows = _without(rows, field.name)
    at = rows.columns.index(text)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        begin, end = struct.pack("<I", model.begin), struct.pack("<I", model.end)
        for batch in stream:
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0), np.int64)
            for start, stop in row_ranges(sizes, BATCH_BYTES):
                part = batch.slice(start, stop - start)
                found = [begin + model.packed(value.as_py() or "") + end for value in part.column(at)]
                ends = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
                ids = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
                columns += [pa.array(found, pa.binary())] if packed else []
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *(f.name for f in new)])

    return rows.mapInArrow(batches, T.StructType([*rows.schema.fields, *new]))


def decode(tokens: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded string``, the text of each row's ids.

    NULL and empty rows decode to an empty text. An id that the model does not
    have is an error.
    """
    shared = _shared(tokens, model_path)
    rows = _without(tokens, "decoded")
    at = rows.columns.index(ids)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for batch in stream:
            sizes = 4 * np.asarray(pa.compute.fill_null(pa.compute.list_value_length(batch.column(at)), 0), np.int64)
            for start, stop in row_ranges(sizes, BATCH_BYTES):
                part = batch.slice(start, stop - start)
                decoded = [
                    model.decode(value.values.to_numpy(zero_copy_only=False).tolist() if value.is_valid else [])
                    for value in part.column(at)
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.string())], [*part.schema.names, "decoded"])

    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(batches, schema)
