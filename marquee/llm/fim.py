"""Fill-in-middle: a text cut into prefix, middle and suffix and put in another order.

Cuts fall on unit ends: a unit is a word with the white space before it, or the
white space at a text's end. Units are neither split nor listed. The texts of a
batch lie one after the other in one Arrow buffer, which is viewed as 64-bit words:

* White space and the last byte of each unit are marked by arithmetic on eight
  bytes at once. All white space is ASCII, so UTF-8 needs no decoding.
* ``bitwise_count`` gives the marks of each word, their running sum those before it.
* The k-th unit of a text is the running sum's first word that reaches the text's
  own rank plus k, and in that word the first byte whose prefix sum of marks,
  made by one multiplication, reaches what is left.

Code points are counted in the same way, by marks on the first byte of each. The
pieces are put together and taken apart by Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import row_ranges, spare

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are rearranged, and of 100 of these so many suffix first.
FIM_RATE, SPM_RATE = 50, 80
#: Bytes of text, about, that are looked at together; a longer text is alone.
BLOCK_BYTES = 4 * 2**20


def _each(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


ONE, LOW7, HIGH = _each(0x01), _each(0x7F), _each(0x80)
B8, B56 = np.uint64(8), np.uint64(56)


def white(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is 0x20 or 0x09 to 0x0D."""
    apart = words ^ _each(0x20)
    space = ~(((apart & LOW7) + LOW7) | apart) & HIGH
    low = words & LOW7
    control = (low + _each(0x80 - 0x09)) & ~(low + _each(0x80 - 0x0E)) & ~words & HIGH
    return space | control


def unit_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is not white while the next one is."""
    gaps = white(words)
    following = np.append(gaps[1:], HIGH)  # beyond the end all is white
    return ~gaps & ((gaps >> B8) | (following << B56)) & HIGH


def first_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that begins a code point."""
    return (~words | (words << np.uint64(1))) & HIGH


class Marks:
    """Marked bytes of a buffer: how many lie before a place, and where the k-th is."""

    def __init__(self, marked: np.ndarray):
        self.marked = marked
        self.sums = np.concatenate([[0], np.cumsum(np.bitwise_count(marked), dtype=np.int64)])

    def before(self, places: np.ndarray) -> np.ndarray:
        """Marks on the bytes in front of each place."""
        word, byte = places >> 3, (places & 7).astype(np.uint64)
        own = np.append(self.marked, np.uint64(0))[word] & ((np.uint64(1) << (byte * B8)) - np.uint64(1))
        return self.sums[word] + np.bitwise_count(own)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The place of the mark of each rank, from 1."""
        word = np.searchsorted(self.sums, ranks, side="left") - 1
        rest = (ranks - self.sums[word]).astype(np.uint64)
        upto = (self.marked[word] >> np.uint64(7)) * ONE  # byte k: marks on the bytes 0 to k
        reached = ((upto | HIGH) - rest * ONE) & HIGH
        return 8 * word + 8 - np.bitwise_count(reached).astype(np.int64)


def cut_places(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """(units, code points before the first cut, and between both) of each text.

    ``data``: the bytes of all texts, text k from ``offsets[k]`` to ``offsets[k + 1]``.
    The cuts are after ``first % (units + 1)`` and ``second % (units + 1)`` units,
    the smaller one first.
    """
    size = int(offsets[-1])
    padded = np.full((size + 7) // 8 * 8, 0x20, np.uint8)
    padded[:size] = data[:size]
    words = padded.view("<u8")
    ends = unit_ends(words)
    starts, stops = offsets[:-1], offsets[1:]
    # A text's last byte ends a unit, white or not, whatever text comes next.
    last = stops[stops > starts] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7).astype(np.uint64) * B8))
    units, points = Marks(ends), Marks(first_bytes(words))
    base = units.before(starts)
    n = units.before(stops) - base
    low, high = np.sort([first % (n + 1), second % (n + 1)], axis=0)

    def place(count: np.ndarray) -> np.ndarray:
        out = starts.copy()
        some = count > 0
        out[some] = units.select((base + count)[some]) + 1
        return out

    at = [points.before(p) for p in (starts, place(low), place(high))]
    return n, at[1] - at[0], at[2] - at[1]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string array's bytes and offsets from 0; NULL has no bytes."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    own = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[own[0] : own[-1]], own - own[0]


CUTS = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "prefix_chars", "middle_chars")])


@F.arrow_udf(CUTS)
def cuts(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Units of each text, and code points of its prefix and middle, by two random numbers."""
    for text, first, second in columns:
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(text), 0), np.int64)
        for start, stop in row_ranges(sizes, BLOCK_BYTES):
            data, offsets = _buffers(text.slice(start, stop - start))
            drawn = (np.asarray(c.slice(start, stop - start), np.int64) for c in (first, second))
            for column, value in zip(found, cut_places(data, offsets, *drawn)):
                column.append(value)
        fields = [pa.array(np.concatenate(c), pa.int64()) for c in found]
        yield pa.StructArray.from_arrays(fields, names=CUTS.names)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the hash of "seed:key"; a NULL key counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def rearrange(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``form`` is plain (the text as it is), psm or spm; it follows from the seed and
    the key alone, so that repeated rows come out equal. Texts that are NULL (they
    count as empty), empty, or hold a marker stay plain, and plain ones have NULL
    ``prefix_chars`` and ``middle_chars``. Columns of these names are replaced, all
    others kept. No shuffle: rows are cut where they are.
    """
    new = ["n", "form", "prefix_chars", "middle_chars", "output"]
    own = [c for c in docs.columns if c.lower() not in new]
    of, at, shape = (spare(docs.columns + new, f"_{k}") for k in ("of", "cuts", "shape"))
    h1, h2, h3, h4 = draws(F.col(key), seed)
    body = F.col(of)
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | body.contains(marker)
    rows = docs.withColumn(of, F.coalesce(F.col(text), F.lit(""))).withColumns({
        at: cuts(body, h1, h2),
        shape: F.when((body == "") | marked | (h3 % 100 >= fim_rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm"),
    })
    before, between = F.col(at)["prefix_chars"], F.col(at)["middle_chars"]
    after = before + between
    prefix = F.substring(body, F.lit(1), before.cast("int"))
    middle = F.substring(body, (before + 1).cast("int"), between.cast("int"))
    suffix = F.substring(body, (after + 1).cast("int"), F.length(body))
    moved = F.col(shape) != "plain"
    return rows.select(
        *own,
        F.col(at)["n"].alias("n"),
        F.col(shape).alias("form"),
        F.when(moved, before).alias("prefix_chars"),
        F.when(moved, between).alias("middle_chars"),
        F.when(F.col(shape) == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col(shape) == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(body)
        .alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that was rearranged. Its pieces hold no marker, nor do markers overlap with them."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
