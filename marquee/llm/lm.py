"""Scores texts with a bigram model held in Elias-Fano tries.

Words and successions of two words are counted over all training texts and
smoothed by absolute discounting, interpolated with the add-one unigram model.
P(w | v) = (c(v,w) - D) / c(v) + g(v) P(w), with
g(v) = 1 - sum over stored w of (c(v,w) - D) / c(v), sums to one over w.

The most frequent words, a fixed number, get dense ids; every other word has 63
bits of its hash. Ids decide only where a pair is counted, never whether.

Pairs of frequent words are dealt to shards by hash, so that no word's successors
need fit into one place, all others by a rare word in them, which cannot have
many. Each shard's pairs make a trie of monotone levels with quantised
probabilities. Texts are not moved: a task sends each shard the pairs that its
texts hold, once each, with the places where they occur; the shard looks them up
in its memory-mapped trie and answers with one sum per text. The rare words'
counts are asked for in the same way, as words.

Texts are cut into words three times: to count words, to count pairs of either
kind, and to ask for what a score takes. Each time many texts are cut at once.
"""

from __future__ import annotations

import itertools
import math
import tempfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import releasing, row_ranges, stored
from marquee.llm.succinct import EliasFano, NgramTrie

#: Bits of a dense id. 0 is the start of a text, 1 its end, others are words.
BITS = 17
START, END, FIRST = 0, 1, 2
DISCOUNT = 0.75
#: Codes: log10 probabilities from ``LOWEST`` to 0 in equal steps.
LOWEST, CODES = -16.0, 2**16 - 1
#: Tokens whose pairs are sent together, and tokens per group of requests, about.
FLUSH_TOKENS, GROUP_TOKENS = 2_000_000, 8_000_000
#: Shards of the pairs: as many tries, whatever the size of the corpus, so that a
#: text gets as many partial sums at most. Rare words have as many or more.
PAIR_SHARDS = 16
#: Partitions for each group of requests, so that few tasks get several.
SPREAD = 6
#: Flushes whose counts are merged in one task.
FAN_IN = 64
#: The bit that sets hashed ids apart from dense ones, and the seed of Spark's hash.
HASHED, SEED = 2**63, 42
#: Bytes of texts that are cut at once, and of words that are held, about.
CUT_BYTES, FLUSH_BYTES = 2**20, 2**25
#: Bytes that stand between words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, A-Z in lower case, and how many each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    start, ends = int(ends[0]), ends - ends[0]
    data = np.frombuffer(memoryview(data or b"")[start : start + int(ends[-1])].tobytes().lower(), np.uint8)
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    gap = SPACE[data]
    word = ~gap
    first, last = word.copy(), word.copy()
    first[1:] &= gap[:-1]
    last[:-1] &= gap[1:]
    inner = ends[(ends > 0) & (ends < len(data))]  # a text's end is a word's, too
    first[inner], last[inner - 1] = word[inner], word[inner - 1]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[word])])
    return words, np.diff(np.searchsorted(starts, ends))


def _flushes(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(words, how many each text has, rids) of some texts: ``FLUSH_TOKENS`` tokens, about, or one long text.

    Texts are in the first column, rids in the second if there is one.
    """
    held, n, size = [], 0, 0

    def out() -> tuple[pa.Array, np.ndarray, np.ndarray]:
        words, sizes, rids = zip(*held)
        return pa.concat_arrays(words), np.concatenate(sizes), np.concatenate(rids)

    for batch in stream:
        lengths = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
        for start, stop in row_ranges(lengths.astype(np.int64), CUT_BYTES):
            words, sizes = cut(batch.column(0).slice(start, stop - start))
            rids = np.array(batch.column(1).slice(start, stop - start), np.int64) if batch.num_columns > 1 else np.zeros(0, np.int64)
            held.append((words, sizes, rids))
            n, size = n + len(words) + len(sizes), size + words.nbytes
            del words, sizes, rids
            if n > FLUSH_TOKENS or size > FLUSH_BYTES:
                ready = [out()]
                held, n, size = [], 0, 0
                yield ready.pop()
    if held:
        yield out()


@dataclass(frozen=True)
class Model:
    """``words`` (word, c), ``tries`` (shard, trie), ``rest`` (shard, ids, trie: pairs with a
    rare word) and ``kinds`` (id, kinds: of what follows a rare word) are stored tables, the last
    two None if such pairs were not asked for; all else is of fixed size.

    ``head``: words with a count of ``least`` or more in order of their ids; ``counts``: of each id as a
    token (START: as a context); ``back_off``: g(v) of each id, 1 where nothing is
    known.
    """

    words: DataFrame
    tries: DataFrame
    rest: DataFrame | None
    kinds: DataFrame | None
    head: list[bytes]
    counts: np.ndarray
    back_off: np.ndarray
    train_tokens: int
    vocabulary: int
    word_shards: int
    bits: int
    least: int

    def unigram(self, c: np.ndarray) -> np.ndarray:
        """log10 of the add-one probability; an unseen word has the count 0."""
        return np.log10((np.asarray(c, float) + 1) / (self.train_tokens + self.vocabulary + 1))


def _word_counts(train: DataFrame, text: str) -> DataFrame:
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _, _ in _flushes(stream):
            counted = words.value_counts()
            yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], names=["word", "c"])

    parts = train.select(text).mapInArrow(releasing(batches), "word binary, c bigint")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = keys + np.uint64(0x9E3779B97F4A7C15)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed %= np.uint64(shards)
    return mixed.view(np.int64)


def _dealt(keys: np.ndarray, shards: int, bits: int) -> np.ndarray:
    """Keys with their shards above them: in order, these are shard by shard."""
    dealt = _shard_of(keys, shards).view(np.uint64)  # in its place: rows of a flush are long
    dealt <<= np.uint64(2 * bits)
    dealt |= keys
    return dealt


def _by_shard(keys: np.ndarray, shards: int, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its keys, in ascending order of the keys)."""
    dealt = _dealt(keys, shards, bits)
    order = np.argsort(dealt)
    ends = np.searchsorted(dealt, np.arange(shards + 1, dtype=np.uint64) << np.uint64(2 * bits), sorter=order)
    del dealt
    for s in range(shards):
        if ends[s] < ends[s + 1]:
            yield s, order[ends[s] : ends[s + 1]]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of an ascending row and how often each stands there."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def _packed(keys: np.ndarray, bits: int) -> bytes:
    return EliasFano.of(keys, 1 << 2 * bits).to_bytes()


def _split(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second word of packed pairs."""
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64(2**bits - 1)).astype(np.int64)


def _unpacked(data: bytes) -> np.ndarray:
    return EliasFano.opened(np.frombuffer(data, np.uint8))[0].all()


def _squeezed(values: np.ndarray, kind: str) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def _spread(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


@dataclass(frozen=True)
class Flush:
    """The pairs of some texts, text by text, as ids of their words.

    ``of``: the text of each pair; ``spelled``: distinct rare words; ``rare``: the
    rare words' places among these, in order, and ``rare_of`` their texts.
    """

    v: np.ndarray
    w: np.ndarray
    of: np.ndarray
    spelled: pa.Array
    hashed: np.ndarray
    rare: np.ndarray
    rare_of: np.ndarray


def _frequent(flush: Flush, frequent: np.ndarray, bits: int) -> np.ndarray:
    """Packed pairs of frequent words."""
    keys = flush.v[frequent]
    keys <<= bits
    keys |= flush.w[frequent]
    return keys.view(np.uint64)


def _flush(kinds: pa.DictionaryArray, sizes: np.ndarray, head: pa.Array) -> Flush:
    """``kinds``: the words; ``head``: those with dense ids, in their order; others have hashed ids, below zero."""
    dense = pc.fill_null(pc.index_in(kinds.dictionary, head), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    others = np.flatnonzero(dense < 0)
    spelled = kinds.dictionary.take(pa.array(others))
    hashed = (np.array([xxhash.xxh64_intdigest(w, SEED) for w in spelled.to_pylist()], np.uint64) | np.uint64(HASHED)).view(np.int64)
    ids, own = dense + FIRST, np.zeros(len(dense), np.int64)
    ids[others], own[others] = hashed, np.arange(len(others))
    at, of = kinds.indices.to_numpy(), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    # One row of ids with a START before each text and an END at its end: pairs are its neighbours.
    ends = np.cumsum(sizes + 1)
    inner = np.ones(len(of), bool)
    inner[ends - 1] = False  # the last pair of each text, whose second is END
    w = np.full(len(of), END)
    w[inner] = ids[at]
    v = np.empty(len(of) + 1, np.int64)
    v[0], v[1:] = START, w
    v[ends] = START
    rare = np.flatnonzero(w < 0)
    return Flush(v[:-1], w, of, spelled, hashed, own[at[(dense < 0)[at]]], of[rare])


def _hashed_column(word: str) -> Column:
    return F.xxhash64(word).bitwiseOR(F.lit(-HASHED))


def _rare_shard(ids: np.ndarray, shards: int) -> np.ndarray:
    return (ids & (HASHED - 1)) % shards


def _grouped(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, its places)."""
    order = np.argsort(shard, kind="stable")
    names, sizes = _runs(shard[order]) if len(shard) else (shard, [])
    yield from zip(names.tolist(), np.split(order, np.cumsum(sizes)[:-1]) if len(shard) else [])


def _local(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct ids of pairs, the pairs as places among these, and the bits of a place."""
    ids, at = np.unique(np.concatenate([v, w]), return_inverse=True)
    bits = len(ids).bit_length()
    return ids, (at[: len(v)] << bits | at[len(v) :]).astype(np.uint64), bits


def _pairs_of(ids: bytes, keys: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and second ids of pairs that were kept as places."""
    names = _spread(ids, "<i8")
    v, w = _split(_unpacked(keys), len(names).bit_length())
    return names[v], names[w]


PARTS = "rare boolean, shard int, ids binary, keys binary, counts binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of booleans, numbers of shards and bytes."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    types = {"boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds)], names=names)


def _pair_counts(train: DataFrame, text: str, head, shards: int, bits: int, rest_shards: int) -> DataFrame:
    """(rare, shard, ids, keys, counts): pairs of one flush. Those of frequent words have packed keys and
    no ids; those with a rare word (none if there are no ``rest_shards``) are dealt by the first such word."""
    def counted(words: pa.Array, sizes: np.ndarray, _) -> Iterator[pa.RecordBatch]:
        kinds = words.dictionary_encode()
        del words
        flush, rows = _flush(kinds, sizes, head.value), []
        del kinds
        frequent = (flush.v >= 0) & (flush.w >= 0)
        v, w = (flush.v[~frequent], flush.w[~frequent]) if rest_shards else (np.zeros(0, np.int64),) * 2
        keys = _frequent(flush, frequent, bits)
        del flush, frequent
        dealt = _dealt(keys, shards, bits)
        del keys
        dealt.sort()
        ends = np.searchsorted(dealt, np.arange(shards + 1, dtype=np.uint64) << np.uint64(2 * bits))
        for shard in np.flatnonzero(np.diff(ends)).tolist():
            distinct, n = _runs(dealt[ends[shard] : ends[shard + 1]])
            distinct &= np.uint64((1 << 2 * bits) - 1)
            rows.append((False, shard, None, _packed(distinct, bits), _squeezed(n, "<u8")))
        yield _batch(rows, PARTS)
        del dealt, rows[:]
        for shard, at in _grouped(_rare_shard(np.where(v < 0, v, w), max(1, rest_shards))):
            ids, keys, local = _local(v[at], w[at])
            distinct, n = _runs(np.sort(keys))
            rows.append((True, shard, _squeezed(ids, "<i8"), _packed(distinct, local), _squeezed(n, "<u8")))
        yield _batch(rows, PARTS)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return itertools.chain.from_iterable(itertools.starmap(counted, _flushes(stream)))

    return train.select(text).mapInArrow(releasing(batches), PARTS)


def _met(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    """All pairs of some flushes like ``_local``: piece by piece, since ids take several times the memory of places."""
    names, packed = table.column("ids"), table.column("keys")
    ids = np.unique(np.concatenate([_spread(c.as_py(), "<i8") for c in names]))
    bits, pieces = len(ids).bit_length(), []
    for own, keys in zip(names, packed):
        own = np.searchsorted(ids, _spread(own.as_py(), "<i8")).astype(np.uint64)
        v, w = _split(_unpacked(keys.as_py()), len(own).bit_length())
        pieces.append(own[v] << np.uint64(bits) | own[w])
    return ids, np.concatenate(pieces), bits


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([_spread(c.as_py(), "<u8") for c in table.column(name)]).astype(np.int64, copy=False)


def _counted_once(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys)
    distinct, n = _runs(keys[order])
    return distinct, np.add.reduceat(counts[order], np.concatenate([[0], np.cumsum(n)[:-1]]))


CONTEXTS = f"{PARTS}, kinds binary, v array<bigint>, v_kinds array<bigint>, v_follows array<bigint>"


def _contexts(table: pa.Table, shards: int) -> pa.Table:
    """One shard's pairs, counted and dealt on by the second word if that is rare.

    ``kinds``: of what follows each pair's first word, if that is rare: its pairs
    are all in one shard. ``v``, ``v_kinds`` and ``v_follows``: of each first word here.
    """
    ids, keys, bits = _met(table)
    distinct, sums = _counted_once(keys, _numbers(table, "counts"))
    del keys
    v, w = (ids[part] for part in _split(distinct, bits))
    del distinct
    firsts, kinds = _runs(v)
    follows = np.add.reduceat(sums, np.concatenate([[0], np.cumsum(kinds)[:-1]]))
    of_pair, rows, stats = np.repeat(kinds, kinds), [], [firsts, kinds, follows]
    for shard, at in _grouped(_rare_shard(np.where(w < 0, w, v), shards)):
        ids, keys, bits = _local(v[at], w[at])
        order = np.argsort(keys)
        rows.append((True, shard, _squeezed(ids, "<i8"), _packed(keys[order], bits), _squeezed(sums[at][order], "<u8"), _squeezed(of_pair[at][order], "<u8"), *stats))
        stats = [None] * 3
    return _counted(rows)


def _counted(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows))
    types = [pa.bool_(), pa.int32(), *[pa.binary()] * 4, *[pa.list_(pa.int64())] * 3]
    names = ["rare", "shard", "ids", "keys", "counts", "kinds", "v", "v_kinds", "v_follows"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _rest_trie(table: pa.Table, fixed, unigram_of: Callable[[np.ndarray], np.ndarray]) -> pa.Table:
    """One shard's trie: by how much log10 P(w | v) is above log10 g(v) P(w).

    All pairs before a rare word are in its shard, and so is its count.
    """
    context, back_off, unigram = fixed
    ids, keys, bits = _met(table)
    order = np.argsort(keys)
    first, second = _split(keys[order], bits)
    del keys
    counts, kinds = (_numbers(table, name)[order] for name in ("counts", "kinds"))
    del order
    v, w = ids[first], ids[second]
    alone = unigram_of(np.bincount(second, counts, len(ids)))[second]
    alone[w >= 0] = unigram[w[w >= 0]]
    mass = DISCOUNT * kinds
    mass[v >= 0] = (context * back_off)[v[v >= 0]]
    codes = quantised(-np.log10(1 + (counts - DISCOUNT) / (mass * 10.0**alone)))
    trie = NgramTrie.of(np.stack([first, second], 1), codes, 2**bits)
    return pa.table([table.column("shard").slice(0, 1), pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([trie.to_bytes()], pa.binary())], names=["shard", "ids", "trie"])


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of some flushes, in order, and their counts."""
    return _counted_once(np.concatenate([_unpacked(v.as_py()) for v in table.column("keys")]), _numbers(table, "counts"))


def _merged(table: pa.Table, bits: int) -> pa.Table:
    if table.column("rare")[0].as_py():
        return table.select(["rare", "shard", "ids", "keys", "counts"])
    keys, sums = _summed(table)
    row = (False, table.column("shard")[0].as_py(), None, _packed(keys, bits), _squeezed(sums, "<u8"), *[None] * 4)
    return _counted([row]).select(["rare", "shard", "ids", "keys", "counts"])


def _finished(table: pa.Table, bits: int) -> pa.Table:
    """One shard's pairs; of each first word: kinds and tokens of what follows."""
    keys, sums = _summed(table)
    firsts, kinds = _runs(_split(keys, bits)[0])
    follows = np.add.reduceat(sums, np.concatenate([[0], np.cumsum(kinds)[:-1]]))
    whole = (False, table.column("shard")[0].as_py(), None, _packed(keys, bits), _squeezed(sums, "<u8"), None)
    return _counted([(*whole, firsts, kinds, follows)])


def _pairs(parts: DataFrame, flushes: int, bits: int, rest_shards: int) -> DataFrame:
    """Pairs and counts by shard, those of frequent words merged in a tree of ``FAN_IN`` flushes a task."""
    while flushes > FAN_IN:
        flushes = math.ceil(flushes / FAN_IN)
        group = F.when(F.col("rare"), 0).otherwise(F.pmod(F.xxhash64("keys"), F.lit(flushes))).alias("part")
        merged = parts.select("*", group).groupBy("rare", "shard", "part")
        parts = stored(merged.applyInArrow(lambda table: _merged(table, bits), PARTS), "lm-merged")

    def finished(table: pa.Table) -> pa.Table:
        return _contexts(table, rest_shards) if table.column("rare")[0].as_py() else _finished(table, bits)

    return parts.groupBy("rare", "shard").applyInArrow(finished, CONTEXTS)


def smoothed(keys: np.ndarray, counts: np.ndarray, context: np.ndarray, back_off: np.ndarray, unigram: np.ndarray, bits: int) -> np.ndarray:
    """log10 P(w | v) of stored pairs."""
    v, w = _split(keys, bits)
    return np.log10((counts - DISCOUNT) / context[v] + back_off[v] * 10.0 ** unigram[w])


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(logs, LOWEST, 0) / LOWEST) * CODES).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return codes.astype(float) / CODES * LOWEST


def train(rows: DataFrame, text: str = "text", bits: int | None = None) -> Model:
    """A model of all texts of ``rows``; NULL texts are empty and still end.

    The driver gets the most frequent words, fewer than 2**BITS, and one number
    for each of them; words of one count are all among them or none. All pairs are
    counted. Only if ``bits`` is given, pairs are those of the fewer than 2**bits most
    frequent words. Without rows every word has the probability of an unseen one.
    """
    spark, whole = rows.sparkSession, bits is None
    bits = BITS if whole else bits
    words = stored(_word_counts(rows, text), "lm-words")
    texts = rows.count()
    size = words.agg(F.count("*").alias("kinds"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n, kinds = size["n"] + texts, size["kinds"] + (texts > 0)
    # The least count that few enough words reach: one row per distinct count.
    reach = words.groupBy("c").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(W.orderBy(F.desc("c"))))
    least = reach.where(F.col("upto") <= 2**bits - FIRST).agg(F.min("c")).first()[0] or 2**62
    top = sorted(words.where(F.col("c") >= least).collect(), key=lambda r: (-r["c"], bytes(r["word"])))
    head = [bytes(r["word"]) for r in top]
    counts = np.array([texts, texts, *(r["c"] for r in top)], np.int64)
    ids = spark.sparkContext.broadcast(pa.array(head, pa.binary()))
    shards = max(PAIR_SHARDS, math.ceil(n / GROUP_TOKENS))
    rest_shards = shards if whole else 0
    parts = _pair_counts(rows, text, ids, PAIR_SHARDS, bits, rest_shards)
    counted = stored(_pairs(parts, math.ceil(n / FLUSH_TOKENS), bits, rest_shards), "lm-pairs")
    pairs, rest = counted.where(~F.col("rare")), counted.where("rare") if whole else None
    firsts = counted.where("v IS NOT NULL").select(F.inline(F.arrays_zip("v", "v_kinds", "v_follows"))).toDF("v", "kinds", "follows")
    kinds_of = firsts.where("v < 0").select(F.col("v").alias("id"), "kinds") if whole else None
    successors = firsts.where("v >= 0")
    successors = successors.groupBy("v").agg(F.sum("kinds").alias("kinds"), F.sum("follows").alias("follows"))
    back_off = np.ones(len(counts))
    for r in successors.collect():  # one number for each dense id
        back_off[r["v"]] = 1 - (r["follows"] - DISCOUNT * r["kinds"]) / counts[r["v"]]
    model = Model(words, pairs, rest, kinds_of, head, counts, back_off, int(n), int(kinds), shards, bits, least)
    fixed = spark.sparkContext.broadcast((counts, back_off, model.unigram(counts)))

    def tries(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, weights, unigram = fixed.value
        for batch in stream:
            for shard, keys, sums in zip(*(batch.column(k) for k in range(3))):
                keys, sums = _unpacked(keys.as_py()), _spread(sums.as_py(), "<u8")
                codes = quantised(smoothed(keys, sums, context, weights, unigram, bits))
                trie = NgramTrie.of(np.stack(_split(keys, bits), 1), codes, 2**bits)
                yield pa.RecordBatch.from_arrays([pa.array([shard.as_py()], pa.int32()), pa.array([trie.to_bytes()], pa.binary())], names=["shard", "trie"])

    stored_tries = stored(pairs.select("shard", "keys", "counts").mapInArrow(tries, "shard int, trie binary"), "lm-tries")
    if whole:
        total = n + kinds + 1
        built = rest.select("shard", "ids", "keys", "counts", "kinds").groupBy("shard")
        rest = stored(built.applyInArrow(lambda table: _rest_trie(table, fixed.value, lambda c: np.log10((c + 1) / total)), "shard int, ids binary, trie binary"), "lm-rest-tries")
    return replace(model, tries=stored_tries, rest=rest)


def _answers_to(at_rows: np.ndarray, times: np.ndarray, whole: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """``times``, ``places`` and ``rows`` of a request."""
    in_rows, local = np.unique(at_rows, return_inverse=True)
    return _squeezed(times, "<u4"), _squeezed(local, "<u2" if len(in_rows) < 2**16 else "<u4"), whole[in_rows].tobytes()


REQUESTS = "kind int, shard int, ids binary, keys binary, times binary, places binary, rows binary, own binary"
#: Kinds of requests: pairs of frequent words, rare words and pairs with one, and sums that a task knows by itself.
PAIRS, RARE, OWN = range(3)


def _own(flush: Flush, texts: int, fixed) -> np.ndarray:
    """What a task knows of its texts by itself, by text: tokens, those known, base and score; the frequent words."""
    counts, back_off, unigram = fixed
    frequent = flush.w >= 0
    of, w = flush.of[frequent], flush.w[frequent]
    behind_rare = flush.v[frequent] < 0  # no context
    before_rare = ~frequent & (flush.v >= 0)
    alone = np.bincount(of[behind_rare], unigram[w[behind_rare]], texts)
    weight = np.bincount(flush.of[before_rare], np.log10(back_off[flush.v[before_rare]]), texts)
    n, known = np.bincount(flush.of, minlength=texts), np.bincount(of, counts[w] > 0, texts)
    return np.stack([n, known, np.bincount(of, unigram[w], texts), alone + weight])


def _requests(docs: DataFrame, model: Model, ids, fixed) -> DataFrame:
    """(kind, shard, keys, times, places, rows, ..): what the texts of one flush ask of a shard.

    ``keys`` are distinct; ``times`` says how often each occurs, ``places`` in
    which of ``rows``. Keys are pairs of frequent words; rare words (``ids`` is NULL)
    or pairs with one (places among ``ids``), both dealt by the last rare word. Of
    kind OWN there is no question, but sums for ``rows``.
    """
    bits, shards, pairs_too = model.bits, model.word_shards, model.rest is not None

    def asked(words: pa.Array, sizes: np.ndarray, rids: np.ndarray) -> Iterator[pa.RecordBatch]:
        kinds = words.dictionary_encode()
        del words
        flush = _flush(kinds, sizes, ids.value)
        del kinds
        answer = [(OWN, int(rids[0] % shards), *[None] * 4, rids.tobytes(), _own(flush, len(sizes), fixed.value).tobytes())]
        frequent = (flush.v >= 0) & (flush.w >= 0)
        keys, of = _frequent(flush, frequent, bits), flush.of[frequent]
        others = tuple(x[~frequent if pairs_too else slice(0)] for x in (flush.v, flush.w, flush.of))
        # What is asked for later, but not whole rows of pairs.
        spelled_of, hashed, rare, rare_of = flush.spelled, flush.hashed, flush.rare, flush.rare_of
        del flush, frequent
        for s, at in _by_shard(keys, PAIR_SHARDS, bits):
            k, n = _runs(keys[at])
            answer.append((PAIRS, s, None, _packed(k, bits), *_answers_to(of[at], n, rids), None))
        yield _batch(answer, REQUESTS)
        del keys, of, answer[:]
        for s, at in _grouped(_rare_shard(hashed[rare], shards)):
            at = at[np.argsort(rare[at])]
            k, n = _runs(rare[at])
            spelled = b"\n".join(spelled_of.take(pa.array(k)).to_pylist())
            answer.append((RARE, s, None, spelled, *_answers_to(rare_of[at], n, rids), None))
        yield _batch(answer, REQUESTS)
        del answer[:]
        v, w, of = others
        for s, at in _grouped(_rare_shard(np.where(w < 0, w, v), shards)):
            places, keys, local = _local(v[at], w[at])
            order = np.argsort(keys)
            k, n = _runs(keys[order])
            answer.append((RARE, s, _squeezed(places, "<i8"), _packed(k, local), *_answers_to(of[at[order]], n, rids), None))
        yield _batch(answer, REQUESTS)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return itertools.chain.from_iterable(itertools.starmap(asked, _flushes(stream)))

    return docs.mapInArrow(releasing(batches), REQUESTS)


ANSWER = "rid bigint, texts bigint, tokens bigint, known bigint, base double, score double"


def _sums(requests: pa.Table, value_of: Callable[[dict], tuple[np.ndarray | None, ...]]) -> pa.Table:
    """Per row: sums of what ``value_of`` says of the keys of its requests: known, base and score; None: nothing."""
    names, parts = [np.zeros(0, np.int64)], [np.zeros((5, 0))]
    for request in (r for batch in requests.to_batches(1) for r in batch.to_pylist()):
        names.append(np.frombuffer(request["rows"], "<i8"))
        local = _spread(request["places"], "<u2" if len(names[-1]) < 2**16 else "<u4").astype(np.int64)
        times = _spread(request["times"], "<u4").astype(np.int64)
        part = np.zeros((5, len(names[-1])))
        for k, x in enumerate(value_of(request)):
            if x is not None:
                part[2 + k] = np.bincount(local, np.repeat(x, times), len(names[-1]))
        parts.append(part)
    return _added(np.concatenate(names), np.concatenate(parts, axis=1))


def _added(names: np.ndarray, sums: np.ndarray) -> pa.Table:
    """Sums by row; ``sums``: texts, tokens, known tokens, base and score."""
    rids, at = np.unique(names, return_inverse=True)
    sums = [np.bincount(at, x, len(rids)) for x in sums]
    columns = [rids, *(x.astype(np.int64) for x in sums[:3]), *sums[3:]]
    return pa.table([pa.array(x) for x in columns], names=["rid", "texts", "tokens", "known", "base", "score"])


def _own_sums(requests: pa.Table) -> pa.Table:
    names = np.concatenate([np.frombuffer(c.as_py(), "<i8") for c in requests.column("rows")])
    sums = np.concatenate([np.frombuffer(c.as_py()).reshape(4, -1) for c in requests.column("own")], axis=1)
    return _added(names, np.concatenate([np.ones((1, len(names))), sums]))


def _mapped_trie(data: pa.Scalar, file) -> NgramTrie:
    file.write(data.as_buffer())
    file.flush()
    return NgramTrie.opened(np.memmap(file, np.uint8, "r"))


def _pair_sums(tries: pa.Table, requests: pa.Table, fixed, bits: int) -> pa.Table:
    _, back_off, unigram = fixed
    with tempfile.TemporaryFile() as file:
        trie = None
        for value in tries.column("trie"):
            trie = _mapped_trie(value, file)

        def value_of(request: dict) -> tuple[np.ndarray | None, ...]:
            keys = _unpacked(request["keys"])
            v, w = _split(keys, bits)
            logs = np.log10(back_off)[v] + unigram[w]
            if trie is not None:
                rank = trie.find(np.stack([v, w], 1))
                hit = rank >= 0
                logs[hit] = restored(trie.codes[rank[hit]])
            return None, None, logs

        return _sums(requests, value_of)


def _rare_sums(stock: pa.Table, requests: pa.Table, total: int) -> pa.Table:
    """A rare word's own probability and its weight as a context; what stored pairs with one add to these."""
    words = stock.filter(stock.column("word").is_valid())
    spelled = words.column("word").combine_chunks()
    # Behind all words: what is true of one that is not there.
    of_word, kinds = (np.append(words.column(c).to_numpy(), 0).astype(float) for c in ("c", "kinds"))
    base = np.log10((of_word + 1) / total)
    alone = base + np.log10(np.where(kinds > 0, DISCOUNT * kinds / np.maximum(of_word, 1), 1.0))
    with tempfile.TemporaryFile() as file:
        trie = names = None
        for place, value in zip(stock.column("ids"), stock.column("trie")):
            if value.is_valid:
                trie, names = _mapped_trie(value, file), np.frombuffer(place.as_py(), "<i8")

        def value_of(request: dict) -> tuple[np.ndarray | None, ...]:
            if request["ids"] is None:
                asked = pa.array(request["keys"].split(b"\n"), pa.binary())
                at = pc.fill_null(pc.index_in(asked, spelled), len(spelled)).to_numpy(zero_copy_only=False)
                return (of_word[at] > 0).astype(float), base[at], alone[at]
            asked = np.stack(_pairs_of(request["ids"], request["keys"]), 1)
            more = np.zeros(len(asked))
            if trie is not None:
                at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
                there = np.flatnonzero((names[at] == asked).all(1))
                rank = trie.find(at[there])
                more[there[rank >= 0]] = -restored(trie.codes[rank[rank >= 0]])
            return None, None, more

        return _sums(requests, value_of)


def _stock(model: Model) -> DataFrame:
    """What shards answer from: tries, and rare words with their counts."""
    rare = model.words.where(F.col("c") < model.least).withColumn("id", _hashed_column("word"))
    follow = rare.withColumn("kinds", F.lit(0).cast("bigint")) if model.kinds is None else rare.join(model.kinds, "id", "left")
    shard = F.pmod(F.col("id").bitwiseAND(F.lit(HASHED - 1)), F.lit(model.word_shards)).cast("int").alias("shard")
    words = follow.select(F.lit(RARE).alias("kind"), shard, "word", "c", F.coalesce("kinds", F.lit(0)).cast("bigint").alias("kinds"))
    stock = words.unionByName(model.tries.withColumn("kind", F.lit(PAIRS)), allowMissingColumns=True)
    if model.rest is None:
        return stock.withColumn("ids", F.lit(None).cast("binary"))
    return stock.unionByName(model.rest.withColumn("kind", F.lit(RARE)), allowMissingColumns=True)


def _answers(docs: DataFrame, model: Model) -> DataFrame:
    """Partial sums by row."""
    context = docs.sparkSession.sparkContext
    ids = context.broadcast(pa.array(model.head, pa.binary()))
    fixed = context.broadcast((model.counts, model.back_off, model.unigram(model.counts)))
    bits, total = model.bits, model.train_tokens + model.vocabulary + 1

    def answer(key: tuple[pa.Scalar, ...], stock: pa.Table, requests: pa.Table) -> pa.Table:
        kind = key[0].as_py()
        if kind == OWN:
            return _own_sums(requests)
        return _pair_sums(stock, requests, fixed.value, bits) if kind == PAIRS else _rare_sums(stock, requests, total)

    # A shard's requests for frequent pairs are dealt to as many tasks as their number asks for.
    groups = max(1, math.ceil(model.train_tokens / (PAIR_SHARDS * GROUP_TOKENS)))
    pairs = F.col("kind") == PAIRS
    asked = _requests(docs, model, ids, fixed).withColumn("part", F.when(pairs, F.pmod(F.xxhash64("rows"), F.lit(groups))).otherwise(0).cast("int"))
    parts = F.sequence(F.lit(0), F.when(pairs, groups - 1).otherwise(0))
    stock = _stock(model).withColumn("part", F.explode(parts))
    where = ("kind", "shard", "part")
    stock, asked = (rows.repartition(SPREAD * (PAIR_SHARDS * groups + model.word_shards), *where) for rows in (stock, asked))
    return stock.groupBy(*where).cogroup(asked.groupBy(*where)).applyInArrow(answer, ANSWER)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    ``base_score`` is the add-one unigram model's log10 probability, ``score`` the
    bigram model's. NULL and empty texts are one token, the end. Equal rows share
    their identity: what was summed for all of them is divided by their number.
    No rows give no rows; other columns are not looked at.
    """
    doc, whole = F.col(key).cast("bigint"), F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(whole.alias("text"), F.xxhash64(doc, whole).alias("rid"), doc.alias("doc"))
    sums = [F.sum(c).alias(c) for c in ("texts", "tokens", "known", "base", "score")]
    met = rows.select("doc", "rid").join(_answers(rows.select("text", "rid"), model).groupBy("rid").agg(*sums), "rid")
    share = {c: F.col(c) / F.col("texts") for c in ("tokens", "known", "base", "score")}
    return met.select(
        F.col("doc").alias(key),
        share["tokens"].cast("bigint").alias("n_tokens"),
        share["known"].cast("bigint").alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        share["base"].alias("base_score"),
        share["score"].alias("score"),
    )


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: a seventh, by crc32 of the id."""
    return F.crc32(doc_id.cast("string")) % 7 == 2
