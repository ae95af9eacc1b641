"""Near duplicates by an exact similarity join of word-shingle sets.

Two documents link when the Jaccard similarity of their sets of five-word
shingles reaches a bound; the result is the connected components of the links.

* Equal sets are one set. What follows works on distinct sets.
* Sets that link share a shingle among the first ones of each, in one order for
  all (prefix filter). The order puts shingles that many texts share last, so
  that common passages hardly ever propose a pair.
* Index lists hold (size, position) and are cut into blocks by size. From a set's
  position in a list follows up to which size a partner can still share enough of
  what comes after; the blocks beyond are skipped, and so is a posting that reaches none.
* Set relations: each set proposes the leading sets of its lists; what proposals
  connect is a cluster of similar sets. In a cluster one set's answers are
  computed, and they bound those of the others: for x and y with known overlaps
  with r, |x&y| is at most |y&r| + |x| - |x&r|. A set is computed only where the
  bounds and the connections so far leave a link open, and only links that connect
  are given, so that thousands of copies give as many rows, not as many squared.
* Pairs of different clusters are counted on their lists, and those that the
  counts leave open are computed from the sets themselves.

No cap, no sample: every pair that could link is decided, in one of these ways.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import releasing, spare, stored
from marquee.llm.graph import components
from marquee.llm.succinct import EliasFano

WORDS = 5
#: A link from 75 of 100 on.
SIMILARITY = (75, 100)
#: Common shingles that are moved to the end of the order, at most: those with
#: the highest counts. Any choice gives the same links; this bounds a broadcast.
MAX_COMMON = 200_000
COMMON_FROM = 16
#: First bits of a shingle's hash by which it is counted; bytes of text whose
#: shingles are counted in one task, and shingles that are passed on together.
FINGERPRINT, COUNT_BYTES, FLUSH_SHINGLES = 46, 64 * 2**20, 4_000_000
#: Postings of one list, about, that are looked at together.
LIST_ROWS = 20_000
#: Shingles, about, of the sets of a cluster that are compared together.
BLOCK_SHINGLES = 1_000_000
#: Blocks of an index list within one size class (sizes from n to n * den / num).
BLOCKS_IN_CLASS = 3
#: Positions beyond those of the first common shingle that are looked at: a pair
#: must then share so many shingles more. Any number gives the same links.
SLACK = 4
#: Sets that a task remembers as seen.
MEMO = 500_000
#: Entries of the memo of word hashes in a Python worker, which is emptied when
#: full: frequent words are back at once, and rare ones are not worth their memory.
WORD_MEMO = 50_000
#: Postings of one Arrow batch, about.
BATCH_ROWS = 200_000

#: How size, position, core (of 511) and part are packed; a set may have 2**24
#: shingles, a prefix 2**22, a list 255 parts.
N_SHIFT, POS_SHIFT, CORE_SHIFT, MAX_PARTS, PART_SHIFT = 39, 17, 8, 2**8 - 1, 48
#: Bits of the filter that keeps texts of unwanted documents from being moved.
FILTER_BITS = 2**24

_HASHES: dict[bytes, int] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    A-Z count as lower case. With fewer words than a shingle has, the whole
    sequence is one; without words the set is empty.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _HASHES
    hashes = np.empty(len(words), np.uint64)
    for k, w in enumerate(words):
        h = known.get(w)
        if h is None:
            if len(known) >= WORD_MEMO:
                known.clear()
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        hashes[k] = h
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)]
    return np.unique(_mixed(out))


def set_id(shingles: np.ndarray) -> int:
    """A set's identity, signed 64 bits."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def prefix_length(n: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    num, den = similarity
    return n - -(-num * n // den) + 1


def least_overlap(nx: Column, ny: Column, similarity: tuple[int, int] = SIMILARITY) -> Column:
    """Shared shingles from which on two sets of these sizes link."""
    num, den = similarity
    return F.ceil(F.lit(num) * (nx + ny) / F.lit(num + den))


def _row(key: str, text: str) -> Column:
    """What tells rows apart, with or without a key: 128 bits of key and text."""
    parts = (F.coalesce(c, F.lit("")) for c in (F.col(key).cast("bigint").cast("string"), F.col(text)))
    return F.unhex(F.md5(F.concat_ws(":", *parts).cast("binary")))


def _summaries(docs: DataFrame, key: str, text: str, size: int, similarity: tuple[int, int], bits: int) -> DataFrame:
    """A row (doc, row, sid, n) per document, and rows (bucket, keys): fingerprints of shingles, to be counted.

    Counted are twice as many of a set's first shingles as its prefix has, 64 at
    least. A bucket is the first ``bits`` of a fingerprint, the rest is packed. A
    set that recurs in a task is counted once there.
    """
    names = ["doc", "row", "sid", "n", "bucket", "keys"]
    below = np.uint64(FINGERPRINT - bits)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size_held = 0
        seen: set[int] = set()

        def counted() -> pa.RecordBatch:
            prints = np.sort(np.concatenate(held))
            buckets = (prints >> below).astype(np.int64)
            ends = np.searchsorted(buckets, np.arange(2**bits + 1))
            rows = [(k, prints[ends[k] : ends[k + 1]]) for k in range(2**bits) if ends[k] < ends[k + 1]]
            packed = [EliasFano.of(p & np.uint64((1 << int(below)) - 1), 1 << int(below)).to_bytes() for _, p in rows]
            nothing = pa.nulls(len(rows), pa.int64())
            return pa.RecordBatch.from_arrays([nothing, pa.nulls(len(rows), pa.binary()), nothing, nothing, pa.array([k for k, _ in rows], pa.int32()), pa.array(packed, pa.binary())], names=names)

        for batch in stream:
            ns, sids = [], []
            for value in batch.column(2):
                s = shingle_set(value.as_py(), size)
                sid = set_id(s) if len(s) else None
                ns.append(len(s))
                sids.append(sid)
                if len(s) and sid not in seen:
                    if len(seen) < MEMO:
                        seen.add(sid)
                    held.append(s[: max(64, 2 * prefix_length(len(s), similarity))] >> np.uint64(64 - FINGERPRINT))
                    size_held += len(held[-1])
                    if size_held > FLUSH_SHINGLES:
                        yield counted()
                        held, size_held = [], 0
            nothing = pa.nulls(len(ns), pa.int32()), pa.nulls(len(ns), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sids, pa.int64()), pa.array(ns, pa.int64()), *nothing], names=names)
        if held:
            yield counted()

    rows = docs.select(F.col(key).cast("bigint").alias("doc"), _row(key, text).alias("row"), F.col(text))
    return rows.mapInArrow(releasing(batches), "doc bigint, row binary, sid bigint, n bigint, bucket int, keys binary")


def _common(summaries: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the most common shingles, sorted, and their counts."""
    def count(table: pa.Table) -> pa.Table:
        keys = np.sort(np.concatenate([EliasFano.opened(np.frombuffer(v.as_buffer(), np.uint8))[0].all() for v in table.column("keys")]))
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.diff(np.append(first, len(keys)))
        often = n >= COMMON_FROM
        bucket = table.column("bucket")[0].as_py() << (FINGERPRINT - bits)
        return pa.table([pa.array(keys[first[often]].astype(np.int64) + bucket), pa.array(n[often])], names=["print", "n"])

    counted = summaries.where(F.col("keys").isNotNull()).select("bucket", "keys").groupBy("bucket").applyInArrow(count, "print bigint, n bigint")
    best = sorted((r["print"], r["n"]) for r in counted.orderBy(F.desc("n"), "print").limit(MAX_COMMON).collect())
    return np.array([p for p, _ in best], np.uint64), np.array([n for _, n in best], np.int64)


def _postings(docs: DataFrame, text: str, common, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Rows (list, sid, meta) of the first shingles of each set; ``meta`` packs size, position, core and part.

    Core is the share of common shingles in the set.

    ``common``: a broadcast of common shingles, sorted, and their counts. Their
    lists are dealt out into parts from 1; whole ones are part 0. A set that
    recurs in a task is given once.
    """
    names = ["list", "sid", "meta"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = common.value
        seen: set[int] = set()
        out: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

        for batch in stream:
            for value in batch.column(0):
                tokens = shingle_set(value.as_py(), size)
                if not len(tokens):
                    continue
                sid, n = set_id(tokens), len(tokens)
                if n >= 2 ** (63 - N_SHIFT):
                    raise ValueError(f"a text of {n} shingles: sizes are packed into {63 - N_SHIFT} bits")
                if sid in seen:
                    continue
                if len(seen) < MEMO:
                    seen.add(sid)
                length = prefix_length(n, similarity)
                part, core = np.zeros(length, np.int64), 0
                if len(frequent):
                    prints = tokens >> np.uint64(64 - FINGERPRINT)
                    at = np.minimum(np.searchsorted(frequent, prints), len(frequent) - 1)
                    often = np.where(frequent[at] == prints, counts[at], 0)
                    core = int(511 * (often > 0).mean())
                    order = np.argsort(often, kind="stable")[:length]
                    tokens = tokens[order]
                    parts = np.minimum(often[order] // LIST_ROWS, MAX_PARTS - 1)
                    part = np.where(parts > 0, 1 + sid % (1 + parts), 0)
                lists = tokens[:length].view(np.int64) ^ (part << PART_SHIFT)
                meta = n << N_SHIFT | np.arange(length, dtype=np.int64) << POS_SHIFT | core << CORE_SHIFT | part
                out.append((lists, np.full(length, sid, np.int64), meta))
                rows += length
                if rows > BATCH_ROWS:
                    yield flushed()
                    out, rows = [], 0
        if out:
            yield flushed()

    return docs.select(F.col(text)).mapInArrow(releasing(batches), "list bigint, sid bigint, meta bigint")


def _only(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose ``row`` may be wanted: a bit filter of fixed size goes to all executors.

    Rows that pass by chance are left to the join that follows; with very many
    wanted rows the filter passes all.
    """
    bit = F.pmod(F.xxhash64("row"), F.lit(FILTER_BITS))
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(63).cast("int"))
    marks = wanted.select(F.shiftright(bit, 6).alias("word"), mark.alias("mark"))
    words = marks.groupBy("word").agg(F.bit_or("mark").alias("marks"))  # FILTER_BITS / 64 rows at most
    rows = texts.withColumn("word", F.shiftright(bit, 6)).join(F.broadcast(words), "word")
    return rows.where(F.col("marks").bitwiseAND(mark) != 0).select("row", "text")


def _sets(wanted: DataFrame, members: DataFrame, docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``wanted`` (sid, each once, and others) with ``tokens``, the set made anew from the text of one row that has it.

    Texts move once; what repeated rows have in common goes before that.
    """
    one = members.where(F.col("sid").isNotNull()).groupBy("sid").agg(F.min("row").alias("row"))
    found = stored(wanted.join(one, "sid"), "jaccard-wanted")
    texts = _only(docs.select(_row(key, text).alias("row"), F.col(text).alias("text")), found)
    others = [c for c in wanted.columns if c != "sid"]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.select(*others).schema)

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            sets = [shingle_set(value.as_py(), size).tobytes() for value in batch.column(1)]
            kept = [batch.column(k) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *kept, pa.array(sets, pa.binary())], names=["sid", *others, "tokens"])

    met = found.join(texts.groupBy("row").agg(F.first("text").alias("text")), "row")
    return met.select("sid", "text", *others).mapInArrow(releasing(read), f"sid bigint, {types}, tokens binary")


def cluster_links(sets: list[np.ndarray], similarity: tuple[int, int] = SIMILARITY) -> list[tuple[int, int]]:
    """Links (places in ``sets``) that connect whatever the links among these sets connect.

    Sets are taken by how common their shingles are here, so that the text that
    others were made from comes first. Its overlaps with all others are computed;
    for each further set they bound every overlap, and a set is computed only if
    some set that it is not yet connected with may reach the similarity.
    """
    num, den = similarity
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, counts = np.unique(flat, return_inverse=True, return_counts=True)
    lists = owner[np.argsort(token, kind="stable")]
    starts = np.cumsum(counts) - counts
    core = np.bincount(owner, counts[token]) / sizes
    ends = np.cumsum(sizes)
    need = -(-num * (sizes[:, None] + sizes[None, :]) // (num + den)) if len(sets) <= 512 else None
    label, links, known = np.arange(len(sets)), [], []
    for x in np.lexsort((-sizes, -core)):
        apart = label != label[x]
        if not apart.any():
            break
        least = need[x] if need is not None else -(-num * (sizes[x] + sizes) // (num + den))
        most = np.minimum(sizes[x], sizes)
        for of, overlap in known:
            most = np.minimum(most, np.minimum(overlap + sizes[x] - overlap[x], overlap[x] + sizes - overlap))
        if not (apart & (most >= least)).any():
            continue
        own = token[ends[x] - sizes[x] : ends[x]]
        n = counts[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        overlap = np.bincount(lists[at], minlength=len(sets))
        if len(known) < 4:
            known.append((x, overlap))
        for y in np.flatnonzero(apart & (overlap >= least)):
            if label[y] != label[x]:
                links.append((int(x), int(y)))
                label[label == label[y]] = label[x]
    return links


def _linked_in_clusters(clusters: DataFrame, members: DataFrame, docs: DataFrame, key: str, text: str, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) among the sets of each cluster (node, root).

    A cluster is cut into blocks of about ``BLOCK_SHINGLES``; each two of them, and
    each alone, are one group, so that no group grows with its cluster.
    """
    sized = members.where(F.col("sid").isNotNull()).select("sid", "n").distinct()
    rows = clusters.select(F.col("node").alias("sid"), "root").join(sized, "sid")
    volume = rows.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    rows = rows.join(volume, "root").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = _sets(rows.select("sid", "root", "block", "blocks"), members, docs, key, text, size)
    rows = rows.select("sid", "root", "block", "tokens", other.alias("other"))
    rows = rows.select("sid", "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "tokens")

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("sid")
        sets = [np.frombuffer(v.as_py(), np.uint64) for v in table.column("tokens")]
        sids = table.column("sid").to_pylist()
        found = cluster_links(sets, similarity) if len(sets) > 1 else []
        return pa.table([pa.array([sids[x] for x, _ in found], pa.int64()), pa.array([sids[y] for _, y in found], pa.int64())], names=["a", "b"])

    return rows.groupBy("root", "low", "high").applyInArrow(link, "a bigint, b bigint")


def _overlaps(pairs: DataFrame, members: DataFrame, docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``pairs`` (x, y) with ``nx``, ``ny`` and ``overlap``, computed from the texts of one document of each set."""
    needs = pairs.select(F.col("x").alias("sid"), "y").unionByName(pairs.select(F.col("y").alias("sid"), "y"))
    wanted = needs.groupBy("sid").agg(F.collect_set("y").alias("ys"))
    sets = stored(_sets(wanted, members, docs, key, text, size), "jaccard-tokens")
    left = sets.select(F.col("sid").alias("x"), F.explode("ys").alias("y"), F.col("tokens").alias("a")).where("x != y")
    right = sets.where(F.array_contains("ys", F.col("sid"))).select(F.col("sid").alias("y"), F.col("tokens").alias("b"))

    def meet(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            columns: list[list[int]] = [[], [], []]
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                at = np.searchsorted(b, a)
                for column, value in zip(columns, (len(a), len(b), int((b[np.minimum(at, len(b) - 1)] == a).sum()))):
                    column.append(value)
            own = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own], names=["x", "y", "nx", "ny", "overlap"])

    met = left.join(right, "y").select("x", "y", "a", "b")
    return met.mapInArrow(releasing(meet), "x bigint, y bigint, nx bigint, ny bigint, overlap bigint").dropDuplicates(["x", "y"])


def _size_class(n: Column, similarity: tuple[int, int], shift: float = 0.0) -> Column:
    """Sets that link are in the same class or in neighbouring ones."""
    num, den = similarity
    return F.floor(F.log(n) / F.log(F.lit(den / num)) + shift).cast("int")


def _part() -> Column:
    return F.col("meta").bitwiseAND(F.lit(2**CORE_SHIFT - 1))


def _n() -> Column:
    return F.shiftright("meta", N_SHIFT)


def _lists(postings: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Postings of lists that several sets share, with the leading sets of the list.

    Leading is, among sets of one size class, that with the largest core: of a
    text and its altered copies this is the text itself, which links with more of
    them than they do with each other. Classes come in two kinds with shifted
    borders, so that no group is cut by both. All of it is done on one exchange by
    list, in which common lists are cut into parts.
    """
    whole = W.partitionBy("list")
    split = _part() > 0
    seen = postings.withColumn("low", F.min("sid").over(whole)).withColumn("high", F.max("sid").over(whole))
    live = seen.where((F.col("low") != F.col("high")) | split).select("list", "sid", "meta").distinct()
    for kind in (0, 1):
        live = live.withColumn(f"class_{kind}", _size_class(_n(), similarity, kind / 2))
        order = F.struct(F.shiftright("meta", CORE_SHIFT).bitwiseAND(F.lit(2 ** (POS_SHIFT - CORE_SHIFT) - 1)).alias("core"), F.col("sid"))
        live = live.withColumn(f"lead_{kind}", F.max(order).over(W.partitionBy("list", f"class_{kind}"))["sid"])
    return live.select("list", "sid", "meta", "lead_0", "lead_1")


def _leading(live: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (x, y): each set and the two leading sets, one a kind, that share most of its lists.

    Leading sets of the parts of a common list are compared among each other.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"lead_{k}").alias("y")) for k in (0, 1)])
    rows = live.select("sid", _n().alias("n"), F.inline(kinds)).where("sid != y")
    counted = rows.groupBy("sid", "kind", "y").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    best = counted.where(20 * F.col("c") >= F.col("n")).groupBy(F.col("sid").alias("x"), "kind").agg(F.max(F.struct("c", "y")).alias("best"))
    leaders = live.where(_part() > 0).where("sid = lead_0").select(_token().alias("token"), _size_class(_n(), similarity).alias("class"), F.col("sid").alias("x")).distinct()
    first = leaders.groupBy("token", "class").agg(F.min("x").alias("y"))
    across = leaders.join(first, ["token", "class"]).where("x != y").select("x", "y")
    return best.select("x", F.col("best.y").alias("y")).unionByName(across).distinct()


def _token() -> Column:
    """The shingle of a list, whatever its part."""
    return F.col("list").bitwiseXOR(F.shiftleft(_part(), PART_SHIFT))


def _left_over(live: DataFrame, labels: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (x, y) of sets of different clusters that could link by sizes, positions and counts."""
    rows = live.select(_token().alias("token"), "sid", "meta").join(labels.withColumnRenamed("node", "sid"), "sid", "left")
    rows = rows.withColumn("root", F.coalesce("root", "sid"))
    apart = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("token")
    rows = rows.join(apart, "token", "left_semi").select(
        "token", "sid", "root", _n().alias("n"), F.shiftright("meta", POS_SHIFT).bitwiseAND(F.lit(2 ** (N_SHIFT - POS_SHIFT) - 1)).alias("pos")
    )
    return _shared(stored(rows, "jaccard-apart"), similarity)


def _size_block(n: Column, similarity: tuple[int, int]) -> Column:
    num, den = similarity
    return F.floor(F.log(n) / F.log(F.lit(den / num)) * BLOCKS_IN_CLASS).cast("int")


def _shared(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (x, y), x not larger than y, of postings (token, sid, root, n, pos) of different roots that could link.

    Sets that must share ``least`` shingles have their first common one so early
    that ``least`` are left from there on in both; with ``SLACK`` positions more,
    as far as both prefixes reach, they share so many more of those looked at. The
    rest that a position leaves bounds the partner's size, and only blocks of
    sizes within the bound are met. Long blocks are dealt out into parts.
    """
    num, den = similarity
    # num * (nx + ny) <= (num + den) * left: the largest sum of sizes that ``left`` positions allow.
    reach = F.floor((num + den) * (F.col("n") - F.col("pos") + SLACK) / F.lit(num)).cast("bigint")
    sized = rows.withColumn("reach", reach)
    names = ["sid", "n", "pos", "root"]
    smaller = sized.where(2 * F.col("n") <= F.col("reach")).withColumn("block", _size_block(F.col("n"), similarity))
    parts = F.ceil(F.count("*") / F.lit(LIST_ROWS)).cast("int").alias("parts")
    volume = smaller.groupBy("token", "block").agg(parts)
    low, high = F.floor(num * F.col("n") / F.lit(den)), F.least("n", F.col("reach") - F.col("n"))
    larger = sized.withColumns({"low": F.greatest(low, F.lit(1)), "high": high}).where("low <= high")
    blocks = F.sequence(_size_block(F.col("low"), similarity), _size_block(F.col("high"), similarity))
    larger = larger.withColumn("block", F.explode(blocks)).join(volume, ["token", "block"])
    a = smaller.join(volume, ["token", "block"]).select(
        "token", "block", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int").alias("part"), *[F.col(c).alias(f"{c}_x") for c in names]
    )
    b = larger.select("token", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *[F.col(c).alias(f"{c}_y") for c in names])
    least = least_overlap(F.col("n_x"), F.col("n_y"), similarity)
    rest = F.ceil(F.lit(num) * F.col("n_y") / F.lit(den)) - 1  # of the larger set, behind its prefix
    slack = F.least(F.lit(SLACK), least - 1 - rest)
    early = (F.col("pos_x") + least <= F.col("n_x") + slack) & (F.col("pos_y") + least <= F.col("n_y") + slack)
    apart = (F.col("root_x") != F.col("root_y")) & ((F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("sid_x") < F.col("sid_y"))))
    met = a.join(b, ["token", "block", "part"]).where(apart & (slack >= 0) & early)
    counted = met.select(F.col("sid_x").alias("x"), F.col("sid_y").alias("y"), slack.alias("slack")).groupBy("x", "y", "slack").agg(F.count("*").alias("c"))
    return counted.where("c > slack").select("x", "y")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """(doc, row, n, root, least) per row of ``docs``: its key, what tells it apart, shingles, group, and the group's smallest key.

    ``root`` names a group whether its rows have keys or not; rows without shingles
    have none. ``least`` is NULL where no row of the group has a key.
    """
    volume = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    bits = max(1, math.ceil(math.log2(max(1, volume / COUNT_BYTES))))
    summaries = stored(_summaries(docs, key, text, size, similarity, bits), "jaccard-sets")
    members = summaries.where(F.col("keys").isNull()).select("doc", "row", "sid", "n")
    shared = docs.sparkSession.sparkContext.broadcast(_common(summaries, bits))
    live = _lists(_postings(docs, text, shared, size, similarity), similarity)
    live = stored(live, "jaccard-lists")
    clusters = components(_leading(live, similarity).select(F.col("x").alias("a"), F.col("y").alias("b")))
    first = _linked_in_clusters(clusters, members, docs, key, text, size, similarity)
    pairs = stored(_left_over(live, clusters, similarity), "jaccard-pairs")
    links = F.col("overlap") >= least_overlap(F.col("nx"), F.col("ny"), similarity)
    more = _overlaps(pairs, members, docs, key, text, size).where(links)
    edges = first.unionByName(more.select(F.col("x").alias("a"), F.col("y").alias("b")))
    roots = components(edges)
    least_doc = members.where(F.col("sid").isNotNull()).groupBy("sid").agg(F.min("doc").alias("least"))
    rooted = least_doc.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    named = rooted.select("sid", "root").join(rooted.groupBy("root").agg(F.min("least").alias("least")), "root")
    return members.join(named, "sid", "left").select("doc", "row", "n", "root", "least")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """(key, n_shingles, component_id) per row of ``docs``; ``key`` is a BIGINT.

    ``component_id`` is the smallest key that links reach, the own one included;
    rows whose key is NULL link like others, and where links reach no key at all
    it is NULL. Rows with equal texts are linked; repeated rows come out as often
    as they went in. NULL and empty texts have the empty set: they link with
    nothing and have their own key. No rows give no rows; other columns are not
    looked at. A text of 2**24 shingles or more is an error.
    """
    return groups(docs, key, text, size, similarity).select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "doc").alias("component_id")
    )


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Of each group of near duplicates the row with the smallest key, or where none has a key one of its rows.

    Rows without shingles are in no group and stay; repeated rows stay once.
    """
    found = groups(docs, key, text, size, similarity)
    order = F.struct(F.col("doc").isNull().alias("without"), "doc", "row")
    alone = F.when(F.col("root").isNull(), F.col("row")).alias("alone")
    name = spare(docs.columns, "row")
    first = found.groupBy("root", alone).agg(F.min(order)["row"].alias(name)).select(name)
    rows = docs.withColumn(name, _row(key, text)).join(first, name, "left_semi")
    return rows.dropDuplicates([name, key, text]).select(*docs.columns)
