import base64
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from marquee.llm import bpe, lm
from marquee.llm.succinct import EliasFano, NgramTrie

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(open(PATH, "rb").read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def judge():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_encoding_equals_the_plain_one(vocabulary, judge):
    chance = random.Random(5)
    parts = ["a", "th", "ing", "é", "ß", " ", "\n", "1", "!", "=", "日", "\U0001f600", "'s", "aa", "\x00"]
    texts = ["".join(chance.choices(parts[: chance.randint(1, 15)], k=chance.randint(0, 150))) for _ in range(1500)]
    texts += ["", "a" * 3000, "ab" * 2000, "=" * 2500, " " * 900, "<|endoftext|>"]
    for text in texts:
        ids = vocabulary.encode(text)
        assert ids == judge.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_joined_halves_equal_the_whole(vocabulary):
    chance = random.Random(6)
    for _ in range(500):
        data = bytes(chance.choices(b"abcdetion =\xc3\xa9", k=chance.randint(2, 60)))
        cut = chance.randint(1, len(data) - 1)
        assert vocabulary.join(vocabulary.plain(data[:cut]), vocabulary.plain(data[cut:])) == vocabulary.plain(data)


def test_bpe_on_odd_rows(odd, none, judge):
    encoded = bpe.encode(odd, PATH, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert bytes(r["decoded"]) == (r["text"] or "").encode() and r["ids"] == judge.encode_ordinary(r["text"] or "")
    assert bpe.encode(none, PATH, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("n,universe", [(0, 5), (1, 1), (1000, 10**9), (1000, 100), (3000, 3001)])
def test_elias_fano(n, universe):
    values = np.sort(np.random.default_rng(n).integers(0, universe, n)).astype(np.uint64)
    row, _ = EliasFano.opened(np.frombuffer(EliasFano.of(values, universe).to_bytes(), np.uint8))
    assert (row.all() == values).all() and (row.take(np.arange(n)) == values).all()


@pytest.mark.parametrize("order", [1, 2, 3])
def test_trie_finds_what_it_holds(order):
    chance = np.random.default_rng(order)
    grams = np.unique(chance.integers(0, 30, (4000, order)), axis=0)
    trie = NgramTrie.opened(np.frombuffer(NgramTrie.of(grams, np.arange(len(grams)), 32).to_bytes(), np.uint8))
    asked = chance.integers(0, 32, (5000, order))
    place = {tuple(g): k for k, g in enumerate(grams.tolist())}
    for decode_up_to in (0, 10**6):
        assert trie.find(asked, decode_up_to).tolist() == [place.get(tuple(a), -1) for a in asked.tolist()]


def expected_scores(texts, train, head_size):
    """The same model from plain counters."""
    lower = {k: re.sub("[A-Z]", lambda m: m.group().lower(), t or "") for k, t in texts.items()}
    found = {k: re.findall(r"[^\x20\x09-\x0D]+", t) + [None] for k, t in lower.items()}
    c = Counter(w for k in train for w in found[k])
    n, kinds = sum(c.values()), len(c)
    ranked = sorted((m for w, m in c.items() if w is not None), reverse=True)
    over = ranked[head_size - 2] if len(ranked) > head_size - 2 else 0  # words of one count are in or out together
    head = {w for w, m in c.items() if w is not None and m > over} | {None, 0}
    pairs = Counter(p for k in train for p in zip([0, *found[k]], found[k]) if p[0] in head and p[1] in head)
    context = {**c, 0: len(train)}
    follows, successors = Counter(), Counter()
    for (v, _), m in pairs.items():
        follows[v] += m
        successors[v] += 1

    def alone(w):
        return (c.get(w, 0) + 1) / (n + kinds + 1)

    def chance(w, v):
        if v not in head or not context.get(v):
            return alone(w)
        rest = 1 - (follows[v] - lm.DISCOUNT * successors[v]) / context[v]
        return max(pairs.get((v, w), 0) - lm.DISCOUNT, 0) / context[v] + rest * alone(w)

    out = {}
    for k, ws in found.items():
        base = sum(math.log10(alone(w)) for w in ws)
        out[k] = (len(ws), sum(c.get(w, 0) > 0 for w in ws), n, base, sum(math.log10(chance(w, v)) for v, w in zip([0, *ws], ws)))
    return out


@pytest.mark.parametrize("bits", [5, 17])
def test_scores_equal_plain_counters(spark, small, bits):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    train = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    expected = expected_scores(texts, train, 2**bits)
    rows = lm.score(docs, lm.train(docs.where(~lm.held_out(docs["doc_id"])), bits=bits)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, known, total, base, score = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) < 2e-4 * n


def test_pairs_of_rare_words_are_counted(spark):
    # More words of one count than get dense ids, next to a few frequent ones.
    texts = {}
    for k in range(900):
        named = [f"w{(k * 160 + j) % 144_000}" for j in range(160)]
        texts[k] = " ".join(w if j % 3 else f"the {w} of" for j, w in enumerate(named)) + " x" * (k % 2)
        texts[k + 1000] = " ".join(reversed(texts[k].split())) if k % 5 == 0 else texts[k] + f" unseen{k}"
    train = [k for k in texts if k < 1000 or k % 2]
    expected = expected_scores(texts, train, 2**40)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    model = lm.train(docs.where(docs["doc_id"].isin(train)))
    assert len(model.head) < 2**lm.BITS - 2 < model.vocabulary
    rows = lm.score(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, known, total, base, score = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) < 2e-4 * n


def test_scores_of_odd_rows(odd, none):
    rows = lm.score(odd, lm.train(odd)).collect()
    assert len(rows) == odd.count()
    twice = [r for r in rows if r["doc_id"] == 6]
    assert len(twice) == 2 and twice[0] == twice[1]
    empty = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {r["n_tokens"] for r in empty} == {1} and len({r["score"] for r in empty}) == 1
    assert lm.score(none, lm.train(odd)).count() == 0
    assert all(abs(r["base_score"] - r["n_tokens"] * math.log10(1)) < 1e-9 for r in lm.score(odd, lm.train(none)).collect())


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def odd_texts():
    chance = random.Random(9)
    parts = ["a", "Z", "É", "ß", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x00", "\x1c", "\x1f", "\x85", "\xa0", "\u2028", "\U0001f600"]
    return [None, "", " ", "ab", "cd ", " ef", None, *("".join(chance.choices(parts, k=chance.randint(0, 12))) for _ in range(2000)), ""]


def test_cut_equals_a_plain_split():
    texts = odd_texts()
    for start, stop in ((0, len(texts)), (3, 3), (3, 900), (900, len(texts)), (0, 3)):
        expected = [plain_words(t) for t in texts[start:stop]]
        for kind in (pa.string(), pa.large_string()):
            words, sizes = lm.cut(pa.array(texts, kind).slice(start, stop - start))
            assert words.to_pylist() == [w for ws in expected for w in ws] and sizes.tolist() == [len(ws) for ws in expected]


@pytest.mark.parametrize("cut_bytes,flush_tokens", [(1, 1), (40, 7), (10**6, 10**6)])
def test_flushes_hold_every_text_once(monkeypatch, cut_bytes, flush_tokens):
    monkeypatch.setattr(lm, "CUT_BYTES", cut_bytes)
    monkeypatch.setattr(lm, "FLUSH_TOKENS", flush_tokens)
    texts = odd_texts()
    rows = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)), pa.int64())], names=["text", "rid"])
    found = {}
    for words, sizes, rids in lm._flushes(rows.slice(k, 300) for k in range(0, len(texts), 300)):
        words = iter(words.to_pylist())
        for rid, size in zip(rids.tolist(), sizes.tolist(), strict=True):
            assert rid not in found
            found[rid] = [next(words) for _ in range(size)]
        assert next(words, None) is None
    assert found == {k: plain_words(t) for k, t in enumerate(texts)}


def test_texts_are_read_four_times(spark):
    """To count words, to count pairs, to ask for a score and to join it."""
    read = spark.sparkContext.accumulator(0)

    def counted(text):
        read.add(1)
        return text

    texts = [(k, f"word{k % 7} the word{k % 11} of word{k}") for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").select("doc_id", F.udf(counted)("text").alias("text"))
    assert len(lm.score(docs, lm.train(docs)).collect()) == 60
    assert read.value <= 4 * 60


@pytest.mark.parametrize("n", [1, 2, 3, 9])
def test_elias_fano_of_few_large_values(n):
    values = np.sort(np.random.default_rng(n).integers(0, 2**62, n)).astype(np.uint64)
    row, _ = EliasFano.opened(np.frombuffer(EliasFano.of(values, 2**62).to_bytes(), np.uint8))
    assert (row.all() == values).all() and (row.take(np.arange(n)) == values).all()


def test_pairs_of_a_shard_need_little_memory():
    """Merging a shard's flushes holds each pair a few times, not its ids many times."""
    import tracemalloc

    random, parts, sums = np.random.default_rng(5), [], Counter()
    for _ in range(40):
        v, w = -random.integers(1, 3_000, 10_000), random.integers(0, 2_000, 10_000)
        ids, keys, bits = lm._local(v, w)
        distinct, n = lm._runs(np.sort(keys))
        parts.append((True, 0, lm._squeezed(ids, "<i8"), lm._packed(distinct, bits), lm._squeezed(n, "<u8")))
        sums.update(zip(v.tolist(), w.tolist()))
    table = pa.Table.from_batches([lm._batch(parts, lm.PARTS)])
    pairs = sum(len(lm._unpacked(k.as_py())) for k in table.column("keys"))
    tracemalloc.start()
    out = lm._contexts(table, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 * pairs, peak / pairs
    found, rows = {}, out.to_pylist()
    for row in rows:
        met = zip(*(x.tolist() for x in lm._pairs_of(row["ids"], row["keys"])))
        found.update(zip(met, lm._spread(row["counts"], "<u8").tolist()))
    assert found == sums
    assert dict(zip(rows[0]["v"], rows[0]["v_kinds"])) == Counter(v for v, _ in sums) and sum(rows[0]["v_follows"]) == 400_000


def test_equal_pieces_of_a_batch_are_encoded_once(vocabulary, judge):
    words = [f" w{k}x" for k in range(60_000)]
    texts = ["".join(words), None, "", "".join(words), "".join(reversed(words))]
    vocabulary, asked, plain = bpe.Vocabulary(vocabulary.ranks, public_tokenizers.PATTERN), [], bpe.Vocabulary.piece
    vocabulary.piece = lambda p: asked.append(p) or plain(vocabulary, p)
    ids = bpe._ids(pa.array(texts), vocabulary).to_pylist()
    assert len(asked) == len(set(asked))
    assert ids == [judge.encode(t or "") for t in texts] and ids[0] == ids[3] != ids[4]
