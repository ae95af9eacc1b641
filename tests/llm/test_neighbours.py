import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import ann, jaccard_join
from marquee.llm.graph import components


def brute_components(texts):
    """doc → (size of its set, smallest id that links reach)."""
    sets = {}
    for k, t in texts:
        ws = [w.lower() for w in (t or "").encode().split()]
        sets[k] = {tuple(ws[j : j + 5]) for j in range(max(1, len(ws) - 4))} if ws else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(1000, 1100)] + [(3, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 100 for k in range(100, 141)) and all(got[k] == 7 for k in range(1000, 1100)) and got[3] == 3


def near_copies(seed):
    """Groups of altered copies of texts, some with a passage that many texts share."""
    chance = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = chance.choices(vocabulary, k=25)
    texts = []
    for group in range(25):
        base = chance.choices(vocabulary, k=chance.choice([3, 8, 30, 90]))
        if group % 3 == 0:
            base = base + passage
        for _ in range(chance.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(chance.randint(0, 3)):
                copy[chance.randrange(len(copy))] = chance.choice(vocabulary)
            texts.append((len(texts) * 3, " ".join(copy)))
    chance.shuffle(texts)
    return texts


#: Everywhere the smallest figures: lists in parts, clusters of many blocks, common shingles last.
FINE = {"LIST_ROWS": 3, "BLOCK_SHINGLES": 100, "COMMON_FROM": 2, "FLUSH_SHINGLES": 500, "BATCH_ROWS": 50}


@pytest.mark.parametrize("seed, figures", [(1, {}), (2, FINE), (3, {**FINE, "SLACK": 0}), (4, {"SLACK": 50, "COMMON_FROM": 3})])
def test_near_duplicates_equal_brute_force(spark, seed, figures, monkeypatch):
    for name, value in figures.items():
        monkeypatch.setattr(jaccard_join, name, value)
    texts = near_copies(seed)
    rows = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(rows).collect()}
    assert got == brute_components(texts)


@pytest.mark.parametrize("similar", [True, False])
def test_pairs_from_lists_alone(spark, similar):
    """Pairs that are proposed hold all that link, and with positions beyond the first hardly any other."""
    chance = random.Random(5)
    sets, names = {}, range(60)
    for sid in names:
        base = sets[chance.randrange(sid)] if sid and similar else set()
        kept = {t for t in base if chance.random() < 0.95}
        sets[sid] = kept | {chance.randrange(3000) for _ in range(chance.randint(0, 5) if kept else chance.randint(1, 80))}
    rows = []
    for sid, tokens in sets.items():
        first = sorted(tokens)[: jaccard_join.prefix_length(len(tokens))]
        rows += [(t, sid, sid, len(tokens), k) for k, t in enumerate(first)]
    frame = spark.createDataFrame(rows, "token bigint, sid bigint, root bigint, n bigint, pos bigint")
    found = {frozenset(r) for r in jaccard_join._shared(frame, jaccard_join.SIMILARITY).collect()}
    linked = {frozenset((a, b)) for a in names for b in names if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert bool(linked) == similar and linked <= found and len(found) <= 5 * len(linked) + 3


def test_near_copies_without_keys(spark):
    words = [f"w{k}" for k in range(40)]
    other, third = [w + "x" for w in words], [w + "y" for w in words]
    altered = lambda ws: " ".join(["new", *ws[1:]])
    texts = [(1, " ".join(words)), (None, altered(words)), (None, " ".join(other)), (None, altered(other)), (5, " ".join(third)), (None, ""), (7, None)]
    rows = spark.createDataFrame([(k, t, "s") for k, t in texts] + [(None, altered(words), "s")], "doc_id bigint, text string, row string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(1, 36, 1), (None, 36, 1), (None, 36, 1), (None, 36, None), (None, 36, None), (5, 36, 5), (None, 0, None), (7, 0, 7)], key=str)
    kept = jaccard_join.one_per_group(rows)
    assert kept.columns == rows.columns
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(kept) == 5 and {(1, " ".join(words)), (5, " ".join(third)), (None, ""), (7, None)} < set(kept)


def test_near_duplicates_on_odd_rows(odd, none):
    rows = jaccard_join.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r["component_id"] for r in rows}
    assert by[4] == by[5] == by[6] == by[10] == by[None] == 4 and by[8] == by[9] == 8
    assert by[1] == 1 and by[2] == 2 and by[3] == 3
    assert jaccard_join.near_duplicates(none).count() == 0


def test_search_finds_the_nearest(spark):
    chance = np.random.default_rng(3)
    vectors = chance.normal(size=(1500, 16))
    vectors[500:900] = vectors[0]  # a large group of equal vectors
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None] * 8), (2004, [float("inf")] * 16), (2100, [1.0, 2.0]), (3, vectors[3].tolist())]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest(table, F.col("vec_id") % 100 == 0).toPandas()
    assert set(got[got.query_id == 2100].vec_id) == set() and 2000 not in set(got.vec_id) | set(got.query_id)
    hits = 0
    for q in range(0, 1500, 100):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        ids = np.array([k for k in range(1500) if k != q])
        best = ids[np.lexsort((ids, far[ids]))][:10]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11))
        assert np.allclose(mine.score, far[mine.vec_id], rtol=0, atol=1e-12)
        hits += len(set(best) & set(mine.vec_id))
        if q in (0, 500, 600, 700, 800):
            assert mine.vec_id.tolist() == best.tolist()  # equal ones by their ids
    assert hits >= 0.95 * 150


def test_fewer_candidates_than_asked_for(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    got = ann.nearest(table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 2), (2, 1)]
    assert ann.nearest(table.where("false"), F.col("vec_id") == 0).count() == 0
