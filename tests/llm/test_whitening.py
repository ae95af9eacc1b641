import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import whitening
from marquee.llm.registered import QUERIES


def symmetric(values, seed):
    """A matrix in extended precision with these eigenvalues."""
    start = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):  # orthonormal to extended precision
        start = start @ (3 * np.eye(len(values)) - start.T @ start) / 2
    return (start * np.array(values, np.longdouble)) @ start.T


CLUSTERED = {
    "apart": list(np.geomspace(1, 1e-6, 20)),
    "near": [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5 - 1e-12, 0.25, 0.1, 0.1 + 1e-8, 0.1 - 1e-8, 1e-3],
    "equal": [3, 3, 3, 2, 2, 1, 1e-5, 1e-5],
    "nested": [1, 1 - 1e-5, 1 - 1e-5 - 1e-10, 1 - 1e-5 - 2e-10, 0.3, 0.3 - 1e-14],
    "singular": [2, 1, 0, 0, 0],
    "small": [7],
}


@pytest.mark.parametrize("name", CLUSTERED)
def test_refined_eigenvectors(name):
    wanted = np.sort(np.array(CLUSTERED[name], np.longdouble))[::-1]
    a = symmetric(wanted, 1)
    values, vectors = whitening.refined(a)
    assert np.abs(values - wanted).max() < 1e-16 * len(wanted) * wanted[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(wanted))).max() < 1e-16
    assert np.abs(a @ vectors - vectors * values).max() < 1e-16 * wanted[0]


def test_refinement_beats_both_precisions_of_the_library():
    a = symmetric(CLUSTERED["near"], 2)
    left = np.abs(a @ (v := whitening.refined(a)[1]) - v * np.einsum("ij,ij->j", v, a @ v)).max()
    for kind in (np.float32, np.float64):
        plain = np.linalg.eigh(a.astype(kind))[1].astype(np.longdouble)
        assert left < np.abs(a @ plain - plain * np.einsum("ij,ij->j", plain, a @ plain)).max()


def test_refined_zero_and_empty():
    assert whitening.refined(np.zeros((3, 3), np.longdouble))[0].tolist() == [0, 0, 0]
    assert whitening.refined(np.zeros((0, 0), np.longdouble))[1].shape == (0, 0)


@pytest.mark.parametrize("top", [5, 2**20, 2**30, 2**45])
def test_products_are_exact(top):
    rows = np.random.default_rng(top).integers(-top, top, (300, 4), endpoint=True)
    assert (whitening.products(rows).astype(object) == rows.astype(object).T @ rows.astype(object)).all()
    total = whitening.products(rows)
    back = np.zeros((4, 4), object)
    for batch in whitening._sent(total, whitening.SUMS):
        for i, j, digit, v in zip(*(c.to_pylist() for c in batch.columns)):
            back[i, j] += v << (whitening.DIGIT * digit)
    assert (back == total).all()


def plain(vectors):
    """Whole numbers, fit list, sums and covariance, by Python's whole numbers."""
    x = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, width = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(width)]
    far = [[n * v[i] - sums[i] for i in range(width)] for v in fit]
    cov = [[sum(f[i] * f[j] for f in far) / n**3 for j in range(width)] for i in range(width)]
    return x, n, sums, np.array(cov)


def check(found, vectors, components=16):
    x, n, sums, cov = plain([v for _, v in vectors])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    assert len(found) == len(vectors)
    ids = {k: i for i, (k, _) in enumerate(vectors)}
    signs = None
    for r in found:
        own = x[ids[r["vec_id"]]]
        assert r["n"] == n
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(own, sums))
        wanted = (np.array([(n * c - s) / n for c, s in zip(own, sums)]) @ basis / np.sqrt(values))[: len(r["whitened"])]
        got = np.array(r["whitened"])
        if signs is None:
            signs = np.sign(wanted * got)
        assert np.allclose(got, signs * wanted, rtol=1e-8, atol=1e-8)
        assert np.allclose(r["explained"], values[: len(got)] / np.trace(cov), rtol=1e-9)
        assert r["identity_error"] < 1e-10


def test_whitening_equals_the_plain_one(spark):
    chance = np.random.default_rng(7)
    vectors = [(k, (chance.normal(size=5) * [3, 2, 1, 0.5, 0.3] + 40).tolist()) for k in range(400)]
    vectors += [(1000 + k, vectors[k % 3][1]) for k in range(200)]  # copies weigh once
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(7)
    check(whitening.whiten(rows).collect(), vectors)
    few = whitening.whiten(rows, components=2).collect()
    assert {len(r["whitened"]) for r in few} == {2}
    check(few, vectors, 2)


def test_large_entries_stay_exact(spark):
    chance = np.random.default_rng(8)
    vectors = [(k, (chance.normal(size=3) * 1e9).tolist()) for k in range(60)]
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(3)
    x, n, sums, _ = plain([v for _, v in vectors])
    for r in whitening.whiten(rows).collect():
        exact = sum((n * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
        assert r["deviation"] == (exact if exact < 2**63 else None)
        assert r["identity_error"] < 1e-10


ODD = "vec_id bigint, embedding array<float>, n string, Whitened string, label int"


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    lost = [None, [1.0, None], [nan, 1.0], [1.0, -inf], [1e30, 0.0]]
    good = [[0.0, 0.0], [1.0, 2.0], [1.0, 2.0], [-3.0, 0.5], [1.0, 2.0, 3.0], [], [2.0, 2.0, 9.0]]
    rows = [(k, v, "a", "b", 1) for k, v in enumerate(lost + good)] + [(None, [5.0, 5.0], None, None, None)]
    found = whitening.whiten(spark.createDataFrame(rows, ODD)).collect()
    assert set(found[0].asDict()) == {"vec_id", "embedding", "label", "n", "deviation", "whitened", "explained", "identity_error"}
    by = {r["vec_id"]: r for r in found}
    assert set(by) == {5, 6, 7, 8, 9, 10, 11, None}
    assert {by[k]["n"] for k in (5, 6, 7, 8, None)} == {4} and by[9]["n"] == by[11]["n"] == 2 and by[10]["n"] == 1
    assert [len(by[k]["whitened"]) for k in (5, None, 9, 10)] == [2, 2, 1, 0]
    assert by[6]["whitened"] == by[7]["whitened"] and by[10]["deviation"] == 0


def test_one_vector_and_none(spark):
    one = spark.createDataFrame([(k, [1.5, 2.5], "a", "b", 1) for k in range(3)], ODD)
    assert [(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in whitening.whiten(one).collect()] == [(1, 0, [], 0.0)] * 3
    empty = whitening.whiten(one.limit(0))
    assert empty.count() == 0 and "whitened" in empty.columns


def test_query_equals_the_plain_one(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").where(F.col("embedding").isNotNull())
    vectors = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    by: dict = {}
    for r in QUERIES["op12_embedding_whitening"](spark, small).collect():
        own = by.setdefault(r["vec_id"], {"vec_id": r["vec_id"], "whitened": {}, "explained": {}})
        own.update(n=r["n"], deviation=r["deviation"], identity_error=r["identity_error"])
        own["whitened"][r["component"]], own["explained"][r["component"]] = r["whitened"], r["explained"]
    found = [{**r, "whitened": [r["whitened"][k] for k in range(1, 17)], "explained": [r["explained"][k] for k in range(1, 17)]} for r in by.values()]
    check(found, vectors)
