from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import mixing, sharding


def drawn(spark, total, marked, n, draws):
    rows = spark.range(draws).select(F.col("id"), sharding.uniform("t", F.col("id")).alias("u"))
    args = [F.lit(float(v)) for v in (total, marked, n)]
    return [int(r[0]) for r in rows.select(sharding.hypergeometric(*args, F.col("u"))).collect()]


@pytest.mark.parametrize("total,marked,n", [(10, 4, 5), (50, 25, 20), (7, 7, 3), (9, 0, 4), (5, 3, 5), (0, 0, 0)])
def test_hypergeometric_draws_follow_the_law(spark, total, marked, n):
    from math import comb

    draws = 4000
    seen = Counter(drawn(spark, total, marked, n, draws))
    for x in range(0, n + 1):
        ways = comb(marked, x) * comb(total - marked, n - x) if n - x <= total - marked else 0
        share = ways / comb(total, n)
        assert abs(seen[x] - draws * share) <= 5 * np.sqrt(draws * share * (1 - share)) + 1e-9


def test_matrix_has_both_margins(spark):
    sizes = [5, 0, 17, 1, 30, 2, 9]
    parts = spark.createDataFrame(list(enumerate(sizes)), "slot int, n bigint")
    shards = [22, 21, 21]
    lines = {r["slot"]: r["line"] for r in sharding.communication_matrix(parts, shards).collect()}
    assert [sum(lines[k]) for k in range(len(sizes))] == sizes
    assert [sum(lines[k][s] for k in lines) for s in range(3)] == shards
    assert all(v >= 0 for line in lines.values() for v in line)


def test_shards_are_exact_on_odd_rows(odd, none):
    out = sharding.shard(odd, 4, bucket_rows=2).toPandas()
    assert len(out) == odd.count() and "Shard" not in out.columns
    by = out.groupby("shard")["slot"].apply(sorted)
    assert max(map(len, by)) - min(map(len, by)) <= 1
    assert all(v == list(range(len(v))) for v in by)
    assert sharding.shard(none, 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(odd, 0)


def test_every_place_is_as_likely(spark):
    rows = spark.range(0, 12, numPartitions=3)
    seen = Counter()
    for seed in range(6):
        for r in sharding.shard(rows, 3, seed=str(seed)).collect():
            seen[r["id"] // 4, r["shard"]] += 1
    assert all(1 <= seen[p, s] <= 20 for p in range(3) for s in range(3)), seen


def test_raking_meets_margins_that_can_be_met(spark):
    cells = [("a", "x", 400), ("a", "y", 200), ("b", "x", 100), ("b", "y", 300)]
    rows = [(f"{s}{l}{k}", s, l, 1) for s, l, n in cells for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id string, s string, l string, n_tokens bigint")
    margins = [mixing.Margin("s", {"a": 0.5, "b": 0.5}), mixing.Margin("l", {"x": 0.4, "y": 0.6})]
    out = mixing.mix(docs, margins, rate=0.3, cycles=20).toPandas()
    whole = out.chance.sum()
    assert abs(whole - 300) < 1e-6
    assert abs(out[out.s == "a"].chance.sum() / whole - 0.5) < 1e-6
    assert abs(out[out.l == "x"].chance.sum() / whole - 0.4) < 1e-6
    assert abs(out.sampled.sum() - 300) < 60


def test_mixing_takes_odd_rows(odd, none):
    margins = [mixing.Margin("source", {}, 0.5), mixing.Margin("lang", {"en": 0.5, None: 0.1, "absent": 0.4})]
    out = mixing.mix(mixing.with_topic_and_tokens(odd), margins).toPandas()
    assert len(out) == odd.count()
    assert out.chance.between(0, 1).all()
    same = out[out.doc_id == 6]
    assert same.sampled.nunique() == 1
    assert mixing.mix(mixing.with_topic_and_tokens(none), margins).count() == 0
