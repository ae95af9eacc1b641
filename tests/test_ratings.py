"""Merging and folding votes into ratings."""

import math
import random

import pytest

from marquee.operators import ratings as ops
from marquee.operators.votes import vote_totals
from marquee.sinks.tables import write_folded_ratings
from marquee.sources.tables import load_folded_ratings

RATINGS = [
    ("tt1", "8.0", 10),
    ("tt2", "7.0", 5),
    ("tt3", None, 5),
    ("tt4", "6.0", None),
    ("tt5", None, None),
    ("tt6", "bad", 3),
]
VOTES = [
    (1, "tt1", 100, 5),
    (2, "tt1", 101, 1),
    (3, "tt3", 100, 4),
    (4, "tt4", 100, 4),
    (5, "tt9", 100, 2),
    (6, "tt9", 102, 3),
]


@pytest.fixture
def ratings(spark):
    return spark.createDataFrame(RATINGS, "tconst string, averageRating string, numVotes int")


@pytest.fixture
def votes(spark):
    return spark.createDataFrame(VOTES, "msg_offset bigint, tconst string, ts_ms bigint, vote int")


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def test_merge(ratings, votes):
    merged = ops.merged_ratings(ratings, votes)
    assert [t for _, t in merged.dtypes] == ["string", "double", "bigint"]
    assert rows(merged) == [
        ("tt1", (8.0 * 10 + 6) / 12, 12),
        ("tt2", 7.0, 5),
        ("tt3", None, 6),
        ("tt4", None, None),
        ("tt5", None, None),
        ("tt6", None, 3),
    ]


@pytest.mark.parametrize(
    ("tconst", "expected"),
    [
        ("tt1", [("tt1", 86 / 12, 12)]),
        ("tt2", [("tt2", 7.0, 5)]),
        ("tt3", []),
        ("tt4", []),
        ("tt5", [("tt5", None, None)]),
        ("tt9", []),
        ("tt1' or '1'='1", []),
    ],
)
def test_lookup(ratings, votes, tconst, expected):
    assert rows(ops.merged_rating_by_id(ratings, votes, tconst)) == expected


def test_fold_adds_new_titles(ratings, votes):
    assert rows(ops.fold_votes(ratings, votes)) == [
        ("tt1", 86 / 12, 12),
        ("tt2", 7.0, 5),
        ("tt3", 4 / 6, 6),
        ("tt4", 4.0, 1),
        ("tt5", None, 0),
        ("tt6", None, 3),
        ("tt9", 2.5, 2),
    ]


def test_fold_is_stored_next_to_its_input_and_folded_again(spark, ratings, votes, tmp_path):
    root = str(tmp_path)
    write_folded_ratings(ops.fold_votes(ratings, votes), root, 1)
    write_folded_ratings(ops.fold_votes(load_folded_ratings(spark, root, 1), votes), root, 2)
    first = {row[0]: row[1:] for row in rows(load_folded_ratings(spark, root, 1))}
    second = {row[0]: row[1:] for row in rows(load_folded_ratings(spark, root, 2))}
    assert first["tt1"] == (86 / 12, 12)
    assert second["tt1"][1] == 14 and math.isclose(second["tt1"][0], 92 / 14)
    assert second["tt9"] == (2.5, 4)


def test_no_vote_is_lost_or_doubled(ratings, votes):
    """Votes after the merge are the former ones and those that met a rating."""
    complete = ratings.where("numVotes is not null")
    before = sum(row["numVotes"] for row in complete.collect())
    after = sum(row["numVotes"] for row in ops.merged_ratings(complete, votes).collect())
    met = votes.join(complete, "tconst", "left_semi").count()
    assert after == before + met


def brute_force(ratings, votes):
    merged = []
    for tconst, average, count in ratings:
        hits = [v for _, t, ms, v in votes if f"{t}_{ms}" >= tconst and tconst in f"{t}_{ms}"]
        if hits:
            total = count + len(hits)
            merged.append((tconst, (float(average) * count + sum(hits)) / total, total))
        else:
            merged.append((tconst, float(average), count))
    return sorted(merged, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_contains_match_equals_brute_force(spark, seed):
    """Ids of every shape: digits only, with "_", empty, prefixes of others."""
    rng = random.Random(seed)
    alphabet = "t1_0-" if seed % 2 else "tn12"
    ids = {"".join(rng.choices(alphabet, k=rng.randint(1, 5))) for _ in range(60)}
    if seed % 2:
        ids |= {"", "1", "10", "_", "1_1", "-5"}
    ratings = [(i, str(rng.randint(10, 100) / 10), rng.randint(1, 9)) for i in sorted(ids)]
    votes = [
        (n, "".join(rng.choices(alphabet.replace("_", "t"), k=rng.randint(0, 7))),
         rng.choice([-5, 1, 10, 101, 2210]), rng.randint(1, 5))
        for n in range(150)
    ]
    merged = ops.merged_ratings_contains(
        spark.createDataFrame(ratings, "tconst string, averageRating string, numVotes int"),
        spark.createDataFrame(votes, "msg_offset bigint, tconst string, ts_ms bigint, vote int"),
    )
    expected = brute_force(ratings, votes)
    actual = rows(merged)
    assert [(t, n) for t, _, n in actual] == [(t, n) for t, _, n in expected]
    assert all(math.isclose(a, e) for (_, a, _), (_, e, _) in zip(actual, expected))


def test_contains_match_takes_longer_ids(spark, ratings):
    votes = spark.createDataFrame(
        [(1, "tt10", 5, 4)], "msg_offset bigint, tconst string, ts_ms bigint, vote int"
    )
    merged = {row[0]: row for row in rows(ops.merged_ratings_contains(ratings, votes))}
    assert merged["tt1"][2] == 11
    assert rows(vote_totals(votes)) == [("tt10", 1, 4)]
