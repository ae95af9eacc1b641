"""The vote store as runs, and running totals of stored votes."""

import pytest
from pyspark.sql import functions as F

from marquee import vote_runs
from marquee.operators.votes import latest_votes, vote_totals
from marquee.schemas import MESSAGE_LOG, VOTE_STORE
from marquee.streaming import stored_totals as totals

TITLES = 40


def votes(first, count, title=lambda k: f"tt{k % TITLES:03}"):
    return [(k, title(k), 1000 + k // 3, k % 5 + 1) for k in range(first, first + count)]


def append(spark, log, rows):
    frame = spark.createDataFrame([(o, ms, t, v, None, True) for o, t, ms, v in rows], MESSAGE_LOG)
    frame.coalesce(2).write.mode("append").partitionBy("accepted").parquet(log)


def found(frame):
    return sorted(tuple(r) for r in frame.select("msg_offset", "tconst", "ts_ms", "vote").collect())


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "log"), str(tmp_path / "store")


def test_store_and_tail_hold_each_vote_once(spark, places):
    log, store = places
    rows = []
    for k in range(4):
        new = votes(100 * k, 100)
        append(spark, log, new)
        rows += new
        assert found(vote_runs.current_votes(spark, log, store)) == rows
        assert found(vote_runs.current_votes(spark, log, store, "tt007")) == [r for r in rows if r[1] == "tt007"]
        if k != 2:
            vote_runs.compact(spark, log, store)
        assert found(vote_runs.current_votes(spark, log, store)) == rows
    assert vote_runs.tail(spark, log, vote_runs.newest_manifest(spark, store)).count() == 0
    assert found(vote_runs.current_votes(spark, log, store, "none")) == []


def test_without_new_votes_nothing_is_written(spark, places):
    log, store = places
    append(spark, log, votes(0, 50))
    first = vote_runs.compact(spark, log, store)
    assert vote_runs.compact(spark, log, store) == first
    assert len(vote_runs.subfolders(spark, f"{store}/runs")) == 1


def test_partitions_that_lag_behind_lose_nothing(spark, places):
    """Positions of a slow partition are smaller than marks of a fast one."""
    log, store = places
    position = lambda part, offset: (offset << 16) + part
    fast = [(position(1, k), "a", k, 1) for k in range(100)]
    slow = [(position(2, k), "b", k, 2) for k in range(30)]
    append(spark, log, fast + slow[:10])
    vote_runs.compact(spark, log, store)
    append(spark, log, slow[10:] + [(position(3, 0), "c", 0, 3)])
    wanted = sorted(fast + slow + [(position(3, 0), "c", 0, 3)])
    assert found(vote_runs.current_votes(spark, log, store)) == wanted
    vote_runs.compact(spark, log, store)
    assert found(vote_runs.current_votes(spark, log, store)) == wanted


def files_read(frame):
    return len(frame.inputFiles())


def test_runs_and_files_of_a_lookup_do_not_grow_with_age(spark, places):
    """Many compactions leave few runs, and each touches small ones only."""
    log, store = places
    rows, kept = [], []
    for k in range(10):
        new = votes(4000 * k, 4000, lambda j: f"tt{j * 7919 % 1000:03}")
        append(spark, log, new)
        rows += new
        before = vote_runs.newest_manifest(spark, store).runs
        manifest = vote_runs.compact(spark, log, store)
        kept.append(bool(before) and before[0] in manifest.runs)
        sizes = [r.size for r in manifest.runs]
        assert all(a >= vote_runs.GROWTH * sum(sizes[i + 1 :]) for i, a in enumerate(sizes[:-1]))
        assert len(sizes) <= 5
        lookup = vote_runs.stored_votes(spark, store, manifest, "tt007")
        assert files_read(lookup) <= 2 * len(sizes)
    assert found(vote_runs.stored_votes(spark, store, manifest)) == rows
    # Of sizes 1 to 10 the largest run is left alone at 4+1, 6+1 and 8+1; at 8+2 it
    # depends on how well the merged votes are compressed.
    assert sum(kept) >= 3
    assert len(vote_runs.numbered(spark, f"{store}/manifests")) == vote_runs.KEPT


def test_old_files_of_the_log_are_not_opened(spark, places):
    log, store = places
    append(spark, log, votes(0, 90))
    vote_runs.compact(spark, log, store)
    manifest = vote_runs.newest_manifest(spark, store)._replace(log_time=4e9)
    scan = vote_runs.tail(spark, log, manifest)
    scan.collect()
    metrics = {}
    plan = scan._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "file_modification_time" in text
    leaves = plan.collectLeaves() if not text.startswith("AdaptiveSparkPlan") else plan.executedPlan().collectLeaves()
    for k in range(leaves.size()):
        found_metrics = leaves.apply(k).metrics()
        if found_metrics.contains("numFiles"):
            metrics[k] = found_metrics.apply("numFiles").value()
    assert sum(metrics.values()) == 0


def test_a_hot_title_is_spread_over_files(spark, places):
    """Ranges as they are cut; adaptive execution would put these few rows together."""
    log, store = places
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    append(spark, log, votes(0, 3000, lambda k: "hot" if k % 3 else f"tt{k}"))
    try:
        vote_runs.compact(spark, log, store)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in vote_runs.stored_votes(spark, store, vote_runs.newest_manifest(spark, store)).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1500


def test_two_writers_of_a_manifest(spark, tmp_path):
    path = str(tmp_path / "one.json")
    vote_runs.put_text(spark, path, "1")
    with pytest.raises(FileExistsError):
        vote_runs.put_text(spark, path, "2")
    assert vote_runs.get_text(spark, path) == "1"


# Totals of stored votes -------------------------------------------------


def batch(spark, rows):
    return spark.createDataFrame(rows, "msg_offset bigint, seconds double, value string").select(
        "msg_offset", F.timestamp_seconds("seconds").alias("ts"), "value"
    )


def plain(batches):
    """title → (keys, sum of the puts that stay)."""
    last, out = {}, {}
    for offset, seconds, value in sorted(r for rows in batches for r in rows):
        title, _, vote = value.strip('"').partition("_")
        if vote.isdigit():
            last[title, round(seconds * 1000)] = int(vote)
    for (title, _), vote in last.items():
        n, s = out.get(title, (0, 0))
        out[title] = (n + 1, s + vote)
    return out


def read(spark, path):
    return {r["tconst"]: (r["dn"], r["ds"]) for r in totals.stored_totals(spark, path).collect()}


BATCHES = [
    [(1, 5.0, '"a_5"'), (2, 5.0, '"a_1"'), (3, 6.0, '"a_2"'), (4, 5.0, '"b_3"'), (5, 1.0, '"bad"')],  # within a batch
    [(6, 5.0, '"a_4"'), (7, 90_000.0, '"a_4"'), (8, 5.0, '"c_1"')],  # across batches, and another day
    [],
    [(10, 6.0, '"a_2"'), (9, 5.0, '"b_1"'), (11, 90_000.0, '"a_1"')],  # the same vote again
    [(0, 5.0, '"a_5"')],  # arrives late, does not win
]


def test_overwritten_votes_are_taken_back(spark, tmp_path):
    path = str(tmp_path / "totals")
    for k, rows in enumerate(BATCHES):
        for _ in range(2):  # a batch done twice
            totals.add_batch(batch(spark, rows), k, path)
            assert read(spark, path) == plain(BATCHES[: k + 1])


def test_sums_of_changes_and_cleaning(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(totals, "SUMMED_EVERY", 2)
    path = str(tmp_path / "totals")
    done = []
    for k in range(7):
        rows = [(10 * k + i, float(i % 4), f'"{"abc"[i % 3]}_{(k + i) % 5}"') for i in range(6)]
        done.append(rows)
        totals.add_batch(batch(spark, rows), k, path)
        if k % 2:
            totals.add_batch(batch(spark, rows), k, path)
        assert read(spark, path) == plain(done)
    assert totals._batches(spark, f"{path}/base") == [3, 5]
    assert totals._batches(spark, f"{path}/changes") == [4, 5, 6]


def test_totals_equal_those_of_the_latest_votes(spark):
    rows = spark.createDataFrame([(k, f"t{k % 3}", k % 11, k % 5) for k in range(300)], VOTE_STORE.fieldNames())
    rows = rows.selectExpr("msg_offset", "tconst", "ts_ms", "cast(vote as int) vote")
    got = totals.changes(totals.last_puts(rows), rows.limit(0))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, vote_totals(latest_votes(rows)).collect()))
