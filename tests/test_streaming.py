"""Streams against the batch results of the same messages."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from marquee.operators import ratings as rating_ops
from marquee.operators.votes import rejected_messages, vote_log, vote_totals
from marquee.registry import adapters
from marquee.schemas import RAW_SCHEMAS
from marquee.sinks.tables import write_copy
from marquee.sources.messages import file_messages
from marquee.sources.tables import load_folded_ratings, load_newest_ratings, load_table
from marquee.sources.votes import (
    latest_by_title,
    read_quarantine,
    read_vote_log,
    totals_in_state,
)
from marquee.streaming import votes as streams


@pytest.fixture(scope="module")
def files(spark, small, tmp_path_factory):
    """The small vote messages in three files."""
    folder = str(tmp_path_factory.mktemp("messages"))
    adapters.messages(spark, small).repartition(3, "msg_offset").write.mode("overwrite").parquet(
        folder
    )
    return folder


@pytest.fixture
def batch(spark, files):
    return spark.read.parquet(files)


@pytest.fixture
def stream(spark, files):
    """One file per micro-batch, so state has to carry over."""
    return file_messages(spark, files, files_per_batch=1)


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_log_equals_batch_parse_and_restarts_add_nothing(spark, stream, batch, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    for _ in range(2):
        finish(streams.start_message_log(stream, log, checkpoint, once=True))
    votes, rejected = read_vote_log(spark, log), read_quarantine(spark, log)
    assert rows(votes) == rows(vote_log(batch))
    assert rows(rejected.select("msg_offset", "value")) == rows(
        rejected_messages(batch).select("msg_offset", "value")
    )
    assert votes.count() + rejected.count() == batch.count()


def test_log_goes_on_with_new_files(spark, batch, tmp_path):
    source, log, checkpoint = (str(tmp_path / name) for name in ("in", "log", "checkpoint"))
    halves = [batch.where("msg_offset % 2 = 0"), batch.where("msg_offset % 2 = 1")]
    for half in halves:
        half.write.mode("append").parquet(source)
        finish(streams.start_message_log(file_messages(spark, source), log, checkpoint, once=True))
    assert rows(read_vote_log(spark, log)) == rows(vote_log(batch))


def test_running_totals_equal_batch_totals(spark, stream, batch, tmp_path):
    path = str(tmp_path / "totals")
    finish(streams.start_totals(stream, path, str(tmp_path / "checkpoint"), once=True))
    totals = latest_by_title(spark, path, streams.TOTALS_SCHEMA)
    assert rows(totals) == rows(vote_totals(vote_log(batch)))
    assert rows(totals_in_state(spark, str(tmp_path / "checkpoint"))) == rows(totals)
    # Titles voted on in several batches were written more than once.
    assert spark.read.parquet(path).count() > totals.count()


def test_live_ratings_equal_batch_merge(spark, small, stream, batch, tmp_path):
    path = str(tmp_path / "live")
    ratings = adapters.ratings(spark, small)
    finish(streams.start_live_ratings(stream, ratings, path, str(tmp_path / "cp"), once=True))
    live = latest_by_title(spark, f"{path}/ratings", streams.MERGED_SCHEMA)
    expected = rating_ops.merge_voted(ratings, vote_totals(vote_log(batch)))
    assert rows(live) == rows(expected)


def test_folding_batch_by_batch_equals_folding_at_once(spark, small, stream, batch, tmp_path):
    root = str(tmp_path / "ratings")
    ratings = adapters.ratings(spark, small)
    query = finish(streams.start_folding(stream, ratings, root, str(tmp_path / "cp"), once=True))
    last = query.lastProgress["batchId"]
    assert last == 2

    def rounded(frame):
        return rows(frame.withColumn("averageRating", F.round("averageRating", 9)))

    folded = load_folded_ratings(spark, root, last)
    assert rounded(folded) == rounded(rating_ops.fold_votes(ratings, vote_log(batch)))


def test_writing_a_batch_again_replaces_it(spark, tmp_path):
    for total in (3, 4):
        rows_of_batch = spark.createDataFrame([("tt1", total, 9)], streams.TOTALS_SCHEMA)
        streams.write_batch(rows_of_batch, str(tmp_path), 0)
    assert rows(latest_by_title(spark, str(tmp_path), streams.TOTALS_SCHEMA)) == [("tt1", 4, 9)]


def test_small_batches_are_broadcast_past_the_ratings(spark, small, tmp_path):
    """Chosen by Spark from the size of the batch's files."""
    streams.write_batch(
        spark.createDataFrame([("tt0000012", 1, 5)], streams.TOTALS_SCHEMA), str(tmp_path), 0
    )
    changed = spark.read.schema(streams.TOTALS_SCHEMA).parquet(
        streams.batch_folder(str(tmp_path), 0)
    )
    merged = rating_ops.merge_voted(adapters.ratings(spark, small), changed)
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning(tconst" not in text


def test_streams_go_on_after_a_refresh(spark, batch, tmp_path):
    """Ratings are replaced between two batches: both streams see the new ones."""
    warehouse, source = str(tmp_path / "w"), str(tmp_path / "in")
    load = partial(load_table, spark, warehouse, "title_ratings")
    halves = [batch.where("msg_offset % 2 = 0"), batch.where("msg_offset % 2 = 1")]
    for average, half in zip(("8.0", "2.0"), halves):
        table = spark.createDataFrame([("tt0000012", average, 10)], RAW_SCHEMAS["title_ratings"])
        write_copy(table, warehouse, "title_ratings")
        half.write.mode("append").parquet(source)
        for start, name in ((streams.start_live_ratings, "live"), (streams.start_folding, "fold")):
            messages = file_messages(spark, source)
            finish(start(messages, load, str(tmp_path / name), str(tmp_path / f"cp-{name}"), once=True))

    def rounded(frame):
        return rows(frame.withColumn("averageRating", F.round("averageRating", 9)))

    expected = rating_ops.fold_votes(load(), vote_log(batch))
    assert rounded(load_newest_ratings(spark, str(tmp_path / "fold"))) == rounded(expected)
    live = latest_by_title(spark, str(tmp_path / "live" / "ratings"), streams.MERGED_SCHEMA)
    one = live.where("tconst = 'tt0000012'").select("tconst", "averageRating", "numVotes")
    totals = vote_totals(vote_log(batch)).where("tconst = 'tt0000012'")
    assert rounded(one) == rounded(rating_ops.merge_voted(load(), totals))


def test_a_reader_keeps_its_version(spark, tmp_path):
    tables = [spark.createDataFrame([(f"tt{k}", "1.0", k)], RAW_SCHEMAS["title_ratings"]) for k in range(5)]
    write_copy(tables[0], str(tmp_path), "title_ratings")
    first = load_table(spark, str(tmp_path), "title_ratings")
    for table in tables[1:3]:
        write_copy(table, str(tmp_path), "title_ratings")
    assert rows(first) == [("tt0", "1.0", 0)]
    assert rows(load_table(spark, str(tmp_path), "title_ratings")) == [("tt2", "1.0", 2)]
    for table in tables[3:]:
        write_copy(table, str(tmp_path), "title_ratings")
    assert sorted(p.name for p in (tmp_path / "title_ratings_parquet").glob("version=*")) == ["version=3", "version=4", "version=5"]
