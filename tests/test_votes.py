"""Vote messages and the vote log."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from marquee.functions.votes import key_millis, key_title, row_key
from marquee.operators import votes
from marquee.sinks.votes import write_vote_store
from marquee.sources.messages import topic_messages, topic_position
from marquee.sources.votes import read_vote_store

MESSAGES = [
    ('"tt0000001_5"', "tt0000001", 5),
    ('" tt2 _ 4 "', "tt2", 4),
    ('"\u3000tt2\t_\xa04\u2003"', "tt2", 4),
    ('"tt5_-3"', "tt5", -3),
    ('"tt6_+4"', "tt6", 4),
    ('"tt6_007"', "tt6", 7),
    ('"tt6_-0000000000000000000000000000000000008"', "tt6", -8),
    ('"tt6_2147483647"', "tt6", 2147483647),
    ('"tt6_-2147483648"', "tt6", -2147483648),
    ('"_5"', "", 5),
    ("xtt7_5y", "tt7", 5),
    ("_tt8_5_", "tt8", 5),
    ('"a\nb_5"', "a\nb", 5),
    ('"tt1_51-\n', None, None),
    ('"tt1_51\n', "tt1", 51),
    ('"tt1_x"', None, None),
    ('"tt1_2_3"', None, None),
    ('"tt9"', None, None),
    ('""', None, None),
    ("", None, None),
    ("_", None, None),
    ("tt3_5", None, None),
    ('"tt1_5.0"', None, None),
    ('"tt1_1e1"', None, None),
    ('"tt1_"', None, None),
    ('"tt1_+"', None, None),
    ('"tt1_\x005"', None, None),
    ('"tt1_2147483648"', None, None),
    ('"tt1_99999999999"', None, None),
    (None, None, None),
]


@pytest.fixture
def messages(spark):
    rows = [(i, value) for i, (value, _, _) in enumerate(MESSAGES)]
    return spark.createDataFrame(rows, "msg_offset bigint, value string")


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_messages_are_parsed_or_rejected(messages):
    expected = [(i, t, v) for i, (_, t, v) in enumerate(MESSAGES) if v is not None]
    assert sorted(rows(votes.parse_votes(messages))) == expected
    expected = [(i, m) for i, (m, _, v) in enumerate(MESSAGES) if v is None]
    assert sorted(rows(votes.rejected_messages(messages))) == expected


def test_bytes_are_decoded(spark):
    value = '"tté_5"'.encode()
    frame = spark.createDataFrame([(0, bytearray(value))], "msg_offset bigint, value binary")
    assert rows(votes.parse_votes(frame)) == [(0, "tté", 5)]


def test_strict_asks_for_an_id_and_stars(messages):
    kept = rows(votes.parse_votes(messages, strict=True))
    assert sorted({(t, v) for _, t, v in kept}) == [
        ("a\nb", 5),
        ("tt0000001", 5),
        ("tt2", 4),
        ("tt6", 4),
        ("tt7", 5),
        ("tt8", 5),
    ]
    assert len(kept) + votes.rejected_messages(messages, strict=True).count() == len(MESSAGES)


def vote_frame(spark, *values):
    return spark.createDataFrame(
        list(values), "msg_offset bigint, tconst string, ts_ms bigint, vote int"
    )


@pytest.fixture
def log(spark):
    return vote_frame(
        spark,
        (1, "tt1", 100, 5),
        (2, "tt10", 99, 4),
        (3, "tt1", 100, 2),
        (4, "tt1", 99, 1),
        (5, "att1", 300, 3),
        (6, "tt2", 300, 3),
    )


def test_time_is_cut_to_milliseconds(spark):
    moment = datetime(2024, 1, 1, 0, 0, 0, 999_999, timezone.utc)
    frame = spark.createDataFrame(
        [(7, moment, '"tt1_5"')], "msg_offset bigint, ts timestamp, value string"
    )
    assert rows(votes.vote_log(frame)) == [(7, "tt1", 1704067200999, 5)]


def test_scan_is_in_key_order(log):
    keys = rows(votes.in_key_order(log).select(row_key(F.col("tconst"), F.col("ts_ms"))))
    assert [k for (k,) in keys] == [
        "att1_300",
        "tt10_99",
        "tt1_100",
        "tt1_100",
        "tt1_99",
        "tt2_300",
    ]


def test_key_parts(log):
    key = row_key(F.col("tconst"), F.col("ts_ms"))
    parts = log.select(
        (key_title(key) == F.col("tconst")) & (key_millis(key) == F.col("ts_ms"))
    )
    assert rows(parts.distinct()) == [(True,)]


def test_last_write_wins(log):
    latest = rows(votes.latest_votes(log))
    assert ("tt1", 100, 2) in latest and len(latest) == 5
    totals = votes.vote_totals(votes.latest_votes(log)).where("tconst = 'tt1'")
    assert rows(totals) == [("tt1", 2, 3)]


def test_recent_votes_are_newest_first(log):
    assert rows(votes.recent_votes(log)) == [
        ("att1", 3, 300),
        ("tt2", 3, 300),
        ("tt1", 5, 100),
        ("tt1", 2, 100),
        ("tt1", 1, 99),
        ("tt10", 4, 99),
    ]


@pytest.mark.parametrize("tconst", ["tt1", "tt10", "tt", "1", "1_1", "99", "_", "", "x"])
def test_range_scan_equals_its_definition(log, tconst):
    keys = [(f"{t}_{ms}", v) for _, t, ms, v in rows(log)]
    expected = sorted((k, v) for k, v in keys if k >= tconst and tconst in k)
    assert sorted(rows(votes.range_scan(log, tconst))) == expected


def test_store_is_sorted_and_whole(spark, log, tmp_path):
    write_vote_store(log, str(tmp_path / "store"))
    stored = read_vote_store(spark, str(tmp_path / "store"))
    assert stored.columns == log.columns and sorted(rows(stored)) == sorted(rows(log))


def test_a_hot_title_spreads_over_the_store(spark, tmp_path):
    log = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("msg_offset"),
        F.when(F.col("id") % 3 == 0, "tt").otherwise(F.concat(F.lit("tt"), "id")).alias("tconst"),
        F.lit(5).cast("bigint").alias("ts_ms"),
        F.lit(1).alias("vote"),
    )
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        write_vote_store(log, str(tmp_path / "store"))
    finally:
        spark.conf.set(key, "true")
    stored = spark.read.parquet(str(tmp_path / "store"))
    hot = stored.where("tconst = 'tt'").groupBy(F.input_file_name()).count().collect()
    assert sum(row["count"] for row in hot) == 10_000 and len(hot) >= 3


def test_encoded_messages_parse_to_the_same_votes(spark):
    log = vote_frame(spark, (1, "tt1", 1, 5), (2, "", 1, 5), (3, "tt2", 1, 0), (4, "tt3", 1, 6))
    encoded = votes.encode_messages(log)
    assert rows(encoded) == [('"tt1_5"',)]
    assert rows(votes.parse_votes(encoded)) == [("tt1", 5)]
    odd = votes.encode_messages(vote_frame(spark, (1, 'a"b\\c\n', 1, 5)))
    assert rows(odd) == [('"a\\"b\\\\c\\n_5"',)]


def test_positions_in_a_topic_are_unique(spark):
    messages = spark.range(64).select(
        (F.col("id") % 4).cast("int").alias("partition"), F.floor(F.col("id") / 4).alias("offset")
    )
    placed = messages.select("*", topic_position(F.col("partition"), F.col("offset")).alias("at"))
    assert placed.select("at").distinct().count() == 64
    for partition in range(4):
        one = placed.where(F.col("partition") == partition).orderBy("offset")
        positions = [row["at"] for row in one.collect()]
        assert positions == sorted(positions)


def test_topic_needs_the_connector(spark):
    """The connector is no part of this installation; the options are passed on."""
    with pytest.raises(Exception, match="kafka"):
        topic_messages(spark, "localhost:9092", max_per_batch=100)
