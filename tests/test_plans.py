"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from marquee.operators import ratings as rating_ops
from marquee.operators.catalogue import director_titles
from marquee.plans import ingest
from marquee.plans.analytics import genre_by_decade, top_directors, votes_by_title_type
from marquee.plans.ingest import bucket_table
from marquee.registry import adapters, queries
from marquee.schemas import COPIED_TABLES, MESSAGE_LOG
from marquee.sinks.tables import write_copy, write_titles
from marquee.sources.tables import load_table, load_titles
from marquee.sources.votes import read_vote_log


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def warehouse(spark, small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    for table in COPIED_TABLES:
        write_copy(adapters.raw_table(spark, small, table), folder, table)
    write_titles(adapters.raw_table(spark, small, "title_basics"), folder)
    return folder


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_no_pairwise_join_and_no_python_in_the_plan(spark, small, no_broadcast, name):
    text = plan(registered.queries()[name](spark, small))
    for node in ("NestedLoop", "Cartesian", "Python", "Pandas", "BroadcastHashJoin"):
        assert node not in text, node


def test_lookup_is_pushed_to_the_scan(spark, warehouse):
    ratings = load_table(spark, warehouse, "title_ratings")
    text = plan(rating_ops.rating_by_id(ratings, "tt0000012"))
    assert "EqualTo(tconst,tt0000012)" in text


def test_report_reads_two_columns_and_prunes_partitions(spark, warehouse):
    text = plan(genre_by_decade(load_titles(spark, warehouse)))
    assert "ReadSchema: struct<genres:string>" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(startYear#\d+\)\]", text)


def test_bucketed_tables_join_without_a_shuffle(spark, small, no_broadcast):
    rated, titles = queries._bucketed(spark, small, "title_ratings", "title_basics")
    text = plan(rated.join(titles, "tconst"))
    assert text.count("SortMergeJoin") == 1 and "Exchange" not in text


def test_more_bytes_give_more_buckets(spark, warehouse, monkeypatch):
    def buckets(size):
        monkeypatch.setattr(ingest, "stored_bytes", lambda spark, path: size)
        return ingest.buckets_for(spark, warehouse, ["title_ratings", "title_basics"])

    assert buckets(0) == 2
    assert buckets(40 * 2**30) == 2 * buckets(20 * 2**30) == 256


def test_decade_ticks_scan_the_titles_once(spark, small):
    rows = registered.queries()["decade_ticks"](spark, small)
    rows.collect()
    text = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert text.count("FileScan") == 1


def test_a_lookup_reads_one_bucket(spark, warehouse):
    bucket_table(spark, warehouse, "title_ratings", 16, "ratings_in_buckets")
    rows = spark.table("ratings_in_buckets")

    def tasks(frame):
        return frame._jdf.queryExecution().toRdd().getNumPartitions()

    assert tasks(rows) > 1
    assert tasks(rows.where("tconst = 'tt0000012'")) == 1
    assert rows.where("tconst = 'tt0000012'").count() == 1
    spark.sql("DROP TABLE ratings_in_buckets")


def test_rejected_messages_are_in_a_folder_of_their_own(spark, tmp_path):
    messages = [(1, 5, "tt1", 5, None, True), (2, 6, None, None, "x", False)]
    rows = spark.createDataFrame(messages, MESSAGE_LOG)
    rows.write.partitionBy("accepted").parquet(str(tmp_path / "log"))
    votes = read_vote_log(spark, str(tmp_path / "log"))
    assert [tuple(row) for row in votes.collect()] == [(1, "tt1", 5, 5)]
    assert re.search(r"PartitionFilters: \[[^]]*accepted#\d+", plan(votes))


def test_titles_and_ratings_meet_in_one_shuffle_each(spark, warehouse, no_broadcast):
    titles, ratings = load_titles(spark, warehouse), load_table(spark, warehouse, "title_ratings")
    text = plan(votes_by_title_type(titles, ratings))
    assert len(re.findall(r"Exchange hashpartitioning\(tconst", text)) == 2


def test_directors_share_the_shuffle_by_title(spark, warehouse, no_broadcast):
    crew, ratings = (load_table(spark, warehouse, t) for t in ("title_crew", "title_ratings"))
    titles, names = load_titles(spark, warehouse), load_table(spark, warehouse, "name_basics")
    text = plan(top_directors(crew, ratings, titles, names))
    # Three tables by title, sums by director, names by id, sums by name.
    assert len(re.findall(r"Exchange hashpartitioning\(tconst", text)) == 3
    assert len(re.findall(r"Exchange ", text)) == 6
    assert "TakeOrderedAndProject(limit=25" in text
    assert "EqualTo(titleType,movie)" in text
    assert "IsNotNull(directors)" in text and "IsNotNull(averageRating)" in text


def test_hot_directors_are_split_by_adaptive_execution(spark, warehouse, no_broadcast):
    """Rows joined with names stay rows, so the skewed join has to be split."""
    names = load_table(spark, warehouse, "name_basics").select("nconst", "primaryName")
    hot = spark.range(0, 300_000, 1, 16).select(
        F.concat(F.lit("tt"), "id").alias("tconst"),
        F.when(F.col("id") % 3 == 0, "nm0000001")
        .otherwise(F.concat(F.lit("nm"), "id"))
        .alias("directors"),
    )
    rated = hot.select("tconst", F.lit("5.0").alias("averageRating"))
    movies = hot.select("tconst", F.lit("movie").alias("titleType"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = director_titles(hot, rated, movies, names)
        joined.collect()
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_tables_with_several_rows_per_key_are_not_bucketed(spark, warehouse):
    with pytest.raises(KeyError):
        bucket_table(spark, warehouse, "title_principals", 4)
