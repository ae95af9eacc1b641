"""One entry per operator or report, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import versions, vote_runs
from marquee.functions.display import json_records
from marquee.operators import catalogue, ratings, series, votes
from marquee.plans import analytics, ingest
from marquee.registry import adapters
from marquee.schemas import COPIED_TABLES
from marquee.session import scratch_dir
from marquee.sinks.tables import write_copy, write_folded_ratings, write_raw, write_titles
from marquee.sinks.votes import write_vote_store
from marquee.sources.messages import file_messages
from marquee.sources.tables import load_folded_ratings, load_raw, load_table, load_titles
from marquee.sources.votes import (
    changes_in_state,
    last_batch,
    latest_by_title,
    read_quarantine,
    read_vote_log,
    read_vote_store,
    totals_in_state,
    with_changes,
)
from marquee.streaming import stored_totals
from marquee.streaming import votes as vote_streams
from marquee.streaming.range_folds import load_folded_ranges, start_range_folding

Query = Callable[[SparkSession, str], DataFrame]

# Arguments of the keyed queries.
TITLE_ID = "tt0000012"
GENRE = "ring"
DIGITS = 6


# Scans and sinks --------------------------------------------------------


def _scan(table: str) -> Query:
    """Write the Parquet copy of a table and scan it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = scratch_dir(spark, f"scan-{table}")
        write_copy(adapters.raw_table(spark, sf_dir, table), warehouse, table)
        return load_table(spark, warehouse, table)

    return query


def _tsv_roundtrip(table: str) -> Query:
    """Write a gzip dump, land it as a raw table and scan that."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark, f"dump-{table}")
        adapters.write_dump(adapters.raw_table(spark, sf_dir, table), f"{folder}/landing")
        ingest.land_dump(spark, f"{folder}/landing", folder, table)
        return load_raw(spark, folder, table)

    return query


def _parquet_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Convert all six tables; rows and total text length of each copy, measured while it is written."""
    warehouse = scratch_dir(spark, "conversion")
    copied = {}

    def convert(table: str) -> None:
        write_raw(adapters.raw_table(spark, sf_dir, table), warehouse, table)
        copied[table] = ingest.convert_table(spark, warehouse, table)

    ingest.at_once(lambda table=table: convert(table) for table in COPIED_TABLES)
    lines = [(table, copied[table]["n_rows"], copied[table]["n_chars"]) for table in COPIED_TABLES]
    return spark.createDataFrame(lines, "table_name STRING, n_rows BIGINT, n_chars BIGINT")


def _partitioned_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = scratch_dir(spark, "titles")
    write_titles(adapters.raw_table(spark, sf_dir, "title_basics"), warehouse)
    return load_titles(spark, warehouse)


def _result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_records(_genre_by_decade(spark, sf_dir))


# Previews and lookup ----------------------------------------------------


def _preview_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.preview(adapters.names(spark, sf_dir), "nconst", "primaryName", key="nconst")


def _preview_akas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.preview(adapters.akas(spark, sf_dir), "title", "region", key="titleId")


def _rating_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored copy, so that the lookup is one pushed to the scan."""
    warehouse = scratch_dir(spark, "rating-by-id")
    write_copy(adapters.raw_table(spark, sf_dir, "title_ratings"), warehouse, "title_ratings")
    return ratings.rating_by_id(load_table(spark, warehouse, "title_ratings"), TITLE_ID)


def _rating_by_id_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy whose Bloom filters are sized by the keys that were counted at landing."""
    warehouse = scratch_dir(spark, "rating-by-id-bloom")
    write_raw(adapters.raw_table(spark, sf_dir, "title_ratings"), warehouse, "title_ratings")
    ingest.convert_table(spark, warehouse, "title_ratings")
    return ratings.rating_by_id(load_table(spark, warehouse, "title_ratings"), TITLE_ID)


# Reports ----------------------------------------------------------------


def _genre_by_decade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.genre_by_decade(adapters.titles(spark, sf_dir))


def _votes_by_title_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.votes_by_title_type(
        adapters.titles(spark, sf_dir), adapters.ratings(spark, sf_dir)
    )


def _film_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(f(spark, sf_dir) for f in (adapters.crew, adapters.ratings, adapters.titles))


def top_directors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_directors(
        *_film_tables(spark, sf_dir), adapters.names(spark, sf_dir), digits=DIGITS
    )


def _director_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.director_records(top_directors(spark, sf_dir))


def _director_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.director_labels(top_directors(spark, sf_dir))


def _title_type_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.title_type_labels(_votes_by_title_type(spark, sf_dir))


def _snapshot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in the midst of a refresh: ratings without votes are written, but not committed."""
    warehouse = scratch_dir(spark, "snapshot-report")
    rated = adapters.raw_table(spark, sf_dir, "title_ratings")
    write_titles(adapters.raw_table(spark, sf_dir, "title_basics"), warehouse)
    write_copy(rated, warehouse, "title_ratings")
    tables = versions.subfolders(spark, warehouse)
    versions.commit(spark, warehouse, {t: versions.newest_version(spark, f"{warehouse}/{t}") for t in tables})
    write_copy(rated.withColumn("numVotes", F.lit(0)), warehouse, "title_ratings")
    at = versions.present(spark, warehouse)
    return analytics.votes_by_title_type(
        load_titles(spark, warehouse, at), load_table(spark, warehouse, "title_ratings", at)
    )


# Parts of the reports ---------------------------------------------------


def _movie_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.titles_of_type(adapters.titles(spark, sf_dir), "movie")


def _director_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.explode_directors(adapters.crew(spark, sf_dir))


def _crew_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.crew_ratings(*_film_tables(spark, sf_dir)[:2])


def _movie_crew_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.movie_crew_ratings(*_film_tables(spark, sf_dir))


def _bucketed(spark: SparkSession, sf_dir: str, *tables: str) -> list[DataFrame]:
    """Bucketed catalog tables; the names go, the frames and files stay."""
    warehouse = scratch_dir(spark, "bucketed")
    frames = []
    for table in tables:
        raw = adapters.raw_table(spark, sf_dir, table)
        if table == "title_basics":
            write_titles(raw, warehouse)
        else:
            write_copy(raw, warehouse, table)
    buckets = ingest.buckets_for(spark, warehouse, tables)
    for table in tables:
        name = f"{table}_{warehouse[-32:]}"
        ingest.bucket_table(spark, warehouse, table, buckets, name)
        frames.append(spark.table(name))
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return frames


def _bucketed_movie_crew_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crew has several rows per title here and is joined to the bucketed tables."""
    rated, titles = _bucketed(spark, sf_dir, "title_ratings", "title_basics")
    return catalogue.movie_crew_ratings(adapters.crew(spark, sf_dir), rated, titles)


def _bucketed_rating_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.rating_by_id(*_bucketed(spark, sf_dir, "title_ratings"), TITLE_ID)


def _director_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.director_titles(*_film_tables(spark, sf_dir), adapters.names(spark, sf_dir))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = catalogue.director_averages(
        *_film_tables(spark, sf_dir), adapters.names(spark, sf_dir)
    )
    return catalogue.director_scores(averages, DIGITS)


def _director_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).drop("weightedScore")


# Votes ------------------------------------------------------------------


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.vote_log(adapters.messages(spark, sf_dir))


def _votes_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.parse_votes(adapters.messages(spark, sf_dir)).drop("ts")


def _votes_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.rejected_messages(adapters.messages(spark, sf_dir)).drop("ts")


def _vote_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.in_key_order(_votes(spark, sf_dir))


def _vote_records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_records(votes.vote_records(_vote_log(spark, sf_dir)))


def _vote_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.latest_votes(_votes(spark, sf_dir))


def _vote_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the votes in key order and read the range of one key."""
    store = scratch_dir(spark, "vote-store")
    write_vote_store(_votes(spark, sf_dir), store)
    return votes.range_scan(read_vote_store(spark, store), TITLE_ID)


def _vote_snapshot_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older half of the messages is compacted into the store, the newer half only logged."""
    folder = scratch_dir(spark, "vote-runs")
    log, store = f"{folder}/log", f"{folder}/store"
    messages = adapters.messages(spark, sf_dir)
    # The events have one row of offsets, as a topic with one partition.
    one_partition = lambda offset: F.lit(0)
    middle = messages.agg(F.floor(F.avg("msg_offset"))).head()[0]
    is_old = F.col("msg_offset") <= F.lit(middle).cast("bigint")
    for half in (is_old, ~is_old):
        vote_streams.logged(messages.where(half)).write.mode("append").partitionBy("accepted").parquet(log)
        if half is is_old:
            vote_runs.compact(spark, log, store, one_partition)
    found = vote_runs.current_votes(spark, log, store, TITLE_ID, one_partition)
    return votes.range_scan(found, TITLE_ID)


def _recent_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.recent_votes(_votes(spark, sf_dir))


def _vote_key_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.key_parts(_votes(spark, sf_dir))


def _vote_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.vote_count(_votes(spark, sf_dir))


def _vote_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.vote_totals(_votes(spark, sf_dir))


def _stored_vote_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.vote_totals(_vote_latest(spark, sf_dir))


def _vote_messages_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.encode_messages(_votes(spark, sf_dir))


# Ratings ----------------------------------------------------------------


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("averageRating", F.round("averageRating", DIGITS))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.merged_ratings(adapters.ratings(spark, sf_dir), _votes(spark, sf_dir))


def _merged_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_merged(spark, sf_dir))


def _merged_rating_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        ratings.merged_rating_by_id(
            adapters.ratings(spark, sf_dir), _votes(spark, sf_dir), TITLE_ID
        )
    )


def _merged_ratings_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        ratings.merged_ratings_contains(adapters.ratings(spark, sf_dir), _votes(spark, sf_dir))
    )


def _ratings_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "ratings")
    folded = ratings.fold_votes(adapters.ratings(spark, sf_dir), _votes(spark, sf_dir))
    write_folded_ratings(folded, root, version=1)
    return _rounded(load_folded_ratings(spark, root, version=1))


def _ratings_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.rating_labels(_merged(spark, sf_dir))


# Streams ----------------------------------------------------------------


def _logged_stream(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_dir(spark, "message-log")
    vote_streams.start_message_log(
        adapters.message_stream(spark, sf_dir), f"{folder}/log", f"{folder}/checkpoint", once=True
    ).awaitTermination()
    return f"{folder}/log"


def _vote_stream_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_vote_log(spark, _logged_stream(spark, sf_dir))


def _vote_stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_quarantine(spark, _logged_stream(spark, sf_dir))


def _vote_stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "totals")
    vote_streams.start_totals(
        adapters.message_stream(spark, sf_dir), f"{folder}/rows", f"{folder}/checkpoint", once=True
    ).awaitTermination()
    return latest_by_title(spark, f"{folder}/rows", vote_streams.TOTALS_SCHEMA)


def _vote_stream_state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "state-totals")
    vote_streams.start_totals(
        adapters.message_stream(spark, sf_dir), f"{folder}/rows", f"{folder}/checkpoint", once=True
    ).awaitTermination()
    return totals_in_state(spark, f"{folder}/checkpoint")


def _vote_stream_stored_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "stored-totals")
    stored_totals.start_stored_totals(
        adapters.message_stream(spark, sf_dir), f"{folder}/totals", f"{folder}/checkpoint", once=True
    ).awaitTermination()
    return stored_totals.stored_totals(spark, f"{folder}/totals")


def _vote_stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that took the totals after the older half of the messages, and then what changed."""
    folder = scratch_dir(spark, "state-changes")
    messages = adapters.messages(spark, sf_dir)
    middle = messages.agg(F.floor(F.avg("msg_offset"))).head()[0]
    is_old = F.col("msg_offset") <= F.lit(middle).cast("bigint")
    for half in (is_old, ~is_old):
        messages.where(half).write.mode("append").parquet(f"{folder}/messages")
        vote_streams.start_totals(
            file_messages(spark, f"{folder}/messages"), f"{folder}/rows", f"{folder}/checkpoint", once=True
        ).awaitTermination()
        if half is is_old:
            mark = last_batch(spark, f"{folder}/checkpoint")
    before = totals_in_state(spark, f"{folder}/checkpoint", mark)
    changed = changes_in_state(spark, f"{folder}/checkpoint", mark)
    return with_changes(before, changed)


def _vote_stream_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "live-ratings")
    vote_streams.start_live_ratings(
        adapters.message_stream(spark, sf_dir),
        adapters.ratings(spark, sf_dir),
        folder,
        f"{folder}/checkpoint",
        once=True,
    ).awaitTermination()
    return _rounded(latest_by_title(spark, f"{folder}/ratings", vote_streams.MERGED_SCHEMA))


def _vote_stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "folding")
    query = vote_streams.start_folding(
        adapters.message_stream(spark, sf_dir),
        adapters.ratings(spark, sf_dir),
        f"{folder}/ratings",
        f"{folder}/checkpoint",
        once=True,
    )
    query.awaitTermination()
    return _rounded(load_folded_ratings(spark, f"{folder}/ratings", query.lastProgress["batchId"]))


def _vote_stream_range_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "range-folding")
    start_range_folding(
        adapters.message_stream(spark, sf_dir),
        adapters.ratings(spark, sf_dir),
        f"{folder}/ratings",
        f"{folder}/checkpoint",
        once=True,
    ).awaitTermination()
    return _rounded(load_folded_ranges(spark, f"{folder}/ratings"))


# Chart data -------------------------------------------------------------


def _genre_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.genre_list(_genre_by_decade(spark, sf_dir))


def _decade_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.decade_list(_genre_by_decade(spark, sf_dir))


def _decade_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.decade_ticks(series.distinct_decades(_genre_by_decade(spark, sf_dir)))


def _genre_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series with their points as text, ``decade:count`` joined by commas."""
    points = F.transform(
        "points", lambda p: F.concat_ws(":", p["decade"].cast("string"), p["count"].cast("string"))
    )
    return series.genre_series(_genre_by_decade(spark, sf_dir)).select(
        "genre", F.array_join(points, ",").alias("points")
    )


def _genre_series_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.series_of_genre(_genre_by_decade(spark, sf_dir), GENRE)


def _axis_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.axis_maxima(
        _genre_by_decade(spark, sf_dir),
        _votes_by_title_type(spark, sf_dir),
        top_directors(spark, sf_dir),
    )


QUERIES: dict[str, Query] = {
    "scan_names": _scan("name_basics"),
    "scan_akas": _scan("title_akas"),
    "scan_crew": _scan("title_crew"),
    "scan_episodes": _scan("title_episode"),
    "scan_principals": _scan("title_principals"),
    "scan_ratings": _scan("title_ratings"),
    "tsv_roundtrip_ratings": _tsv_roundtrip("title_ratings"),
    "tsv_roundtrip_basics": _tsv_roundtrip("title_basics"),
    "parquet_conversion": _parquet_conversion,
    "partitioned_titles": _partitioned_titles,
    "result_json": _result_json,
    "preview_names": _preview_names,
    "preview_akas": _preview_akas,
    "rating_by_id": _rating_by_id,
    "rating_by_id_bloom": _rating_by_id_bloom,
    "genre_by_decade": _genre_by_decade,
    "votes_by_title_type": _votes_by_title_type,
    "snapshot_report": _snapshot_report,
    "top_directors": top_directors,
    "director_records": _director_records,
    "director_labels": _director_labels,
    "title_type_labels": _title_type_labels,
    "movie_titles": _movie_titles,
    "director_explode": _director_explode,
    "crew_ratings": _crew_ratings,
    "movie_crew_ratings": _movie_crew_ratings,
    "bucketed_movie_crew_ratings": _bucketed_movie_crew_ratings,
    "bucketed_rating_by_id": _bucketed_rating_by_id,
    "director_titles": _director_titles,
    "director_avg": _director_avg,
    "weighted_scores": _scores,
    "votes_parsed": _votes_parsed,
    "votes_rejected": _votes_rejected,
    "vote_log": _vote_log,
    "vote_records_json": _vote_records_json,
    "vote_latest": _vote_latest,
    "vote_range_scan": _vote_range_scan,
    "vote_snapshot_lookup": _vote_snapshot_lookup,
    "recent_votes": _recent_votes,
    "vote_key_parts": _vote_key_parts,
    "vote_count": _vote_count,
    "vote_totals": _vote_totals,
    "stored_vote_totals": _stored_vote_totals,
    "vote_messages_encode": _vote_messages_encode,
    "merged_ratings": _merged_ratings,
    "merged_rating_by_id": _merged_rating_by_id,
    "merged_ratings_contains": _merged_ratings_contains,
    "ratings_fold": _ratings_fold,
    "ratings_display": _ratings_display,
    "vote_stream_parsed": _vote_stream_parsed,
    "vote_stream_rejected": _vote_stream_rejected,
    "vote_stream_totals": _vote_stream_totals,
    "vote_stream_state_totals": _vote_stream_state_totals,
    "vote_stream_stored_totals": _vote_stream_stored_totals,
    "vote_stream_changes": _vote_stream_changes,
    "vote_stream_merged": _vote_stream_merged,
    "vote_stream_fold": _vote_stream_fold,
    "vote_stream_range_fold": _vote_stream_range_fold,
    "genre_list": _genre_list,
    "decade_list": _decade_list,
    "decade_ticks": _decade_ticks,
    "genre_series": _genre_series,
    "genre_series_one": _genre_series_one,
    "axis_maxima": _axis_maxima,
}
