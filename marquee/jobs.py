"""The jobs for ``spark-submit``.

    refresh LANDING WAREHOUSE            dumps → tables
    report NAME WAREHOUSE OUT            one report as JSON lines
    log SERVERS LOG CHECKPOINT           topic → message log
    compact LOG STORE                    new votes of the message log → runs in key order
    live SERVERS WAREHOUSE OUT CHECKPOINT    topic → ratings of the titles that change
    fold SERVERS WAREHOUSE ROOT CHECKPOINT   topic → versions of the ratings table
    range-fold SERVERS WAREHOUSE ROOT CHECKPOINT   topic → ratings by key ranges, touched ones rewritten
    totals SERVERS OUT CHECKPOINT        topic → running totals
    stored-totals SERVERS OUT CHECKPOINT     topic → totals of a store that overwrites equal keys
    rating TITLE WAREHOUSE LOG STORE OUT rating of a title with all votes up to now, as JSON
    votes TITLE LOG STORE OUT            all votes of a title up to now, as JSON lines

``--shuffle-bytes N`` before the job's name says how much its largest shuffle is
expected to move; ``--strict`` makes the streams take plain title ids only.
"""

from __future__ import annotations

import sys
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from marquee.functions.display import json_records
from marquee.operators.ratings import merged_rating_by_id
from marquee.operators.votes import keyed_records, range_scan
from marquee.plans import analytics
from marquee.plans.ingest import refresh
from marquee.session import build_session
from marquee.sources.messages import topic_messages
from marquee.sources.tables import load_table, load_titles
from marquee.streaming.range_folds import start_range_folding
from marquee.streaming.stored_totals import start_stored_totals
from marquee.streaming.votes import (
    start_folding,
    start_live_ratings,
    start_message_log,
    start_totals,
)
from marquee.versions import pinned
from marquee.vote_runs import compact, current_votes


def report(spark: SparkSession, name: str, warehouse: str, at: dict[str, int] | None = None) -> DataFrame:
    """A report over the tables of a warehouse, in the versions ``at`` or the newest."""
    titles = load_titles(spark, warehouse, at)
    if name == "genre_by_decade":
        return analytics.genre_by_decade(titles)
    ratings = load_table(spark, warehouse, "title_ratings", at)
    if name == "votes_by_title_type":
        return analytics.votes_by_title_type(titles, ratings)
    if name == "top_directors":
        crew = load_table(spark, warehouse, "title_crew", at)
        names = load_table(spark, warehouse, "name_basics", at)
        return analytics.director_records(analytics.top_directors(crew, ratings, titles, names))
    raise ValueError(f"no such report: {name}")


def run_refresh(spark: SparkSession, landing: str, warehouse: str) -> None:
    refresh(spark, landing, warehouse)


def run_report(spark: SparkSession, name: str, warehouse: str, out: str) -> None:
    """All tables as the newest refresh left them, whatever is written meanwhile."""
    with pinned(spark, warehouse) as at:
        json_records(report(spark, name, warehouse, at)).write.mode("overwrite").text(out)


def run_log(spark: SparkSession, servers: str, log: str, checkpoint: str, strict: bool = False) -> None:
    messages = topic_messages(spark, servers)
    start_message_log(messages, log, checkpoint, strict=strict).awaitTermination()


def run_compact(spark: SparkSession, log: str, store: str) -> None:
    compact(spark, log, store)


def run_live(
    spark: SparkSession, servers: str, warehouse: str, out: str, checkpoint: str, strict: bool = False
) -> None:
    messages = topic_messages(spark, servers)
    ratings = partial(load_table, spark, warehouse, "title_ratings")
    start_live_ratings(messages, ratings, out, checkpoint, strict=strict).awaitTermination()


def run_fold(
    spark: SparkSession, servers: str, warehouse: str, root: str, checkpoint: str, strict: bool = False
) -> None:
    messages = topic_messages(spark, servers)
    ratings = partial(load_table, spark, warehouse, "title_ratings")
    start_folding(messages, ratings, root, checkpoint, strict=strict).awaitTermination()


def run_range_fold(
    spark: SparkSession, servers: str, warehouse: str, root: str, checkpoint: str, strict: bool = False
) -> None:
    messages = topic_messages(spark, servers)
    ratings = partial(load_table, spark, warehouse, "title_ratings")
    start_range_folding(messages, ratings, root, checkpoint, strict=strict).awaitTermination()


def run_totals(spark: SparkSession, servers: str, out: str, checkpoint: str, strict: bool = False) -> None:
    messages = topic_messages(spark, servers)
    start_totals(messages, out, checkpoint, strict=strict).awaitTermination()


def run_stored_totals(spark: SparkSession, servers: str, out: str, checkpoint: str, strict: bool = False) -> None:
    messages = topic_messages(spark, servers)
    start_stored_totals(messages, out, checkpoint, strict=strict).awaitTermination()


def run_rating(spark: SparkSession, title: str, warehouse: str, log: str, store: str, out: str) -> None:
    """Of the store only the files that may hold the title are read, of the log what is newer."""
    ratings = load_table(spark, warehouse, "title_ratings")
    votes = current_votes(spark, log, store, title)
    json_records(merged_rating_by_id(ratings, votes, title)).write.mode("overwrite").text(out)


def run_votes(spark: SparkSession, title: str, log: str, store: str, out: str) -> None:
    records = keyed_records(range_scan(current_votes(spark, log, store), title))
    json_records(records).write.mode("overwrite").text(out)


JOBS = {
    "refresh": run_refresh,
    "report": run_report,
    "log": run_log,
    "compact": run_compact,
    "live": run_live,
    "fold": run_fold,
    "range-fold": run_range_fold,
    "totals": run_totals,
    "stored-totals": run_stored_totals,
    "rating": run_rating,
    "votes": run_votes,
}
STREAMS = {"log", "live", "fold", "range-fold", "totals", "stored-totals"}


def main(arguments: list[str]) -> None:
    shuffle_bytes, strict, rest = None, {}, list(arguments)
    while rest and rest[0].startswith("--"):
        option = rest.pop(0)
        if option == "--shuffle-bytes" and rest:
            shuffle_bytes = int(rest.pop(0))
        elif option == "--strict":
            strict = {"strict": True}
        else:
            raise SystemExit(__doc__)
    if not rest or rest[0] not in JOBS or (strict and rest[0] not in STREAMS):
        raise SystemExit(__doc__)
    job, *rest = rest
    session = build_session(f"marquee-{job}", largest_shuffle_bytes=shuffle_bytes)
    JOBS[job](session, *rest, **strict)


if __name__ == "__main__":
    main(sys.argv[1:])
