"""Vote ingest, running totals, live ratings and periodic folding.

Each ``start_*`` function takes a stream of messages (see
``sources.messages``), starts a query and returns it. With ``once`` the query
works off what is there and stops. State, offsets and outputs are under paths
the caller names; on a cluster they must be shared storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from marquee.operators.ratings import fold_totals, merge_voted
from marquee.operators.votes import classify_messages, parse_votes, vote_totals
from marquee.schemas import MESSAGE_LOG
from marquee.sinks.tables import write_folded_ratings

#: The ratings, or a function that loads the present ones.
Ratings = DataFrame | Callable[[], DataFrame]

TOTALS_SCHEMA = "tconst STRING, dn BIGINT, ds BIGINT"
MERGED_SCHEMA = "tconst STRING, averageRating DOUBLE, numVotes BIGINT"


def triggered(
    writer: DataStreamWriter, checkpoint: str, once: bool, every: str
) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)


def present(ratings: Ratings) -> DataFrame:
    """The ratings as they are now: tables replaced by a refresh are looked up anew."""
    return ratings() if callable(ratings) else ratings


def logged(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Messages as rows of the log: accepted ones as votes, others with their text."""
    accepted = F.col("accepted")
    return (
        classify_messages(messages, strict)
        .withColumns(
            {
                "ts_ms": F.unix_millis("ts"),
                "tconst": F.when(accepted, F.col("tconst")),
                "vote": F.when(accepted, F.col("vote")),
                "value": F.when(~accepted, F.col("value")),
            }
        )
        .select(*MESSAGE_LOG.names)
    )


def start_message_log(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str = "1 minute",
    strict: bool = False,
) -> StreamingQuery:
    """Append every message to a Parquet log, accepted and rejected apart.

    One pass serves both: the log is partitioned by ``accepted``, read with
    ``read_vote_log`` and ``read_quarantine``. The file sink commits a batch
    as a whole, so a restart neither loses nor repeats a message.
    """
    writer = logged(messages, strict).writeStream.format("parquet").partitionBy("accepted").option("path", path)
    return triggered(writer, checkpoint, once, every).start()


def batch_folder(path: str, batch_id: int) -> str:
    """Where a batch's rows go. Doing a batch again replaces the folder."""
    return f"{path}/batch_id={batch_id}"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def start_totals(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str = "1 minute",
    strict: bool = False,
) -> StreamingQuery:
    """Running number and sum of votes per title.

    Each batch writes the new totals of the titles it touched; read the present
    ones with ``latest_by_title(spark, path, TOTALS_SCHEMA)``. The state holds
    two numbers per voted title.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    totals = vote_totals(parse_votes(messages, strict))
    writer = totals.writeStream.outputMode("update").foreachBatch(write)
    return triggered(writer, checkpoint, once, every).start()


def start_live_ratings(
    messages: DataFrame,
    ratings: Ratings,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str = "10 minutes",
    strict: bool = False,
) -> StreamingQuery:
    """Running totals merged with the batch rating of the titles that changed.

    Read with ``latest_by_title(spark, f"{path}/ratings", MERGED_SCHEMA)``, and
    the totals as in ``start_totals`` under ``{path}/totals``. A batch's totals
    are joined from their files, whose size is known: Spark broadcasts them
    past the ratings while they are small, and shuffles both when they are not.

    Each batch scans the ratings once, hence the long default interval. Give a
    function that loads them, so that a batch after a refresh sees the new ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{path}/totals", batch_id)
        changed = batch.sparkSession.read.schema(TOTALS_SCHEMA).parquet(
            batch_folder(f"{path}/totals", batch_id)
        )
        write_batch(merge_voted(present(ratings), changed), f"{path}/ratings", batch_id)

    totals = vote_totals(parse_votes(messages, strict))
    writer = totals.writeStream.outputMode("update").foreachBatch(write)
    return triggered(writer, checkpoint, once, every).start()


def start_folding(
    messages: DataFrame,
    ratings: Ratings,
    root: str,
    checkpoint: str,
    once: bool = False,
    every: str = "10 minutes",
    strict: bool = False,
) -> StreamingQuery:
    """Fold each batch of votes into a new version of the ratings table.

    Batch N adds its votes to the totals of batch N-1 and makes version N out of
    the ratings as they are then and these totals, so that doing a batch again
    adds nothing twice and a refreshed dump shows in the next version. Give a
    function that loads the ratings for that. The source's options for the batch
    size set how many votes are folded at a time. Of the versions only the newest
    is read, see ``load_newest_ratings``; older ones may be removed, the totals of
    the last two batches not.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        totals = vote_totals(parse_votes(batch, strict))
        if batch_id:
            before = spark.read.schema(TOTALS_SCHEMA).parquet(batch_folder(f"{root}/totals", batch_id - 1))
            both = before.unionByName(totals)
            totals = both.groupBy("tconst").agg(F.sum("dn").alias("dn"), F.sum("ds").alias("ds"))
        write_batch(totals, f"{root}/totals", batch_id)
        totals = spark.read.schema(TOTALS_SCHEMA).parquet(batch_folder(f"{root}/totals", batch_id))
        write_folded_ratings(fold_totals(present(ratings), totals), root, batch_id)

    writer = messages.writeStream.foreachBatch(fold)
    return triggered(writer, checkpoint, once, every).start()
