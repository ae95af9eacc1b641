"""Scans of what the vote streams wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schemas import MESSAGE_LOG, VOTE_LOG_COLUMNS, VOTE_STORE
from marquee.versions import newest, numbered


def read_message_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_LOG).parquet(path)


def read_vote_log(spark: SparkSession, path: str) -> DataFrame:
    """Accepted votes; the filter prunes the folder of rejected messages."""
    return read_message_log(spark, path).where("accepted").select(*VOTE_LOG_COLUMNS)


def read_vote_store(spark: SparkSession, path: str) -> DataFrame:
    """Votes as ``write_vote_store`` left them."""
    return spark.read.schema(VOTE_STORE).parquet(newest(spark, path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected messages with their original text."""
    return (
        read_message_log(spark, path).where("not accepted").select("msg_offset", "ts_ms", "value")
    )


def _state_totals(state: DataFrame, *others: str) -> DataFrame:
    totals = F.col("value.count").alias("dn"), F.col("value.sum").alias("ds")
    return state.select("key.tconst", *totals, *others)


def totals_in_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The present totals of a totals stream, from its own state, or those after a batch.

    One row per voted title, however many batches there were.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    return _state_totals(reader.load(checkpoint))


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The newest batch that a stream has committed; -1 before the first."""
    return max(numbered(spark, f"{checkpoint}/commits", suffix=""), default=-1)


def changes_in_state(spark: SparkSession, checkpoint: str, after: int, upto: int | None = None) -> DataFrame:
    """Totals of the titles that batches after ``after`` touched, as the last of these left them.

    Read from the state's change files of these batches, so the cost follows what
    changed, not the age of the stream or the number of titles. A reader keeps the
    ``upto`` of one call (``last_batch`` by default) as ``after`` of the next, starting
    with ``totals_in_state(spark, checkpoint, batch)``. A stream keeps the files of
    its last ``spark.sql.streaming.minBatchesToRetain`` batches: whoever comes later
    than that gets an error from Spark and starts over.
    """
    upto = last_batch(spark, checkpoint) if upto is None else upto
    if upto <= after:
        return spark.createDataFrame([], "tconst STRING, dn BIGINT, ds BIGINT")
    reader = spark.read.format("statestore").option("readChangeFeed", True)
    feed = reader.option("changeStartBatchId", after + 1).option("changeEndBatchId", upto).load(checkpoint)
    rows = _state_totals(feed, "batch_id")
    last = F.max_by(F.struct("dn", "ds"), "batch_id").alias("last")
    return rows.groupBy("tconst").agg(last).select("tconst", "last.dn", "last.ds")


def with_changes(totals: DataFrame, changed: DataFrame) -> DataFrame:
    """Totals brought up to date: changed titles as they are now, others as before."""
    return totals.join(changed, "tconst", "left_anti").unionByName(changed)


def latest_by_title(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows written per micro-batch, reduced to the newest one of each title.

    ``schema`` lists the columns of the rows, ``tconst`` among them.
    """
    rows = spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path)
    values = [name for name in rows.columns if name not in ("tconst", "batch_id")]
    newest = [F.max_by(name, "batch_id").alias(name) for name in values]
    return rows.groupBy("tconst").agg(*newest)
