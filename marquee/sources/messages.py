"""Vote messages, from a topic or from files.

Every reader returns ``msg_offset BIGINT, ts TIMESTAMP, value STRING``, so that
the same pipeline runs on each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the topic that producers write to.
VOTE_TOPIC = "movie_vote"
MESSAGE_SCHEMA = "msg_offset BIGINT, ts TIMESTAMP, value STRING"


def topic_position(partition: Column, offset: Column) -> Column:
    """One number per message of a topic, rising with the offset.

    Offsets repeat from partition to partition; a topic has far fewer than
    65,536 of these.
    """
    return F.shiftleft(offset, 16) + partition


def topic_messages(
    spark: SparkSession,
    servers: str,
    topic: str = VOTE_TOPIC,
    max_per_batch: int | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """Messages of a Kafka topic, from the earliest one at the first start.

    Later starts go on from the offsets in the stream's checkpoint. Needs the
    connector on the class path
    (``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2``).
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_batch))
    return reader.load().select(
        topic_position(F.col("partition"), F.col("offset")).alias("msg_offset"),
        F.col("timestamp").alias("ts"),
        F.col("value").cast("string").alias("value"),
    )


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the messages in a folder of Parquet files."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
