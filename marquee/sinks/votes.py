"""Writers of votes and vote messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.votes import row_key
from marquee.sources.messages import VOTE_TOPIC
from marquee.versions import drop_old, next_version


def write_vote_store(votes: DataFrame, path: str) -> None:
    """Rewrite a vote log in row-key order, so that a key range is a few files.

    Each call makes a new version of the store at ``path``.

    Ranges are cut on the row key and the offset, hence even a title with a
    third of all votes, or one millisecond of it, spreads over many files.
    """
    order = (row_key(F.col("tconst"), F.col("ts_ms")), F.col("msg_offset"))
    ordered = votes.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.parquet(next_version(votes.sparkSession, path))
    drop_old(votes.sparkSession, path)


def send_messages(messages: DataFrame, servers: str, topic: str = VOTE_TOPIC) -> None:
    """Publish column ``value`` to a Kafka topic; needs the connector."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
