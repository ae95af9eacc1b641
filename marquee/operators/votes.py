"""Parsing vote messages and reading the vote log."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.votes import (
    VOTE_CELL,
    is_star_vote,
    is_vote_message,
    key_millis,
    key_title,
    message_title,
    message_value,
    message_vote,
    row_key,
)
from marquee.schemas import VOTE_LOG_COLUMNS


def classify_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``tconst``, ``vote`` and ``accepted`` to a frame with ``value``.

    A message is accepted if it has two parts and the second is a whole number.
    The id may be empty and the number out of range; ``strict`` also asks for
    what a producer checks. ``accepted`` is never NULL; the other two columns
    mean nothing where it is false.
    """
    value = F.col("value").cast("string")
    tconst, vote = message_title(value), message_vote(value)
    accepted = is_vote_message(value)
    if strict:
        accepted = accepted & is_star_vote(tconst, vote)
    return messages.select(
        "*", tconst.alias("tconst"), vote.alias("vote"), accepted.alias("accepted")
    )


def parse_votes(messages: DataFrame, strict: bool = False) -> DataFrame:
    """The accepted messages, as title and vote."""
    return classify_messages(messages, strict).where("accepted").drop("value", "accepted")


def rejected_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    """The other messages, unchanged."""
    return classify_messages(messages, strict).where("not accepted").select(*messages.columns)


def vote_log(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Log rows of the accepted messages.

    The time is the message's own, in whole milliseconds, so that reading the
    messages again gives the same keys.
    """
    votes = parse_votes(messages, strict)
    return votes.withColumn("ts_ms", F.unix_millis("ts")).select(*VOTE_LOG_COLUMNS)


def in_key_order(votes: DataFrame) -> DataFrame:
    """A full scan as a store sorted by row key returns it."""
    return votes.orderBy(row_key(F.col("tconst"), F.col("ts_ms")), "msg_offset")


def vote_records(votes: DataFrame) -> DataFrame:
    """Votes as the records of a key-value store: ``row_key`` and a map of cells."""
    return keyed_records(votes.select(row_key(F.col("tconst"), F.col("ts_ms")).alias("row_key"), "vote"))


def keyed_records(votes: DataFrame) -> DataFrame:
    """The same for ``(row_key, vote)``, as ``range_scan`` returns."""
    cells = F.create_map(F.lit(VOTE_CELL), F.col("vote").cast("string"))
    return votes.select("row_key", cells.alias("data"))


def latest_votes(votes: DataFrame, written: str = "msg_offset") -> DataFrame:
    """One vote per row key: the last one written, as in a store that overwrites."""
    return votes.groupBy("tconst", "ts_ms").agg(F.max_by("vote", written).alias("vote"))


def is_plain_id(tconst: Column) -> Column:
    """Whether an id can occur in a row key only inside the title's own id.

    The rest of a key is ``_`` and digits (with a minus sign before 1970).
    """
    return ~tconst.contains("_") & tconst.rlike("[^0-9-]")


def range_scan(votes: DataFrame, tconst: str) -> DataFrame:
    """Keys from ``tconst`` on that contain it, as ``(row_key, vote)``.

    This also finds ids that merely contain the given one. For an ordinary id
    the same condition holds for the title column alone, where it reaches the
    Parquet scan.
    """
    key = row_key(F.col("tconst"), F.col("ts_ms"))
    if "_" not in tconst and re.search("[^0-9-]", tconst):
        votes = votes.where((F.col("tconst") >= tconst) & F.col("tconst").contains(tconst))
    return votes.select(key.alias("row_key"), "vote").where(
        (F.col("row_key") >= tconst) & F.col("row_key").contains(tconst)
    )


def recent_votes(votes: DataFrame) -> DataFrame:
    """All votes, newest first; the offset keeps busy milliseconds divisible."""
    return votes.orderBy(F.desc("ts_ms"), "tconst", "msg_offset").select("tconst", "vote", "ts_ms")


def key_parts(votes: DataFrame) -> DataFrame:
    """The key of each vote, and the title and time read back from it."""
    key = row_key(F.col("tconst"), F.col("ts_ms")).alias("row_key")
    return votes.select(key).select(
        "row_key", key_title(F.col("row_key")).alias("tconst"), key_millis(F.col("row_key")).alias("ts_ms")
    )


def vote_count(votes: DataFrame) -> DataFrame:
    return votes.agg(F.count("*").alias("n"))


def vote_totals(votes: DataFrame) -> DataFrame:
    """Number ``dn`` and sum ``ds`` of the votes of each title.

    Sums are partial before the shuffle, so a title with very many votes costs
    one row per task. For a store that overwrites equal keys, pass
    ``latest_votes(votes)``.
    """
    return votes.groupBy("tconst").agg(
        F.count("*").alias("dn"), F.sum("vote").alias("ds")
    )


def encode_messages(votes: DataFrame) -> DataFrame:
    """Messages for the votes that a producer would send."""
    tconst, vote = F.col("tconst"), F.col("vote")
    return votes.where(is_star_vote(tconst, vote)).select(
        message_value(tconst, vote).alias("value")
    )
