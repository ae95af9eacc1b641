"""The vote store as sorted runs, and the votes of the log that it does not hold yet.

A store is a row of manifests; the newest is the store. A manifest names

* the runs: folders of votes in row-key order, each with an index of its files'
  key ranges, from large and old to small and new;
* the marks: for each partition of the topic the offset up to which votes are in
  the runs. What lies above them in the log is the tail, which readers add.

A compaction writes the tail as a run of its own and then merges the newest runs as
long as the one before them is not ``GROWTH`` times as large: runs grow
geometrically, there are few of them however many compactions there were, and a
vote is rewritten once per size class. Runs that are not merged are not touched.

One compaction of a store runs at a time; of two the later one fails. Readers keep
the runs of the manifest they have read until newer ones were written ``KEPT`` times.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.votes import row_key
from marquee.schemas import MESSAGE_LOG, VOTE_LOG_COLUMNS, VOTE_STORE
from marquee.versions import KEPT, get_text, numbered, put_text, removed, stored_bytes, subfolders

GROWTH = 4
#: Files of the log are skipped if they are older by this much than the newest one
#: that a compaction took; only clocks of a file system that differ by more could err.
SLACK_SECONDS = 3600
#: Below any offset: nothing of that partition is stored.
NO_MARK = -1
INDEX = "path STRING, low STRING, high STRING"


class Run(NamedTuple):
    name: str
    size: int


class Manifest(NamedTuple):
    number: int
    runs: list[Run]
    marks: dict[int, int]
    log_time: float | None


EMPTY = Manifest(0, [], {}, None)


def topic_partition(offset: Column) -> Column:
    """The partition in a position that ``sources.messages.topic_position`` made."""
    return offset.bitwiseAND(0xFFFF)


def newest_manifest(spark: SparkSession, store: str) -> Manifest:
    """What the store holds now; ``EMPTY`` before the first compaction."""
    numbers = numbered(spark, f"{store}/manifests")
    if not numbers:
        return EMPTY
    found = json.loads(get_text(spark, f"{store}/manifests/{numbers[-1]}.json"))
    marks = {int(k): v for k, v in found["marks"].items()}
    return Manifest(numbers[-1], [Run(*r) for r in found["runs"]], marks, found["log_time"])


def tail(spark: SparkSession, log: str, manifest: Manifest, partition=topic_partition) -> DataFrame:
    """The votes of the log above the manifest's marks.

    Within a partition of the topic offsets rise in the order in which votes arrive.
    Old files of the log are skipped by their time, without being opened.
    """
    rows = spark.read.schema(MESSAGE_LOG).parquet(log).where("accepted")
    if manifest.log_time is not None:
        since = F.timestamp_seconds(F.lit(manifest.log_time - SLACK_SECONDS))
        rows = rows.where(F.col("_metadata.file_modification_time") >= since)
    if manifest.marks:
        # Partitions are numbered from 0 (16 bits at most), so marks are looked up by place, without a join.
        marks = F.lit([manifest.marks.get(k, NO_MARK) for k in range(max(manifest.marks) + 1)]).cast("array<bigint>")
        mark = F.get(marks, partition(F.col("msg_offset")).cast("int"))
        rows = rows.where(F.col("msg_offset") > F.coalesce(mark, F.lit(NO_MARK)))
    return rows.select(*VOTE_LOG_COLUMNS)


def _write_run(votes: DataFrame, store: str) -> Run:
    """Votes in row-key order, cut into ranges by key and offset, and their index."""
    spark = votes.sparkSession
    name = uuid.uuid4().hex
    folder = f"{store}/runs/{name}"
    order = (row_key(F.col("tconst"), F.col("ts_ms")), F.col("msg_offset"))
    votes.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{folder}/votes")
    key = F.col("tconst")
    files = spark.read.schema(VOTE_STORE).parquet(f"{folder}/votes").groupBy(F.col("_metadata.file_path").alias("path"))
    index = files.agg(F.min(key).alias("low"), F.max(key).alias("high"))
    index.sortWithinPartitions("low").write.parquet(f"{folder}/index")
    return Run(name, stored_bytes(spark, f"{folder}/votes"))


def _run(spark: SparkSession, store: str, run: Run) -> DataFrame:
    return spark.read.schema(VOTE_STORE).parquet(f"{store}/runs/{run.name}/votes")


def _merged(spark: SparkSession, store: str, runs: list[Run]) -> list[Run]:
    """Runs by falling size, each ``GROWTH`` times as large as what follows it."""
    first = len(runs) - 1
    while first > 0 and runs[first - 1].size < GROWTH * sum(r.size for r in runs[first:]):
        first -= 1
    if first == len(runs) - 1:
        return runs
    votes = _run(spark, store, runs[first])
    for run in runs[first + 1 :]:
        votes = votes.unionAll(_run(spark, store, run))
    return [*runs[:first], _write_run(votes, store)]


def compact(spark: SparkSession, log: str, store: str, partition=topic_partition) -> Manifest:
    """Takes the log's tail into the store and returns the new manifest; without a tail nothing is written."""
    before = newest_manifest(spark, store)
    reading = spark.read.schema(MESSAGE_LOG).parquet(log)
    # Taken before the votes, so that a file which comes in between is looked at again.
    newest = reading.select("_metadata.file_modification_time").agg(F.max("file_modification_time").cast("double")).head()[0]
    run = _write_run(tail(spark, log, before, partition), store)
    added = _run(spark, store, run).groupBy(partition(F.col("msg_offset")).alias("part")).agg(F.max("msg_offset").alias("mark"))
    marks = {**before.marks, **{r["part"]: r["mark"] for r in added.collect()}}
    if marks == before.marks:
        removed(spark, f"{store}/runs/{run.name}")
        return before
    after = Manifest(before.number + 1, _merged(spark, store, [*before.runs, run]), marks, newest)
    content = {"runs": after.runs, "marks": marks, "log_time": newest}
    put_text(spark, f"{store}/manifests/{after.number}.json", json.dumps(content))
    _clean(spark, store)
    return after


def _clean(spark: SparkSession, store: str) -> None:
    """Removes manifests before the newest ``KEPT``, and runs that none of these names."""
    numbers = numbered(spark, f"{store}/manifests")
    named = set()
    for number in numbers[-KEPT:]:
        named |= {name for name, _ in json.loads(get_text(spark, f"{store}/manifests/{number}.json"))["runs"]}
    for number in numbers[:-KEPT]:
        removed(spark, f"{store}/manifests/{number}.json")
    for name in subfolders(spark, f"{store}/runs"):
        if name not in named:
            removed(spark, f"{store}/runs/{name}")


def _files_of(spark: SparkSession, store: str, runs: list[Run], wanted: Column) -> list[str]:
    """Files of the runs whose key range may hold what is wanted, by the indexes."""
    index = spark.read.schema(INDEX).parquet(*(f"{store}/runs/{run.name}/index" for run in runs))
    return [r["path"] for r in index.where(wanted).select("path").collect()]


def stored_votes(spark: SparkSession, store: str, manifest: Manifest, title: str | None = None) -> DataFrame:
    """The votes in the runs, or those of one title; for that only files whose range holds it are read."""
    none = spark.createDataFrame([], VOTE_STORE)
    if not manifest.runs:
        return none
    if title is None:
        return spark.read.schema(VOTE_STORE).parquet(*(f"{store}/runs/{run.name}/votes" for run in manifest.runs))
    paths = _files_of(spark, store, manifest.runs, (F.col("low") <= title) & (F.col("high") >= title))
    votes = spark.read.schema(VOTE_STORE).parquet(*paths) if paths else none
    return votes.where(F.col("tconst") == title)


def current_votes(spark: SparkSession, log: str, store: str, title: str | None = None, partition=topic_partition) -> DataFrame:
    """All votes up to now, each once: those of the newest manifest and the log's tail above it."""
    manifest = newest_manifest(spark, store)
    newer = tail(spark, log, manifest, partition)
    if title is not None:
        newer = newer.where(F.col("tconst") == title)
    return stored_votes(spark, store, manifest, title).unionByName(newer)
