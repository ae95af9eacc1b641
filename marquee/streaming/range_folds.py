"""Folding of votes that rewrites only the key ranges a batch touches.

Titles are dealt by hash to a fixed number of ranges. A range holds its ratings next
to the totals of their votes, and is in ``{root}/data/batch=N/range=R``, N being the
batch that wrote it last. ``{root}/index/N.json`` names that batch for each range: it
is put in place by a rename after all files of batch N, so that readers see a batch
whole or not at all, and a batch that was cut short is simply done again.

The ratings of the dump are read again, and all ranges written, only when their files
are others than those of the last batch, as after a refresh.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.functions.catalogue import rating_value
from marquee.operators.ratings import folded_columns
from marquee.operators.votes import parse_votes, vote_totals
from marquee.streaming.votes import Ratings, present, triggered
from marquee.versions import KEPT, get_text, numbered, put_text, removed, subfolders

#: Ranges a table is dealt to, unless its index says another number.
RANGES = 256
RANGE_ROWS = "tconst STRING, averageRating DOUBLE, numVotes BIGINT, dn BIGINT, ds BIGINT"


def range_of(tconst: Column, ranges: int) -> Column:
    return F.pmod(F.xxhash64(tconst), F.lit(ranges)).cast("int")


def files_mark(ratings: DataFrame) -> str:
    """Tells ratings from others by the files they are read from; without files all are alike."""
    return hashlib.sha256("\n".join(sorted(ratings.inputFiles())).encode()).hexdigest()


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root}/data/batch={batch_id}"


def _index(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(get_text(spark, f"{root}/index/{number}.json"))


def _rows(spark: SparkSession, root: str, batches: dict[str, int], ranges: set[int] | None = None) -> DataFrame:
    """The rows of some ranges, or of all; no other folder is listed."""
    paths = [
        f"{_batch_path(root, batch)}/range={number}"
        for number, batch in batches.items()
        if ranges is None or int(number) in ranges
    ]
    return spark.read.schema(RANGE_ROWS).parquet(*paths) if paths else spark.createDataFrame([], RANGE_ROWS)


def _summed(totals: DataFrame) -> DataFrame:
    return totals.groupBy("tconst").agg(F.sum("dn").alias("dn"), F.sum("ds").alias("ds"))


def _rebuilt(ratings: DataFrame, before: DataFrame, totals: DataFrame) -> DataFrame:
    """All ranges anew: the present ratings with the totals up to now."""
    base = ratings.select(
        "tconst",
        rating_value(F.col("averageRating")).alias("averageRating"),
        F.col("numVotes").cast("bigint").alias("numVotes"),
    )
    # A title that the dump has twice has its totals twice.
    kept = before.where("dn IS NOT NULL").groupBy("tconst").agg(F.max("dn").alias("dn"), F.max("ds").alias("ds"))
    return base.join(_summed(kept.unionByName(totals)), "tconst", "full")


def _added(before: DataFrame, totals: DataFrame) -> DataFrame:
    """Ranges with a batch's totals worked in."""
    new = totals.select("tconst", F.col("dn").alias("more"), F.col("ds").alias("more_sum"))

    def plus(old: str, more: str) -> Column:
        both = F.coalesce(F.col(old), F.lit(0)) + F.col(more)
        return F.when(F.col(more).isNull(), F.col(old)).otherwise(both).alias(old)

    joined = before.join(new, "tconst", "full")
    return joined.select("tconst", "averageRating", "numVotes", plus("dn", "more"), plus("ds", "more_sum"))


def fold_batch(totals: DataFrame, ratings: DataFrame, root: str, batch_id: int, ranges: int = RANGES) -> None:
    """Adds one batch's totals (tconst, dn, ds), once however often it is done.

    The driver gets the numbers of the ranges touched, ``ranges`` at most. Titles
    without a rating get one from their votes. A batch below the newest one is an
    error: the folder belongs to another checkpoint.
    """
    spark = totals.sparkSession
    numbers = numbered(spark, f"{root}/index")
    if numbers and batch_id < numbers[-1]:
        raise ValueError(f"{root} holds batch {numbers[-1]} already; {batch_id} is of another checkpoint")
    if numbers and batch_id == numbers[-1]:
        return
    index = _index(spark, root, numbers[-1]) if numbers else {"ranges": ranges, "ratings": None, "batches": {}}
    ranges, mark, batches = index["ranges"], files_mark(ratings), index["batches"]
    totals = totals.persist()
    try:
        if index["ratings"] != mark:
            rows, batches = _rebuilt(ratings, _rows(spark, root, batches), totals), {}
        else:
            touched = {r[0] for r in totals.select(range_of(F.col("tconst"), ranges)).distinct().collect()}
            rows = _added(_rows(spark, root, batches, touched), totals)
        folder = _batch_path(root, batch_id)
        (
            rows.withColumn("range", range_of(F.col("tconst"), ranges))
            .hint("rebalance", "range")
            .sortWithinPartitions("range", "tconst")
            .write.mode("overwrite")
            .partitionBy("range")
            .parquet(folder)
        )
    finally:
        totals.unpersist()
    written = [name.removeprefix("range=") for name in subfolders(spark, folder) if name.startswith("range=")]
    entry = {"ranges": ranges, "ratings": mark, "batches": {**batches, **dict.fromkeys(written, batch_id)}}
    put_text(spark, f"{root}/index/{batch_id}.json", json.dumps(entry))
    _drop_old(spark, root)


def _drop_old(spark: SparkSession, root: str) -> None:
    """Removes indexes behind the newest ``KEPT``, and the files that none of these names."""
    numbers = numbered(spark, f"{root}/index")
    for number in numbers[:-KEPT]:
        removed(spark, f"{root}/index/{number}.json")
    named = {
        (batch, number)
        for kept in numbers[-KEPT:]
        for number, batch in _index(spark, root, kept)["batches"].items()
    }
    for folder in subfolders(spark, f"{root}/data"):
        batch = int(folder.removeprefix("batch="))
        if batch > numbers[-1]:
            continue
        held = [n.removeprefix("range=") for n in subfolders(spark, f"{root}/data/{folder}") if n.startswith("range=")]
        old = [number for number in held if (batch, number) not in named]
        if len(old) == len(held):
            removed(spark, f"{root}/data/{folder}")
            continue
        for number in old:
            removed(spark, f"{root}/data/{folder}/range={number}")


def load_folded_ranges(spark: SparkSession, root: str, tconst: str | None = None) -> DataFrame:
    """The ratings folded up to the newest batch; of one title, from its range alone.

    A reader keeps the files it has listed until ``KEPT`` further batches are done.
    """
    numbers = numbered(spark, f"{root}/index")
    if not numbers:
        raise FileNotFoundError(f"no folded batch in {root}")
    index = _index(spark, root, numbers[-1])
    if tconst is None:
        return _rows(spark, root, index["batches"]).select(*folded_columns())
    number = spark.range(1).select(range_of(F.lit(tconst), index["ranges"])).first()[0]
    rows = _rows(spark, root, index["batches"], {number})
    return rows.where(F.col("tconst") == F.lit(tconst)).select(*folded_columns())


def start_range_folding(
    messages: DataFrame,
    ratings: Ratings,
    root: str,
    checkpoint: str,
    once: bool = False,
    every: str = "10 minutes",
    strict: bool = False,
    ranges: int = RANGES,
) -> StreamingQuery:
    """Fold each batch of votes into the ranges of the ratings that it touches.

    Read with ``load_folded_ranges``. Give a function that loads the ratings, so that
    a batch after a refresh takes the new ones up.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_batch(vote_totals(parse_votes(batch, strict)), present(ratings), root, batch_id, ranges)

    return triggered(messages.writeStream.foreachBatch(fold), checkpoint, once, every).start()
