"""Running totals of stored votes: a second put to a key takes the place of the first.

A batch keeps one put per key (title and millisecond), looks for the put that it
takes the place of, and sends on the difference: new minus old, and a vote more only
where the key is new. Of puts to one key the one with the largest offset stays,
whichever batch it comes in.

A put can only take the place of one of the same millisecond. Puts are stored by day,
so a batch reads the days of its own votes and no others, however old the stream is.

Under ``path``: ``puts/day=D/batch_id=N``, the differences of each batch in
``changes/batch_id=N``, and now and then their sum so far in ``base/batch_id=N``.
Doing a batch again replaces its folders and leads to the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.votes import vote_log
from marquee.streaming.votes import TOTALS_SCHEMA, batch_folder, triggered, write_batch
from marquee.versions import completed, removed, subfolders

#: Batches after which the changes are summed up.
SUMMED_EVERY = 16
DAY_MILLIS = 86_400_000
PUTS_SCHEMA = "tconst STRING, ts_ms BIGINT, vote INT, msg_offset BIGINT"


def last_puts(votes: DataFrame) -> DataFrame:
    """One put per key, that of the largest offset."""
    last = F.max_by("vote", "msg_offset").alias("vote"), F.max("msg_offset").alias("msg_offset")
    return votes.groupBy("tconst", "ts_ms").agg(*last)


def changes(puts: DataFrame, before: DataFrame) -> DataFrame:
    """What new puts add to the totals of each title, given those stored before for their keys.

    Both sides hold one row per key. Titles whose totals stay as they are are left out.
    """
    old = before.select("tconst", "ts_ms", F.col("vote").alias("old"), F.col("msg_offset").alias("old_offset"))
    joined = puts.join(old, ["tconst", "ts_ms"], "left")
    is_new, wins = F.col("old_offset").isNull(), F.col("msg_offset") > F.col("old_offset")
    sums = joined.select(
        "tconst",
        is_new.cast("bigint").alias("dn"),
        F.when(is_new, F.col("vote").cast("bigint")).when(wins, F.col("vote").cast("bigint") - F.col("old")).otherwise(0).alias("ds"),
    )
    return _summed(sums).where((F.col("dn") != 0) | (F.col("ds") != 0))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tconst").agg(F.sum("dn").alias("dn"), F.sum("ds").alias("ds"))


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Batches whose folder has been written to its end."""
    numbers = (int(n.removeprefix("batch_id=")) for n in subfolders(spark, path) if n.startswith("batch_id="))
    return sorted(n for n in numbers if completed(spark, batch_folder(path, n)))


def _rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], TOTALS_SCHEMA)
    return spark.read.schema(TOTALS_SCHEMA).parquet(*paths)


def _total(spark: SparkSession, path: str, upto: int | None = None, before: int | None = None) -> DataFrame:
    """The newest base below ``before`` and the changes since then, to ``upto``."""
    bases = [n for n in _batches(spark, f"{path}/base") if before is None or n < before]
    base = bases[-1] if bases else -1
    later = [n for n in _batches(spark, f"{path}/changes") if n > base and (upto is None or n <= upto)]
    paths = [batch_folder(f"{path}/base", base)] if bases else []
    return _summed(_rows(spark, paths + [batch_folder(f"{path}/changes", n) for n in later]))


def stored_totals(spark: SparkSession, path: str) -> DataFrame:
    """The present totals: at most one base and ``SUMMED_EVERY`` batches of changes are read."""
    return _total(spark, path)


def start_stored_totals(
    messages: DataFrame, path: str, checkpoint: str, once: bool = False, every: str = "1 minute", strict: bool = False
) -> StreamingQuery:
    """Keeps the totals of a store that overwrites equal keys; read them with ``stored_totals``."""

    def put(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, batch_id, path, strict)

    return triggered(messages.writeStream.foreachBatch(put), checkpoint, once, every).start()


def add_batch(batch: DataFrame, batch_id: int, path: str, strict: bool = False) -> None:
    """Stores a batch's puts, its changes, and now and then their sum; may be done again."""
    spark = batch.sparkSession
    day = F.floor(F.col("ts_ms") / DAY_MILLIS).cast("bigint")
    puts = last_puts(vote_log(batch, strict)).withColumns({"day": day, "batch_id": F.lit(batch_id)})
    writer = puts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id")
    writer.parquet(f"{path}/puts")

    stored = spark.read.schema(f"{PUTS_SCHEMA}, day BIGINT, batch_id BIGINT").option("basePath", f"{path}/puts")
    own, earlier = [], []
    for folder in subfolders(spark, f"{path}/puts"):
        if folder.startswith("day="):
            numbers = subfolders(spark, f"{path}/puts/{folder}")
            if f"batch_id={batch_id}" in numbers:
                own.append(f"{path}/puts/{folder}/batch_id={batch_id}")
                earlier += [f"{path}/puts/{folder}/{n}" for n in numbers if int(n.removeprefix("batch_id=")) < batch_id]
    if own:
        new = stored.parquet(*own).drop("day", "batch_id")
        before = stored.parquet(*earlier).drop("day", "batch_id") if earlier else new.limit(0)
        write_batch(changes(new, last_puts(before)), f"{path}/changes", batch_id)
    else:
        write_batch(spark.createDataFrame([], TOTALS_SCHEMA), f"{path}/changes", batch_id)

    if batch_id % SUMMED_EVERY == SUMMED_EVERY - 1:
        write_batch(_total(spark, path, upto=batch_id, before=batch_id), f"{path}/base", batch_id)
        _clean(spark, path)


def _clean(spark: SparkSession, path: str) -> None:
    """Keeps the last two bases and the changes since the older one, for readers and for a batch done again."""
    bases = _batches(spark, f"{path}/base")
    if len(bases) < 2:
        return
    for number in bases[:-2]:
        removed(spark, batch_folder(f"{path}/base", number))
    for number in _batches(spark, f"{path}/changes"):
        if number <= bases[-2]:
            removed(spark, batch_folder(f"{path}/changes", number))
