"""Shaping the results of the aggregations for charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def genre_list(genre_counts: DataFrame) -> DataFrame:
    return genre_counts.select("genre").distinct()


def distinct_decades(genre_counts: DataFrame) -> DataFrame:
    return genre_counts.select("decade").distinct()


def decade_list(genre_counts: DataFrame) -> DataFrame:
    return distinct_decades(genre_counts).orderBy("decade")


def decade_ticks(decades: DataFrame, every: int = 2) -> DataFrame:
    """Every second decade of the distinct ones, starting with the first.

    The position is counted in two steps, inside blocks of 10,000 decades and
    over the blocks. Years are INT, so there are at most 43,000 blocks: neither
    step gives one task more than that. Both steps read ``decades``; without an
    order of their own they share its last exchange, and it is computed once.
    """
    block = F.floor(F.col("decade") / 100_000).alias("block")
    # Both sides of the join ask for this; said here, it leaves one frame for both.
    decades = decades.where(F.floor(F.col("decade") / 100_000).isNotNull())
    blocks = decades.groupBy(block).agg(F.count("*").alias("size"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("block").orderBy("decade")
    ranked = decades.select("decade", block).withColumn("rank", F.row_number().over(inside))
    return (
        ranked.join(starts, "block")
        .where((F.col("start") + F.col("rank") - 1) % every == 0)
        .select("decade")
        .orderBy("decade")
    )


def genre_series(genre_counts: DataFrame) -> DataFrame:
    """One row per genre with its points ``(decade, count)`` in order.

    The input is aggregated, so an array has one item per decade.
    """
    points = F.collect_list(F.struct("decade", "count"))
    return genre_counts.groupBy("genre").agg(F.sort_array(points).alias("points"))


def series_of_genre(genre_counts: DataFrame, genre: str) -> DataFrame:
    return (
        genre_counts.where(F.col("genre") == F.lit(genre))
        .select("decade", "count")
        .orderBy("decade")
    )


def axis_maximum(rows: DataFrame, column: str, name: str) -> DataFrame:
    """The largest value of a column, as one row ``(axis, maximum)``."""
    largest = F.max(F.col(column).cast("double"))
    return rows.agg(largest.alias("maximum")).select(F.lit(name).alias("axis"), "maximum")
