"""What several of these operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_dir

#: What stands between words, and what is a word.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text, in order; of NULL none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared scratch folder and read from there.

    Cuts the lineage: what follows is not computed anew if an executor is lost,
    and reads the same rows in the same files however often it runs.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def spare(columns: list[str], name: str) -> str:
    """A column name that none of the given ones equals, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def releasing(batches: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``batches``, after which Arrow's free memory goes back to the system.

    Python workers outlive their tasks: what one holds on to is missing in later stages.
    """
    @wraps(batches)
    def run(stream):
        try:
            yield from batches(stream)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def row_ranges(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of neighbouring rows of at most ``limit`` bytes together; a larger row is alone."""
    ends, ranges, start = np.cumsum(sizes), [], 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        ranges.append((start, stop))
        start = stop
    return ranges
