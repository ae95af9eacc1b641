"""Writers of the warehouse tables. Each one makes a new version of the whole table."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from marquee.schemas import PARTITIONED_TABLE, PARTITIONED_TITLES, parquet_name, raw_name
from marquee.sources.dumps import whole_number
from marquee.versions import complete, drop_old, get_text, next_version, put_text, removed, version_path

#: What was measured while a version was written, next to its files.
MEASURES = "_measures.json"
#: Largest Bloom filter of a row group; what it really takes follows from its keys.
BLOOM_BYTES = 2**20
BLOOM_BITS_PER_KEY = 10


class IncompleteCopy(Exception):
    """A copy does not hold what its source held; its version has been removed."""


def _measure_columns(rows: DataFrame) -> list[Column]:
    hashed = F.xxhash64(*rows.columns)
    lengths = [F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))).cast("bigint") for c in rows.columns]
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(sum(lengths[1:], lengths[0])), F.lit(0)).alias("n_chars"),
        # Sums of both halves of the hashes: exact, in any order, and equal rows add up.
        *(
            F.coalesce(F.sum(half.cast("decimal(10,0)")), F.lit(0)).cast("string").alias(name)
            for half, name in ((F.shiftrightunsigned(hashed, 32), "high"), (hashed.bitwiseAND(F.lit(0xFFFFFFFF)), "low"))
        ),
        F.approx_count_distinct(rows.columns[0]).alias("n_keys"),
    ]


def _write_measured(rows: DataFrame, path: str, expected: dict | None = None, **options: str) -> dict:
    """A new version, measured in the tasks that write it, complete only if it is as expected.

    The measures are rows, characters, a sum of row hashes, and about how many keys;
    the last is not compared. They are taken in the last stage, whose tasks count once
    each however often they are tried.
    """
    spark, version = rows.sparkSession, next_version(rows.sparkSession, path)
    seen = Observation()
    writer = rows.observe(seen, *_measure_columns(rows)).write.options(**options)
    # Readers take a version with a completion mark, so the mark waits for the comparison.
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(version)
    got = seen.get
    wrong = [name for name, value in (expected or {}).items() if name != "n_keys" and got[name] != value]
    if wrong:
        removed(spark, version)
        raise IncompleteCopy(f"{version}: " + ", ".join(f"{n} is {got[n]}, not {expected[n]}" for n in wrong))
    put_text(spark, f"{version}/{MEASURES}", json.dumps(got))
    complete(spark, version)
    drop_old(spark, path)
    return got


def measures(spark: SparkSession, version: str) -> dict:
    """What was measured when a raw table's or copy's version was written."""
    return json.loads(get_text(spark, f"{version}/{MEASURES}"))


def _bloom_options(key: str, keys: int | None) -> dict[str, str]:
    """Bloom filters on the key, each as large as the keys of its row group need.

    Of the sizes up to the one that all keys of the table would need, the writer keeps
    the smallest that is not too full.
    """
    needed = BLOOM_BYTES if keys is None else 2 ** math.ceil(math.log2(max(1024, keys * BLOOM_BITS_PER_KEY / 8)))
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.candidates.number": "10",
        "parquet.bloom.filter.max.bytes": str(min(needed, 16 * BLOOM_BYTES)),
    }


def _write_version(writer: DataFrameWriter, spark: SparkSession, path: str) -> None:
    """A new version; readers of the one before are not disturbed."""
    writer.parquet(next_version(spark, path))
    drop_old(spark, path)


def write_raw(rows: DataFrame, warehouse: str, table: str) -> dict:
    """Full refresh of a raw table; returns what was measured on the way."""
    return _write_measured(rows, f"{warehouse}/{raw_name(table)}")


def write_copy(rows: DataFrame, warehouse: str, table: str, expected: dict | None = None) -> dict:
    """Parquet copy of a table, without a shuffle; returns what was measured on the way.

    Each file spans all keys. Rows are ordered by key inside it, which lets a lookup
    skip nearly all pages of a row group, and a Bloom filter on the key lets it skip
    the row groups without it. With ``expected``, the measures of the source, a copy
    that differs is removed and ``IncompleteCopy`` raised; the table stays as it was.
    """
    key = rows.columns[0]
    blooms = _bloom_options(key, expected and expected["n_keys"])
    return _write_measured(rows.sortWithinPartitions(key), f"{warehouse}/{parquet_name(table)}", expected, **blooms)


def typed_titles(raw_titles: DataFrame) -> DataFrame:
    """Raw titles with ``isAdult`` and ``startYear`` as INT, bad text as NULL."""
    columns = []
    for field in PARTITIONED_TITLES:
        column = F.col(field.name)
        if field.dataType == IntegerType() and dict(raw_titles.dtypes)[field.name] == "string":
            column = whole_number(column, field.dataType)
        columns.append(column.try_cast(field.dataType).alias(field.name))
    return raw_titles.select(*columns)


def write_titles(raw_titles: DataFrame, warehouse: str) -> None:
    """Titles in one folder per ``startYear``.

    Rows of a year are brought together so that a year has few files. A year
    (or the missing year) may hold a large part of all titles: the rebalance
    hint lets adaptive execution split such a year over several tasks.
    """
    titles = typed_titles(raw_titles).hint("rebalance", "startYear")
    writer = titles.sortWithinPartitions("startYear", "tconst").write.partitionBy("startYear")
    _write_version(writer, raw_titles.sparkSession, f"{warehouse}/{PARTITIONED_TABLE}")


def save_bucketed(rows: DataFrame, name: str, path: str, buckets: int) -> None:
    """Catalog table at ``path``, bucketed and sorted by its first column.

    Tables with the same number of buckets join on that column without a
    shuffle, and a lookup by it reads one bucket. Only for tables of which the
    column is the key: a bucket cannot be split.
    """
    key = rows.columns[0]
    (
        rows.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )


def write_folded_ratings(ratings: DataFrame, root: str, version: int) -> None:
    """Store a new version of the ratings next to the ones it was made from."""
    (
        ratings.sortWithinPartitions("tconst")
        .write.mode("overwrite")
        .parquet(version_path(root, version))
    )
