"""Scans of the Parquet tables of a warehouse folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marquee.schemas import (
    COPIED_TABLES,
    FOLDED_RATINGS,
    PARTITIONED_TABLE,
    PARTITIONED_TITLES,
    RAW_SCHEMAS,
    parquet_name,
    raw_name,
)
from marquee.versions import newest, version_path


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan with a declared schema, so that no file is opened to plan it."""
    return spark.read.schema(schema).parquet(path)


def read_newest(spark: SparkSession, path: str, schema: StructType, at: dict[str, int] | None = None) -> DataFrame:
    """Scan of the newest completed version of a table, or of the one that ``at`` names."""
    if at is None:
        return read_parquet(spark, newest(spark, path), schema)
    return read_parquet(spark, version_path(path, at[path.rpartition("/")[2]]), schema)


def load_raw(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    return read_newest(spark, f"{warehouse}/{raw_name(table)}", RAW_SCHEMAS[table])


def load_table(spark: SparkSession, warehouse: str, table: str, at: dict[str, int] | None = None) -> DataFrame:
    """Scan one of the six copied tables, every file of its folder.

    Reports over several tables give ``at``, the tables' versions in a commit
    (see ``versions.pinned``); otherwise each table is the newest there is.
    """
    if table not in COPIED_TABLES:
        raise KeyError(f"not a copied table: {table}")
    return read_newest(spark, f"{warehouse}/{parquet_name(table)}", RAW_SCHEMAS[table], at)


def load_titles(spark: SparkSession, warehouse: str, at: dict[str, int] | None = None) -> DataFrame:
    """Scan the titles partitioned by ``startYear``, which comes last."""
    return read_newest(spark, f"{warehouse}/{PARTITIONED_TABLE}", PARTITIONED_TITLES, at)


def load_folded_ratings(spark: SparkSession, root: str, version: int) -> DataFrame:
    return read_parquet(spark, f"{root}/version={version}", FOLDED_RATINGS)


def load_newest_ratings(spark: SparkSession, root: str) -> DataFrame:
    """The newest completed version that folding has made."""
    return read_newest(spark, root, FOLDED_RATINGS)
