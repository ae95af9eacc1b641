"""The batch refresh: dumps → raw tables → Parquet tables."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from marquee.schemas import (
    COPIED_TABLES,
    KEYED_TABLES,
    PARTITIONED_TABLE,
    RAW_SCHEMAS,
    bucketed_name,
    dump_of_table,
    parquet_name,
    raw_name,
    table_of_dump,
)
from marquee.sinks.tables import measures, save_bucketed, write_copy, write_raw, write_titles
from marquee.sources.dumps import read_dump
from marquee.sources.tables import load_raw, load_table, load_titles, read_parquet
from marquee.versions import commit, newest, newest_version, next_version, stored_bytes

# Stored bytes of a bucket, which one task sorts and writes.
BUCKET_BYTES = 256 * 2**20

log = logging.getLogger(__name__)


def known_tables(dumps: Iterable[str]) -> list[tuple[str, str]]:
    """``(dump, table)`` of the dumps with a declared schema; warns of others."""
    known = []
    for dump in dumps:
        table = table_of_dump(dump)
        if table in RAW_SCHEMAS:
            known.append((dump, table))
        else:
            log.warning("no schema declared for %s, skipped", dump)
    return known


def land_dump(spark: SparkSession, path: str, warehouse: str, table: str) -> None:
    """Load one dump into its raw table, replacing the former contents.

    A gzip dump arrives in one task, so its rows are dealt out evenly before
    they are written; adaptive execution picks the number of files by size.
    """
    write_raw(read_dump(spark, path, table).hint("rebalance"), warehouse, table)


def convert_table(spark: SparkSession, warehouse: str, table: str) -> dict:
    """The raw table's copy, compared while it is written with what was measured at landing."""
    source = newest(spark, f"{warehouse}/{raw_name(table)}")
    rows = read_parquet(spark, source, RAW_SCHEMAS[table])
    return write_copy(rows, warehouse, table, measures(spark, source))


def partition_titles(spark: SparkSession, warehouse: str) -> None:
    write_titles(load_raw(spark, warehouse, "title_basics"), warehouse)


def _converted_name(table: str) -> str:
    return PARTITIONED_TABLE if table == "title_basics" else parquet_name(table)


def buckets_for(spark: SparkSession, warehouse: str, tables: Iterable[str]) -> int:
    """Number of buckets for tables to be joined: of the largest, by its stored bytes.

    A power of two, so that tables that grow keep numbers that divide each other.
    """
    names = [_converted_name(t) for t in tables]
    largest = max(stored_bytes(spark, newest(spark, f"{warehouse}/{name}")) for name in names)
    return 2 ** max(1, math.ceil(math.log2(max(1, largest / BUCKET_BYTES))))


def bucket_table(
    spark: SparkSession, warehouse: str, table: str, buckets: int, name: str | None = None
) -> None:
    """Bucketed catalog table of a converted table, for joins without shuffles."""
    if table not in KEYED_TABLES:
        raise KeyError(f"not one row per key: {table}")
    rows = (
        load_titles(spark, warehouse)
        if table == "title_basics"
        else load_table(spark, warehouse, table)
    )
    path = next_version(spark, f"{warehouse}/{bucketed_name(table)}")
    save_bucketed(rows, name or bucketed_name(table), path, buckets)


def at_once(steps: Iterable[Callable[[], None]]) -> None:
    """Runs independent steps side by side; the first failure is raised once all have ended.

    Spark shares its executors among the jobs of several threads, so that a step
    with one task does not leave the others idle.
    """
    steps = list(steps)
    if not steps:
        return
    with ThreadPoolExecutor(len(steps)) as threads:
        running = [threads.submit(step) for step in steps]
    for step in running:
        step.result()


def refresh(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    dumps: Iterable[str] | None = None,
    bucketed: Iterable[str] = (),
) -> None:
    """Bring the warehouse up to the dumps in the landing folder.

    Dumps land side by side, then the tables are converted side by side, then
    those named in ``bucketed`` are stored in buckets as well, all with the same
    number. Any failure ends the refresh. Every step replaces its table, so
    running it again is safe. When all tables are there, one commit makes them the
    present ones for readers that pin a commit; until then these see the old ones.
    """
    if dumps is None:
        dumps = [dump_of_table(table) for table in RAW_SCHEMAS]
    known, bucketed = known_tables(dumps), list(bucketed)
    at_once(
        lambda dump=dump, table=table: land_dump(spark, f"{landing}/{dump}", warehouse, table)
        for dump, table in known
    )

    def convert(table: str) -> None:
        if table in COPIED_TABLES:
            convert_table(spark, warehouse, table)
        else:
            partition_titles(spark, warehouse)

    at_once(lambda table=table: convert(table) for _, table in known)
    names = [name for _, table in known for name in (raw_name(table), _converted_name(table))]
    if names:
        commit(spark, warehouse, {name: newest_version(spark, f"{warehouse}/{name}") for name in names})
    if bucketed:
        buckets = buckets_for(spark, warehouse, bucketed)
        at_once(lambda table=table: bucket_table(spark, warehouse, table, buckets) for table in bucketed)
