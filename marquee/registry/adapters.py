"""Catalogue tables and vote messages derived from the driver's tables.

The driver's tables have other columns than the catalogue; each function here
is one fixed mapping, described in FIXTURES.md. The SQL twins are in
``oracles``. Every mapping covers the whole table it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schemas import RAW_SCHEMAS

# A director list holds the suppliers of four consecutive keys: a title has several
# rows, one for each block of keys, at every size, and no list grows.
DIRECTORS_PER_ROW = 4

EVENT_COLUMNS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, key: Column) -> Column:
    """Prefix and key, zero-padded to seven digits and never cut."""
    digits = key.cast("string")
    padded = F.when(key < 10_000_000, F.lpad(digits, 7, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def _no_text() -> Column:
    return F.lit(None).cast("string")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    kind = F.col("p_type")
    return _table(spark, sf_dir, "part").select(
        _id("tt", key).alias("tconst"),
        F.when(kind == "SMALL", "movie")
        .when(kind == "LARGE", "short")
        .otherwise(F.lower(kind))
        .alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        F.col("p_name").alias("originalTitle"),
        F.lit(0).alias("isAdult"),
        F.when(key % 13 != 0, (1900 + 2 * F.col("p_size")).cast("int")).alias("startYear"),
        _no_text().alias("endYear"),
        (F.col("p_size") * 3).cast("string").alias("runtimeMinutes"),
        F.when(key % 11 != 0, F.replace("p_name", F.lit(" "), F.lit(","))).alias("genres"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem")
        .where(F.col("l_partkey") % 7 != 0)
        .groupBy("l_partkey")
        .agg(F.avg("l_quantity").alias("quantity"), F.count("*").cast("int").alias("numVotes"))
        .select(
            _id("tt", F.col("l_partkey")).alias("tconst"),
            F.round(F.col("quantity") / 5.0, 1).cast("string").alias("averageRating"),
            "numVotes",
        )
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select(
        _id("nm", key).alias("nconst"),
        F.when(key % 10 == 0, "Homonym").otherwise(F.col("s_name")).alias("primaryName"),
    )


def crew(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Duplicates go before the lists are built: a list then holds each id once,
    # and a part with very many lines sends one row per supplier.
    pairs = _table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    row = F.floor(F.col("l_suppkey") / DIRECTORS_PER_ROW).alias("list_row")
    return (
        pairs.groupBy("l_partkey", row)
        .agg(F.array_sort(F.collect_list(_id("nm", F.col("l_suppkey")))).alias("ids"))
        .select(
            _id("tt", F.col("l_partkey")).alias("tconst"),
            F.array_join("ids", ",").alias("directors"),
        )
    )


def akas(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, nation, region = (_table(spark, sf_dir, t) for t in ("part", "nation", "region"))
    return (
        part.join(nation, part["p_partkey"] % 25 == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(
            _id("tt", F.col("p_partkey")).alias("titleId"),
            (F.col("n_nationkey") + 1).cast("int").alias("ordering"),
            F.concat_ws(" ", "p_name", "n_name").alias("title"),
            F.col("n_name").alias("region"),
            F.lower("r_name").alias("language"),
            _no_text().alias("types"),
            _no_text().alias("attributes"),
            F.when(F.col("n_nationkey") == 0, "1").otherwise("0").alias("isOriginalTitle"),
        )
    )


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    return _table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", _id("ep", F.col("l_orderkey")), line.cast("string")).alias("tconst"),
        _id("tt", F.col("l_partkey")).alias("parentTconst"),
        line.cast("int").alias("seasonNumber"),
        F.col("l_quantity").cast("int").alias("episodeNumber"),
    )


def principals(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return _table(spark, sf_dir, "lineitem").select(
        _id("tt", F.col("l_partkey")).alias("tconst"),
        F.col("l_linenumber").cast("int").alias("ordering"),
        _id("nm", F.col("l_suppkey")).alias("nconst"),
        F.when(flag == "A", "actor").when(flag == "N", "director").otherwise("writer").alias(
            "category"
        ),
        _no_text().alias("job"),
        _no_text().alias("characters"),
    )


def as_raw(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the columns and types of the raw table; missing ones are NULL."""
    columns = []
    for field in RAW_SCHEMAS[table]:
        value = F.col(field.name) if field.name in rows.columns else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


TABLES = {
    "name_basics": names,
    "title_akas": akas,
    "title_basics": titles,
    "title_crew": crew,
    "title_episode": episodes,
    "title_principals": principals,
    "title_ratings": ratings,
}


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return as_raw(TABLES[table](spark, sf_dir), table)


def _as_messages(events: DataFrame) -> DataFrame:
    body = F.concat(
        F.lit('"'),
        _id("tt", F.col("user_id")),
        F.lit("_"),
        (1 + F.col("event_id") % 5).cast("string"),
        F.lit('"'),
    )
    return events.select(
        F.col("event_id").alias("msg_offset"),
        "ts",
        F.when(F.col("event_type") == "error", '"bad"').otherwise(body).alias("value"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The declared type reads the stored clock time as UTC in any session.
    return _as_messages(spark.read.schema(EVENT_COLUMNS).parquet(f"{sf_dir}/events.parquet"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written as a pattern, the path may be a file as well as a folder.
    path = f"{sf_dir}/{{events}}.parquet"
    return _as_messages(spark.readStream.schema(EVENT_COLUMNS).parquet(path))


def write_dump(rows: DataFrame, path: str) -> None:
    """Write rows the way the dumps are: gzip, header, tabs, ``\\N``, no quotes."""
    rows.write.csv(
        path,
        mode="overwrite",
        sep="\t",
        header=True,
        nullValue="\\N",
        emptyValue="",
        quote="",
        escape="",
        compression="gzip",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
