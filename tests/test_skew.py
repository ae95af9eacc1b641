"""Every registered query on tables where one key holds a third of the rows."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as registered

QUERIES, ORACLES = registered.QUERIES, registered.ORACLES


@pytest.fixture(scope="module")
def skewed(spark, small, tmp_path_factory):
    """The small tables as folders of files, with hot keys and copied rows."""
    folder = str(tmp_path_factory.mktemp("skewed"))

    def table(name):
        return spark.read.parquet(f"{small}/{name}.parquet")

    third = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3))
    lines = table("lineitem")
    # A third of the lines are copies of one line, another third share a part.
    copied = [
        F.when(third == 0, F.lit(value).cast(kind)).otherwise(F.col(name)).alias(name)
        for (name, kind), value in zip(lines.dtypes, lines.orderBy("l_orderkey").first())
    ]
    lines = lines.select(*copied, third.alias("third"))
    lines = lines.withColumn(
        "l_partkey", F.when(F.col("third") == 1, 12).otherwise(F.col("l_partkey")).cast("bigint")
    ).drop("third")
    # A third of the votes are for one title, in two milliseconds.
    hot = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    moment = F.lit("2024-01-15 10:00:00.1234").cast("timestamp_ntz")
    later = F.lit("2024-01-15 10:00:00.1250").cast("timestamp_ntz")
    events = (
        table("events")
        .withColumn("user_id", F.when(hot, 12).otherwise(F.col("user_id")).cast("bigint"))
        .withColumn(
            "ts",
            F.when(hot, F.when(F.col("event_id") % 2 == 0, moment).otherwise(later)).otherwise(
                F.col("ts")
            ),
        )
    )
    year = F.when(F.col("p_partkey") % 3 == 0, 40).otherwise(F.col("p_size")).cast("int")
    kind = F.when(F.col("p_partkey") % 3 == 0, "SMALL").otherwise(F.col("p_type"))
    parts = table("part").withColumns({"p_size": year, "p_type": kind})
    for name, rows in {"lineitem": lines, "events": events, "part": parts}.items():
        rows.repartition(5).write.parquet(f"{folder}/{name}.parquet")
    for name in ("supplier", "nation", "region"):
        table(name).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_on_hot_keys(spark, skewed, con, name):
    assert differences(QUERIES[name](spark, skewed), con, ORACLES[name]) is None
