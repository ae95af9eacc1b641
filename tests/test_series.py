"""Chart data and display formats."""

import json

import pytest
from pyspark.sql import functions as F

from marquee.functions.display import json_records, thousands, two_decimals
from marquee.operators import series


def rows(frame):
    return [tuple(row) for row in frame.collect()]


@pytest.fixture
def counts(spark):
    values = [(1990, "a", 3), (1900, "b", 1), (1900, "a", 2), (2000, "b", 4), (-10, "b", 5)]
    return spark.createDataFrame(values, "decade bigint, genre string, count bigint")


def test_lists(counts):
    assert sorted(rows(series.genre_list(counts))) == [("a",), ("b",)]
    assert rows(series.decade_list(counts)) == [(-10,), (1900,), (1990,), (2000,)]


def test_every_second_decade_across_blocks(spark):
    decades = sorted({-2_000_000, -100_000, -10, 0, 10, 99_990, 100_000, 100_010, 5_000_000})
    frame = spark.createDataFrame([(d,) for d in decades], "decade bigint")
    assert rows(series.decade_ticks(frame)) == [(d,) for d in decades[::2]]
    assert rows(series.decade_ticks(frame, every=3)) == [(d,) for d in decades[::3]]


def test_series(counts):
    points = {row["genre"]: [tuple(p) for p in row["points"]] for row in
              series.genre_series(counts).collect()}
    assert points == {"a": [(1900, 2), (1990, 3)], "b": [(-10, 5), (1900, 1), (2000, 4)]}
    assert rows(series.series_of_genre(counts, "a")) == [(1900, 2), (1990, 3)]


def test_axis_maximum(counts):
    assert rows(series.axis_maximum(counts, "count", "count")) == [("count", 5.0)]


def test_formats(spark):
    numbers = [0.125, 0.375, 1.005, 2.5, 1234.565, -0.125, 7.0]
    frame = spark.createDataFrame([(n,) for n in numbers], "n double")
    texts = [t for (t,) in rows(frame.select(two_decimals(F.col("n"))))]
    assert texts == ["0.13", "0.38", "1.00", "2.50", "1234.57", "-0.13", "7.00"]
    assert rows(spark.range(1).select(thousands(F.lit(1234567)))) == [("1,234,567",)]


def test_json_keeps_nulls(spark):
    frame = spark.createDataFrame([(1, None), (2, 'q"')], "a int, b string")
    records = [json.loads(text) for (text,) in rows(json_records(frame))]
    assert records == [{"a": 1, "b": None}, {"a": 2, "b": 'q"'}]
