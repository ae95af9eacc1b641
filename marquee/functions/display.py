"""Expressions that format results as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_decimals(number: Column) -> Column:
    """Two decimals, no separators, exact halves away from zero.

    ``format_number`` rounds the exact binary value but sends halves to the
    even digit. Only odd multiples of 1/8 are exact halves at two decimals, so
    those are moved off the half first.
    """
    half = F.abs(number * 8) % 2 == 1
    moved = F.when(half, number + F.signum(number) * 0.001).otherwise(number)
    return F.call_function("format_number", moved, F.lit("0.00"))


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)


def json_records(rows: DataFrame) -> DataFrame:
    """One JSON object per row in column ``json``; NULL fields are kept."""
    record = F.struct(*[F.col(f"`{name}`") for name in rows.columns])
    return rows.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))
