"""Tab-separated catalogue dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from marquee.schemas import RAW_SCHEMAS

NULL_MARKER = "\\N"


def whole_number(value: Column, kind: DataType) -> Column:
    """Text as a whole number: a decimal fraction is cut off, other text is NULL.

    As the text tables of the dumps' usual engine read it.
    """
    return F.regexp_replace(value, r"^([+-]?[0-9]+)\.[0-9]*$", "$1").try_cast(kind)


def read_dump(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a dump with its declared schema.

    Only tabs and line ends separate: quotes, backslashes and all other
    characters are data, an empty field is an empty string, and ``\\N`` is NULL.
    Missing trailing fields and bad numbers are NULL, surplus fields are
    ignored. A line is a row, also one of nothing but blanks.

    Lines that consist of the declared column names are headers and left out,
    in each file. A header that names other columns stays as a row, where it can
    be seen; it is never taken for granted that a first line is one.

    A gzip file is read by one task; ``ingest.land_dump`` spreads the rows out
    before anything else is done with them.
    """
    schema = RAW_SCHEMAS[table]
    lines = spark.read.text(path).where(F.col("value") != F.lit("\t".join(schema.names)))
    fields = lines.select(F.split("value", "\t", -1).alias("fields"))
    columns = []
    for position, field in enumerate(schema):
        value = F.nullif(F.get("fields", F.lit(position)), F.lit(NULL_MARKER))
        if field.dataType != StringType():
            value = whole_number(value, field.dataType)
        columns.append(value.alias(field.name))
    return fields.select(*columns)
