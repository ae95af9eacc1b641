"""Declared table schemas and the names that go with them."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(columns: str, **types: DataType) -> StructType:
    """Nullable columns in the given order: text, unless a type is named."""
    return StructType(
        [StructField(name, types.get(name, StringType())) for name in columns.split()]
    )


# The column lists of the seven catalogue dumps, as text tables.
RAW_SCHEMAS: dict[str, StructType] = {
    "name_basics": _schema(
        "nconst primaryName birthYear deathYear primaryProfession knownForTitles"
    ),
    "title_akas": _schema(
        "titleId ordering title region language types attributes isOriginalTitle",
        ordering=IntegerType(),
    ),
    "title_basics": _schema(
        "tconst titleType primaryTitle originalTitle isAdult startYear endYear "
        "runtimeMinutes genres"
    ),
    "title_crew": _schema("tconst directors writers"),
    "title_episode": _schema(
        "tconst parentTconst seasonNumber episodeNumber",
        seasonNumber=IntegerType(),
        episodeNumber=IntegerType(),
    ),
    "title_principals": _schema(
        "tconst ordering nconst category job characters", ordering=IntegerType()
    ),
    "title_ratings": _schema("tconst averageRating numVotes", numVotes=IntegerType()),
}

# Titles after the cast, with the partition column last.
PARTITIONED_TITLES = _schema(
    "tconst titleType primaryTitle originalTitle isAdult endYear runtimeMinutes genres startYear",
    isAdult=IntegerType(),
    startYear=IntegerType(),
)

# Ratings after votes were folded in: typed, unlike the dump.
FOLDED_RATINGS = _schema(
    "tconst averageRating numVotes", averageRating=DoubleType(), numVotes=LongType()
)

# One line per message, accepted or not; see streaming.votes.
MESSAGE_LOG = _schema(
    "msg_offset ts_ms tconst vote value accepted",
    msg_offset=LongType(),
    ts_ms=LongType(),
    vote=IntegerType(),
    accepted=BooleanType(),
)

VOTE_STORE = _schema(
    "msg_offset tconst ts_ms vote", msg_offset=LongType(), ts_ms=LongType(), vote=IntegerType()
)
VOTE_LOG_COLUMNS = tuple(VOTE_STORE.names)

# Tables stored as a plain Parquet copy; title_basics is partitioned instead.
COPIED_TABLES = (
    "name_basics",
    "title_akas",
    "title_crew",
    "title_episode",
    "title_principals",
    "title_ratings",
)
# Tables with one row per key, the only ones worth bucketing by it.
KEYED_TABLES = ("name_basics", "title_basics", "title_crew", "title_episode", "title_ratings")
# Fixed value: the name under which queries know the partitioned titles.
PARTITIONED_TABLE = "movies_partitioned_by_startyear"
DUMP_SUFFIX = ".tsv.gz"


def table_of_dump(file_name: str) -> str:
    """``name.basics.tsv.gz`` (or a path ending in it) → ``name_basics``."""
    return file_name.rsplit("/", 1)[-1].removesuffix(DUMP_SUFFIX).replace(".", "_")


def dump_of_table(table: str) -> str:
    """``name_basics`` → ``name.basics.tsv.gz``."""
    return table.replace("_", ".", 1) + DUMP_SUFFIX


def raw_name(table: str) -> str:
    return f"{table}_raw"


def parquet_name(table: str) -> str:
    return f"{table}_parquet"


def bucketed_name(table: str) -> str:
    return f"{table}_bucketed"
