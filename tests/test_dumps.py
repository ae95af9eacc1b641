"""Reading dumps, and the batch refresh built on it."""

import gzip
import logging

import pytest
from pyspark.sql import functions as F

from marquee.operators.catalogue import preview
from marquee.plans import ingest
from marquee.plans.analytics import genre_by_decade, top_directors, votes_by_title_type
from marquee.schemas import RAW_SCHEMAS, dump_of_table, parquet_name, raw_name, table_of_dump
from marquee.sinks.tables import write_titles
from marquee.sources.dumps import read_dump
from marquee.sources.tables import load_raw, load_table, load_titles


def write_dump(path, *lines):
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    return str(path)


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_names():
    assert table_of_dump("/landing/name.basics.tsv.gz") == "name_basics"
    assert raw_name("name_basics") == "name_basics_raw"
    assert parquet_name("name_basics") == "name_basics_parquet"
    assert all(table_of_dump(dump_of_table(table)) == table for table in RAW_SCHEMAS)


def test_marker_quotes_and_bad_numbers(spark, tmp_path):
    path = write_dump(
        tmp_path / "title.ratings.tsv.gz",
        "tconst\taverageRating\tnumVotes",
        '"tt1\t5.0\t10',
        "\\N\t\\N\t\\N",
        "tt3\t\tmany",
        "a\\b \t'6'\t 7",
        "tt5\t6.1",
        "tt6\t6.2\t8\tsurplus",
        "tt\x017\t6.3\t-9",
    )
    assert rows(read_dump(spark, path, "title_ratings")) == [
        ('"tt1', "5.0", 10),
        (None, None, None),
        ("tt3", "", None),
        ("a\\b ", "'6'", 7),
        ("tt5", "6.1", None),
        ("tt6", "6.2", 8),
        ("tt\x017", "6.3", -9),
    ]


def test_header_is_skipped_in_every_file(spark, tmp_path):
    for part in "ab":
        write_dump(tmp_path / f"{part}.tsv.gz", "tconst\tdirectors\twriters", f"tt{part}\tnm1\t\\N")
    assert sorted(rows(read_dump(spark, str(tmp_path), "title_crew"))) == [
        ("tta", "nm1", None),
        ("ttb", "nm1", None),
    ]


def test_unknown_dump_is_skipped_with_a_warning(caplog):
    with caplog.at_level(logging.WARNING):
        known = ingest.known_tables(["title.crew.tsv.gz", "title.extra.tsv.gz"])
    assert known == [("title.crew.tsv.gz", "title_crew")]
    assert "title.extra.tsv.gz" in caplog.text


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    dumps = {
        "name.basics": [
            "nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles",
            "nm1\tAda\t1950\t\\N\tdirector\ttt1,tt2",
            "nm2\tBo\t\\N\t\\N\t\\N\t\\N",
            "nm3\tBo\t\\N\t\\N\t\\N\t\\N",
        ],
        "title.akas": [
            "titleId\tordering\ttitle\tregion\tlanguage\ttypes\tattributes\tisOriginalTitle",
            'tt1\t1\t"Quoted\tPE\t\\N\t\\N\t\\N\t1',
        ],
        "title.basics": [
            "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear"
            "\truntimeMinutes\tgenres",
            "tt1\tmovie\tOne\tOne\t0\t1987\t\\N\t90\tDrama,Comedy",
            "tt2\tmovie\tTwo\tTwo\t0\t1990\t\\N\t91\t\\N",
            "tt3\tshort\tThree\tThree\tx\t-5\t\\N\t5\t",
            "tt4\tmovie\tFour\tFour\t1\t\\N\t\\N\t\\N\tDrama",
            "tt5\tmovie\tFive\tFive\t1\tsoon\t\\N\t\\N\tDrama",
        ],
        "title.crew": [
            "tconst\tdirectors\twriters",
            "tt1\tnm1,nm2\tnm1",
            "tt2\tnm3\t\\N",
            "tt3\tnm1\t\\N",
            "tt4\t\\N\tnm2",
        ],
        "title.episode": [
            "tconst\tparentTconst\tseasonNumber\tepisodeNumber",
            "tt9\ttt3\t1\t\\N",
        ],
        "title.principals": [
            "tconst\tordering\tnconst\tcategory\tjob\tcharacters",
            'tt1\t1\tnm1\tactor\t\\N\t["Self"]',
        ],
        "title.ratings": [
            "tconst\taverageRating\tnumVotes",
            "tt1\t8.0\t100",
            "tt2\t6.0\t50",
            "tt3\t9.0\t10",
        ],
    }
    for name, lines in dumps.items():
        write_dump(landing / f"{name}.tsv.gz", *lines)
    folder = str(tmp_path_factory.mktemp("warehouse"))
    for _ in range(2):  # a second refresh replaces the first
        ingest.refresh(spark, str(landing), folder)
    return folder


def test_copies_equal_the_raw_tables(spark, warehouse):
    for table in RAW_SCHEMAS:
        if table != "title_basics":
            copy, raw = load_table(spark, warehouse, table), load_raw(spark, warehouse, table)
            assert copy.schema == RAW_SCHEMAS[table]
            assert rows(copy) and sorted(rows(copy), key=repr) == sorted(rows(raw), key=repr)
    assert rows(load_table(spark, warehouse, "title_akas")) == [
        ("tt1", 1, '"Quoted', "PE", None, None, None, "1")
    ]


def test_loading_an_unknown_table(spark, warehouse):
    with pytest.raises(KeyError):
        load_table(spark, warehouse, "title_basics")


def test_titles_are_typed_and_partitioned(spark, warehouse):
    titles = load_titles(spark, warehouse)
    assert titles.columns[-1] == "startYear"
    assert sorted(rows(titles.select("tconst", "isAdult", "startYear"))) == [
        ("tt1", 0, 1987),
        ("tt2", 0, 1990),
        ("tt3", None, -5),
        ("tt4", 1, None),
        ("tt5", 1, None),
    ]
    # Found by partition discovery, too, without a declared schema.
    found = spark.read.parquet(f"{warehouse}/movies_partitioned_by_startyear")
    assert found.schema["startYear"].dataType.simpleString() == "int"


def test_genres_of_titles(spark, warehouse):
    """NULL genres give no row, an empty list one empty genre; years floor."""
    assert rows(genre_by_decade(load_titles(spark, warehouse))) == [
        (-10, "", 1),
        (1980, "Comedy", 1),
        (1980, "Drama", 1),
    ]


def test_votes_per_type_are_ordered(spark, warehouse):
    ratings = load_table(spark, warehouse, "title_ratings")
    assert rows(votes_by_title_type(load_titles(spark, warehouse), ratings)) == [
        ("movie", 150),
        ("short", 10),
    ]


def test_directors_are_grouped_by_name_or_id(spark, warehouse):
    tables = [load_table(spark, warehouse, t) for t in ("title_crew", "title_ratings")]
    tables += [load_titles(spark, warehouse), load_table(spark, warehouse, "name_basics")]
    by_name = top_directors(*tables, digits=4)
    assert rows(by_name) == [("Bo", 7.0, 2, 7.6903), ("Ada", 8.0, 1, 5.5452)]
    by_id = top_directors(*tables, by="nconst", digits=4)
    assert rows(by_id.select("nconst", "primaryName", "movieCount")) == [
        ("nm1", "Ada", 1),
        ("nm2", "Bo", 1),
        ("nm3", "Bo", 1),
    ]
    assert rows(top_directors(*tables, rows=1).select("primaryName")) == [("Bo",)]


def test_unreadable_rating_counts_as_a_movie_without_rating(spark, warehouse):
    tables = [
        load_table(spark, warehouse, "title_crew"),
        spark.createDataFrame(
            [("tt1", "n/a"), ("tt2", "6.0")], "tconst string, averageRating string"
        ),
        load_titles(spark, warehouse),
        load_table(spark, warehouse, "name_basics"),
    ]
    assert sorted(rows(top_directors(*tables, digits=4))) == [
        ("Ada", None, 1, None),
        ("Bo", 6.0, 2, 6.5917),
    ]


def test_preview(spark, warehouse):
    names = load_table(spark, warehouse, "name_basics")
    assert rows(preview(names, "nconst", "primaryName", rows=2, key="nconst")) == [
        ("nm1", "Ada"),
        ("nm2", "Bo"),
    ]
    assert preview(names, "nconst").count() == 3


def test_a_hot_year_is_split_over_files(spark, tmp_path):
    """With a third of all titles in one year, no task writes them all."""
    titles = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("tt"), "id").alias("tconst"),
        *[
            F.sha2(F.concat(F.lit(name), F.col("id").cast("string")), 256).alias(name)
            for name in ("titleType", "primaryTitle", "originalTitle", "endYear", "runtimeMinutes")
        ],
        F.lit("0").alias("isAdult"),
        F.when(F.col("id") % 3 == 0, "2000").otherwise(
            (1900 + F.col("id") % 50).cast("string")
        ).alias("startYear"),
        F.lit("Drama").alias("genres"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        write_titles(titles, str(tmp_path))
    finally:
        spark.conf.unset(key)
    written = load_titles(spark, str(tmp_path))
    hot = written.where("startYear = 2000").groupBy(F.input_file_name()).count()
    sizes = sorted(row["count"] for row in hot.collect())
    assert sum(sizes) == 20_000 and len(sizes) >= 3 and sizes[-1] < 15_000
    assert written.count() == 60_000


def test_blank_lines_nul_and_foreign_headers_are_rows(spark, tmp_path):
    """Every line but a header of the declared names is a row, as it stands."""
    path = tmp_path / "d.tsv.gz"
    write_dump(path, "tconst\taverageRating\tnumVotes", "", "  ", "\0tt1\t1.0\t2", "id\trating\tvotes", "tt2\t\\N\t5.7", "tt3\t1.0\t5.x")
    assert rows(read_dump(spark, str(path), "title_ratings")) == [
        ("", None, None),
        ("  ", None, None),
        ("\0tt1", "1.0", 2),
        ("id", "rating", None),
        ("tt2", None, 5),
        ("tt3", "1.0", None),
    ]


def test_one_failing_dump_ends_the_refresh(spark, tmp_path):
    write_dump(tmp_path / "title.crew.tsv.gz", "tconst\tdirectors\twriters", "tt1\tnm1\t\\N")
    with pytest.raises(Exception, match="title.ratings"):
        ingest.refresh(spark, str(tmp_path), str(tmp_path / "w"), ["title.crew.tsv.gz", "title.ratings.tsv.gz"])
