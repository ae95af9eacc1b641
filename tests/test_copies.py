"""Copies that are measured while they are written, and lookups by their Bloom filters."""

import pytest
from pyspark.sql import functions as F

from marquee import versions
from marquee.plans import ingest
from marquee.registry import adapters
from marquee.schemas import RAW_SCHEMAS, parquet_name, raw_name
from marquee.sinks import tables
from marquee.sources.tables import load_raw, load_table

TABLE = "title_ratings"


def land(spark, folder, n=1000, table=TABLE):
    rows = spark.range(n).select(
        F.format_string("tt%07d", F.col("id") * 2).alias("tconst"), F.lit("5.0").alias("averageRating"), F.lit(3).alias("numVotes")
    )
    return tables.write_raw(adapters.as_raw(rows.repartition(8), table), folder, table)


def test_copy_holds_what_the_raw_table_held(spark, tmp_path):
    folder = str(tmp_path / "w")
    landed = land(spark, folder)
    copied = ingest.convert_table(spark, folder, TABLE)
    assert (copied["n_rows"], copied["n_chars"]) == (1000, 1000 * (9 + 3 + 1))
    assert {n: v for n, v in copied.items() if n != "n_keys"} == {n: v for n, v in landed.items() if n != "n_keys"}
    assert tables.measures(spark, versions.newest(spark, f"{folder}/{parquet_name(TABLE)}")) == copied
    assert load_table(spark, folder, TABLE).exceptAll(load_raw(spark, folder, TABLE)).count() == 0


@pytest.mark.parametrize(
    "damage",
    [
        lambda rows: rows.where("tconst <> 'tt0000010'"),
        lambda rows: rows.unionByName(rows.limit(1)),
        lambda rows: rows.withColumn("numVotes", F.when(F.col("tconst") == "tt0000010", 4).otherwise(F.col("numVotes"))),
        lambda rows: rows.where("tconst <> 'tt0000010'").unionByName(rows.where("tconst = 'tt0000012'")),
    ],
)
def test_a_copy_with_other_rows_is_refused(spark, tmp_path, damage):
    folder = str(tmp_path / "w")
    landed = land(spark, folder)
    ingest.convert_table(spark, folder, TABLE)
    before = versions.newest(spark, f"{folder}/{parquet_name(TABLE)}")
    with pytest.raises(tables.IncompleteCopy):
        tables.write_copy(damage(load_raw(spark, folder, TABLE)), folder, TABLE, landed)
    assert versions.newest(spark, f"{folder}/{parquet_name(TABLE)}") == before
    assert versions.subfolders(spark, f"{folder}/{parquet_name(TABLE)}") == ["version=1"]
    assert load_table(spark, folder, TABLE).count() == 1000


def test_an_unfinished_copy_is_not_read(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "w")
    land(spark, folder)
    ingest.convert_table(spark, folder, TABLE)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "complete", lost)
        with pytest.raises(OSError):
            ingest.convert_table(spark, folder, TABLE)
    assert versions.newest(spark, f"{folder}/{parquet_name(TABLE)}").endswith("version=1")
    ingest.convert_table(spark, folder, TABLE)
    assert versions.newest(spark, f"{folder}/{parquet_name(TABLE)}").endswith("version=3")


def test_empty_tables_and_nulls(spark, tmp_path):
    folder = str(tmp_path / "w")
    for rows, n in (([], 0), ([(None, None, None), (None, None, None), ("tt1", "", 0)], 3)):
        raw = spark.createDataFrame(rows, RAW_SCHEMAS[TABLE])
        assert tables.write_raw(raw, folder, TABLE)["n_rows"] == n
        assert ingest.convert_table(spark, folder, TABLE)["n_rows"] == n
        assert load_table(spark, folder, TABLE).count() == n


def rows_read(frame):
    """Rows that the scan of a lookup handed on."""
    found = frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return len(found), leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_row_groups_of_many_files(spark, tmp_path):
    folder, n, files = str(tmp_path / "w"), 400_000, 20
    land(spark, folder, n)
    source = versions.newest(spark, f"{folder}/{raw_name(TABLE)}")
    spread = spark.read.schema(RAW_SCHEMAS[TABLE]).parquet(source).repartition(files)
    tables.write_copy(spread, folder, TABLE, tables.measures(spark, source))
    plain = str(tmp_path / "plain")
    spread.sortWithinPartitions("tconst").write.option("parquet.enable.dictionary", "false").parquet(plain)
    copy = load_table(spark, folder, TABLE)
    assert len(copy.inputFiles()) == files
    for key, hits in (("tt0300001", 0), ("tt0555555", 0), ("tt0300000", 1)):
        found, read = rows_read(copy.where(F.col("tconst") == key))
        # Without the filters each file hands on a page; a few groups pass by chance.
        assert found == hits and read <= 3 * n // files
        assert rows_read(spark.read.schema(RAW_SCHEMAS[TABLE]).parquet(plain).where(F.col("tconst") == key))[1] > read
