"""The jobs, on the small tables."""

import json

import pytest
from pyspark.sql import functions as F

from marquee import jobs
from marquee.functions.display import json_records
from marquee.operators.ratings import merged_rating_by_id
from marquee.operators.votes import keyed_records, range_scan, vote_log
from marquee.registry import adapters
from marquee.schemas import RAW_SCHEMAS, dump_of_table
from marquee.sources.messages import file_messages
from marquee.sources.tables import load_table
from marquee.streaming.votes import start_message_log
from marquee.vote_runs import newest_manifest, stored_votes


@pytest.fixture(scope="module")
def warehouse(spark, small, tmp_path_factory):
    landing, folder = (str(tmp_path_factory.mktemp(name)) for name in ("landing", "warehouse"))
    for table in RAW_SCHEMAS:
        rows = adapters.raw_table(spark, small, table)
        adapters.write_dump(rows, f"{landing}/{dump_of_table(table)}")
    jobs.main(["refresh", landing, folder])
    return folder


@pytest.mark.parametrize(
    ("name", "fields"),
    [
        ("genre_by_decade", ["decade", "genre", "count"]),
        ("votes_by_title_type", ["titleType", "totalVotes"]),
        ("top_directors", ["director", "averageRating", "movieCount", "weightedScore"]),
    ],
)
def test_report(spark, warehouse, tmp_path, name, fields):
    jobs.main(["report", name, warehouse, str(tmp_path / "out")])
    lines = [row[0] for row in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines and all(list(json.loads(line)) == fields for line in lines)


def test_compacted_log_has_all_votes(spark, small, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    stream = adapters.message_stream(spark, small)
    start_message_log(stream, log, str(tmp_path / "cp"), once=True).awaitTermination()
    jobs.main(["compact", log, store])
    expected = vote_log(adapters.messages(spark, small))
    assert sorted(stored_votes(spark, store, newest_manifest(spark, store)).collect()) == sorted(expected.collect())


def test_rating_and_votes_know_what_came_after_the_compaction(spark, small, warehouse, tmp_path):
    log, store, inbox, out = (str(tmp_path / name) for name in ("log", "store", "inbox", "out"))
    messages = adapters.messages(spark, small)
    title = vote_log(messages).groupBy("tconst").count().orderBy(F.desc("count"), "tconst").head()["tconst"]
    middle = vote_log(messages).where(F.col("tconst") == title).agg(F.expr("percentile(msg_offset, 0.5)")).head()[0]
    for part in (F.col("msg_offset") < middle, F.col("msg_offset") >= middle):
        messages.where(part).write.mode("append").parquet(inbox)
        start_message_log(file_messages(spark, inbox), log, str(tmp_path / "cp"), once=True).awaitTermination()
        if not (tmp_path / "store").exists():
            jobs.main(["compact", log, store])
    jobs.main(["votes", title, log, store, out])
    wanted = json_records(keyed_records(range_scan(vote_log(messages), title))).collect()
    assert sorted(spark.read.text(out).collect()) == sorted(wanted)
    jobs.main(["rating", title, warehouse, log, store, out])
    ratings = load_table(spark, warehouse, "title_ratings")
    wanted = json_records(merged_rating_by_id(ratings, vote_log(messages), title)).collect()
    assert spark.read.text(out).collect() == wanted


def test_unknown_names(spark, warehouse):
    with pytest.raises(ValueError):
        jobs.report(spark, "nothing", warehouse)
    with pytest.raises(SystemExit):
        jobs.main(["nothing"])
