"""Tables that change together: readers see all-old or all-new."""

import json
import time

import pytest

from marquee import jobs, versions
from marquee.plans import ingest
from marquee.registry import adapters
from marquee.schemas import dump_of_table
from marquee.sinks.tables import write_copy, write_titles
from marquee.sources.tables import load_table, load_titles


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def raw(spark, table, *values):
    """Rows of a raw table, the given columns of each."""
    frame = spark.createDataFrame([tuple(v.values()) for v in values], list(values[0]))
    return adapters.as_raw(frame, table)


def titles(spark, kind):
    return raw(spark, "title_basics", {"tconst": "tt1", "titleType": kind, "startYear": 2000})


def ratings(spark, votes):
    return raw(spark, "title_ratings", {"tconst": "tt1", "averageRating": 5.0, "numVotes": votes})


def put(spark, folder, kind, votes):
    write_titles(titles(spark, kind), folder)
    write_copy(ratings(spark, votes), folder, "title_ratings")
    return {n: versions.newest_version(spark, f"{folder}/{n}") for n in versions.subfolders(spark, folder) if not n.startswith("_")}


def seen(spark, folder, at):
    return rows(jobs.report(spark, "votes_by_title_type", folder, at))


def test_report_sees_all_old_or_all_new(spark, tmp_path):
    folder = str(tmp_path / "w")
    versions.commit(spark, folder, put(spark, folder, "movie", 10))
    with versions.pinned(spark, folder) as at:
        write_titles(titles(spark, "short"), folder)
        assert seen(spark, folder, versions.present(spark, folder)) == [("movie", 10)]
        write_copy(ratings(spark, 99), folder, "title_ratings")
        assert seen(spark, folder, versions.present(spark, folder)) == [("movie", 10)]
        tables = {n: versions.newest_version(spark, f"{folder}/{n}") for n in at}
        versions.commit(spark, folder, tables)
        assert seen(spark, folder, at) == [("movie", 10)]
        assert seen(spark, folder, versions.present(spark, folder)) == [("short", 99)]
    assert versions.subfolders(spark, f"{folder}/_pins") == []


def test_pins_and_commits_keep_versions(spark, tmp_path):
    folder = str(tmp_path / "w")
    versions.commit(spark, folder, put(spark, folder, "movie", 1))
    with versions.pinned(spark, folder) as at:
        for k in range(2, 8):
            versions.commit(spark, folder, put(spark, folder, "movie", k))
        assert seen(spark, folder, at) == [("movie", 1)]
    put(spark, folder, "movie", 8)
    name = next(n for n in at if "ratings" in n)
    assert 1 not in versions._versions(spark, f"{folder}/{name}")
    # Three failed refreshes, which commit nothing, do not remove what is committed.
    before = versions.present(spark, folder)
    for k in range(9, 14):
        put(spark, folder, "movie", k)
    assert versions.present(spark, folder) == before and seen(spark, folder, before) == [("movie", 7)]
    assert len(versions.numbered(spark, f"{folder}/_commits")) == versions.KEPT


def test_a_pin_that_was_left_behind_ends(spark, tmp_path):
    folder = str(tmp_path / "w")
    versions.commit(spark, folder, {"t": 1})
    versions.put_text(spark, f"{folder}/_pins/x.json", json.dumps({"until": time.time() - 1, "tables": {"t": 1}}))
    assert versions._held(spark, folder) == [{"t": 1}]
    assert versions.subfolders(spark, f"{folder}/_pins") == []


def test_a_second_writer_of_a_commit_fails(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "w")
    versions.commit(spark, folder, {"t": 1})
    monkeypatch.setattr(versions, "numbered", lambda *a: [])
    with pytest.raises(FileExistsError):
        versions.commit(spark, folder, {"t": 2})


def test_refresh_commits_at_its_end(spark, small, tmp_path, monkeypatch):
    landing, folder = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    for table in ("title_basics", "title_ratings"):
        adapters.write_dump(adapters.raw_table(spark, small, table), f"{landing}/{dump_of_table(table)}")
    dumps = [dump_of_table(t) for t in ("title_basics", "title_ratings")]
    ingest.refresh(spark, landing, folder, dumps)
    first = versions.present(spark, folder)
    assert rows(load_table(spark, folder, "title_ratings", first)) == rows(load_table(spark, folder, "title_ratings"))
    assert load_titles(spark, folder, first).count() == load_titles(spark, folder).count()

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "partition_titles", fails)
        with pytest.raises(OSError):
            ingest.refresh(spark, landing, folder, dumps)
    assert versions.present(spark, folder) == first
    ingest.refresh(spark, landing, folder, [dump_of_table("title_ratings")])
    last = versions.present(spark, folder)
    assert {n for n in last if last[n] != first[n]} == {n for n in last if "ratings" in n}
    assert set(first) == set(last)
