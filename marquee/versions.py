"""Tables as folders of versions, so that replacing one disturbs no reader.

Of a folder of tables a commit names one version each, so that a reader who pins it
sees all tables as they were at one moment.

A table at ``path`` is in ``path/version=N``; the newest version that its writer
has completed is the table. A reader keeps the files it has listed: a version is
removed only when newer ones have been completed ``KEPT`` times.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

KEPT = 3
COMPLETED = "_SUCCESS"
#: Subfolders for commits of several tables, and for the pins of their readers.
COMMITS, PINS = "_commits", "_pins"
PIN_SECONDS = 24 * 3600


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Version → completed."""
    files, location = _files(spark, path)
    if not files.exists(location):
        return {}
    found = {}
    for status in files.listStatus(location):
        name = status.getPath().getName()
        if name.startswith("version="):
            mark = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), COMPLETED)
            found[int(name.removeprefix("version="))] = files.exists(mark)
    return found


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def next_version(spark: SparkSession, path: str) -> str:
    """Where a new version goes: above all there are, completed or not."""
    return version_path(path, max(_versions(spark, path), default=0) + 1)


def newest(spark: SparkSession, path: str) -> str:
    """The newest completed version."""
    completed = [n for n, done in _versions(spark, path).items() if done]
    if not completed:
        raise FileNotFoundError(f"no completed version of {path}")
    return version_path(path, max(completed))


def drop_old(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Removes what is older than the newest ``kept`` completed versions.

    Versions stay that a newer commit or a pin of the table's folder names.
    """
    versions = _versions(spark, path)
    completed = sorted((n for n, done in versions.items() if done), reverse=True)
    if len(completed) < kept:
        return
    folder, _, table = path.rstrip("/").rpartition("/")
    named = {tables.get(table) for tables in _held(spark, folder)}
    for number in (n for n in versions if n < completed[kept - 1] and n not in named):
        files, location = _files(spark, version_path(path, number))
        files.delete(location, True)


# Several tables at one moment ------------------------------------------


def newest_version(spark: SparkSession, path: str) -> int:
    return int(newest(spark, path).rpartition("=")[2])


def commit(spark: SparkSession, folder: str, tables: dict[str, int]) -> int:
    """Makes these versions of a folder's tables the present ones, all at once.

    A commit is one file that names the version of every table; tables that are not
    given stay as the commit before has them. Of two writers one fails.
    """
    numbers = numbered(spark, f"{folder}/{COMMITS}")
    before = _committed(spark, folder, numbers[-1]) if numbers else {}
    number = (numbers[-1] if numbers else 0) + 1
    put_text(spark, f"{folder}/{COMMITS}/{number}.json", json.dumps({**before, **tables}))
    for old in numbers[: -KEPT + 1]:
        removed(spark, f"{folder}/{COMMITS}/{old}.json")
    return number


def _committed(spark: SparkSession, folder: str, number: int) -> dict[str, int]:
    return json.loads(get_text(spark, f"{folder}/{COMMITS}/{number}.json"))


def present(spark: SparkSession, folder: str) -> dict[str, int]:
    """The version of each table in the newest commit."""
    numbers = numbered(spark, f"{folder}/{COMMITS}")
    if not numbers:
        raise FileNotFoundError(f"no commit in {folder}")
    return _committed(spark, folder, numbers[-1])


@contextmanager
def pinned(spark: SparkSession, folder: str, seconds: float = PIN_SECONDS) -> Iterator[dict[str, int]]:
    """The newest commit's versions, which are not removed before the block ends.

    If it ends without a word, as with a lost driver, they are free after ``seconds``.
    """
    path = f"{folder}/{PINS}/{uuid.uuid4().hex}.json"
    tables = present(spark, folder)
    put_text(spark, path, json.dumps({"until": time.time() + seconds, "tables": tables}))
    try:
        yield tables
    finally:
        removed(spark, path)


def _held(spark: SparkSession, folder: str) -> list[dict[str, int]]:
    """The versions that kept commits and pins name; pins that are over are removed."""
    held = [_committed(spark, folder, n) for n in numbered(spark, f"{folder}/{COMMITS}")]
    for name in subfolders(spark, f"{folder}/{PINS}"):
        if name.startswith(".") or not name.endswith(".json"):
            continue
        try:
            pin = json.loads(get_text(spark, f"{folder}/{PINS}/{name}"))
        except Py4JJavaError:  # its reader has just ended
            continue
        if pin["until"] < time.time():
            removed(spark, f"{folder}/{PINS}/{name}")
        else:
            held.append(pin["tables"])
    return held


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path, from the file system's listing."""
    files, location = _files(spark, path)
    return files.getContentSummary(location).getLength()


def completed(spark: SparkSession, path: str) -> bool:
    """Whether a folder's writer has ended."""
    files, mark = _files(spark, f"{path}/{COMPLETED}")
    return files.exists(mark)


def complete(spark: SparkSession, path: str) -> None:
    """Marks a folder as written to its end, which its writer has left to the caller."""
    files, mark = _files(spark, f"{path}/{COMPLETED}")
    files.create(mark, True).close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written aside, then renamed.

    A file of that name is an error, so that of two writers one fails.
    """
    files, location = _files(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(location.getParent(), f".{location.getName()}-{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(location) or not files.rename(aside, location):
        files.delete(aside, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    files, location = _files(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def numbered(spark: SparkSession, path: str, suffix: str = ".json") -> list[int]:
    """The numbers of the files ``N.json`` in a folder, rising."""
    files, location = _files(spark, path)
    if not files.exists(location):
        return []
    names = [status.getPath().getName() for status in files.listStatus(location)]
    return sorted(int(n.removesuffix(suffix)) for n in names if n.endswith(suffix) and n.removesuffix(suffix).isdigit())


def removed(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    files, location = _files(spark, path)
    files.delete(location, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none if it is not there."""
    files, location = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(location)] if files.exists(location) else []
