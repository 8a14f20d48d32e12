"""Folders that are replaced as a whole: versions beside each other, and a marker that is written last.

A version is written to a folder of its own under ``base/versions``. Committing it creates one empty
file under ``base/_commits`` whose name holds a number and the version. That is the only step that
readers see: they take the marker with the highest number, so they read the older version until the
new one is complete, and one that failed is never read. Nothing is deleted before a commit, nothing
is renamed or copied (an object store has neither), and no file is ever changed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_MARKERS, _FOLDERS = "_commits", "versions"


def _file_system(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, uri: str) -> list[str]:
    system, path = _file_system(spark, uri)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def new_version(base: str) -> str:
    """A new folder to write a version to; readers of ``base`` do not see it before its commit."""
    return f"{base.rstrip('/')}/{_FOLDERS}/{uuid.uuid4().hex}"


def version_name(folder: str) -> str:
    return folder.rstrip("/").rsplit("/", 1)[-1]


def current(spark: SparkSession, base: str) -> str | None:
    """The folder of the version last committed to ``base``; None when there is none."""
    markers = _names(spark, f"{base.rstrip('/')}/{_MARKERS}")
    return f"{base.rstrip('/')}/{_FOLDERS}/{markers[-1].split('-')[1]}" if markers else None


def commit(spark: SparkSession, base: str, folder: str, kept: int = 2) -> None:
    """Make ``folder`` the current version of ``base``, and then remove all but the last ``kept``.

    Of two commits at one time, one follows the other by its name; both versions are complete.
    """
    markers = _names(spark, f"{base.rstrip('/')}/{_MARKERS}")
    number = 1 + int(markers[-1].split("-")[0]) if markers else 1
    marker = f"{number:012d}-{version_name(folder)}"
    system, path = _file_system(spark, f"{base.rstrip('/')}/{_MARKERS}/{marker}")
    system.create(path, False).close()
    for old in [*markers, marker][:-kept]:
        # The marker goes first: a version without one is never read.
        for place in (f"{_MARKERS}/{old}", f"{_FOLDERS}/{old.split('-')[1]}"):
            system, path = _file_system(spark, f"{base.rstrip('/')}/{place}")
            system.delete(path, True)
