"""Publishing tables by version.

A writer fills a folder of its own and then marks it as published; readers take the last marked one. So a reader
never sees half a load, a load that fails changes nothing, and loads that run at the same time do not touch each
other. A mark is an empty file whose name holds its number and version: creating it is one step on any file system.

    folder/_published/000000000001.<version>
    folder/versions/<version>/...
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

MARKS = "_published"
Result = TypeVar("Result")


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def published(spark: SparkSession, folder: str) -> list[str]:
    """The paths of all published versions under ``folder``, oldest first."""
    files, marks = _files(spark, f"{folder}/{MARKS}")
    names = sorted(s.getPath().getName() for s in files.listStatus(marks)) if files.exists(marks) else []
    return [f"{folder}/versions/{name.partition('.')[2]}" for name in names]


def current(spark: SparkSession, folder: str) -> str:
    """The path of the last published version, or ``folder`` itself where nothing was published by version."""
    return next(reversed(published(spark, folder)), folder)


def publish(spark: SparkSession, folder: str, write: Callable[[str], Result]) -> tuple[str, Result]:
    """Let ``write`` fill a new version and publish it; its path and what ``write`` returned.

    Of two loads that end together both stay readable at their paths, and one of them is the current one.
    """
    version = uuid.uuid4().hex
    path = f"{folder}/versions/{version}"
    result = write(path)
    number = len(published(spark, folder)) + 1
    files, mark = _files(spark, f"{folder}/{MARKS}/{number:012d}.{version}")
    files.create(mark, False).close()
    return path, result


def drop_old(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Delete all published versions but the last ``keep``, for when nobody reads them; the paths that went.

    Their marks stay, so that numbers go on.
    """
    gone = [p for p in published(spark, folder)[:-max(1, keep)] if _files(spark, p)[0].exists(_files(spark, p)[1])]
    for path in gone:
        files, place = _files(spark, path)
        files.delete(place, True)
    return gone
