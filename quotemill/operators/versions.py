"""Versions of a table as folders of its path.

Every load writes a folder of its own, ``v<number>-<id>``, and counts once Spark has put its success mark there. Readers of
the last complete version never see one that is being written, and a failed load leaves no trace but an unread folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_DONE = "_SUCCESS"


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, in order; none for a folder that is absent."""
    files, folder = _open(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _open(spark, path)
    return files.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    files, folder = _open(spark, path)
    files.mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _open(spark, path)
    files.delete(folder, True)


def _is_version(name: str) -> bool:
    return name[:1] == "v" and name[1:9].isdigit()


def has_versions(spark: SparkSession, path: str) -> bool:
    """Whether a load was begun below this path, complete or not."""
    return any(map(_is_version, children(spark, path)))


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions, oldest first."""
    return [f"{path}/{name}" for name in children(spark, path) if _is_version(name) and exists(spark, f"{path}/{name}/{_DONE}")]


def newest(spark: SparkSession, path: str) -> str | None:
    """The folder readers are to look at."""
    done = versions(spark, path)
    return done[-1] if done else None


def next_version(spark: SparkSession, path: str) -> str:
    """A folder for the next load. Two loads at once get folders of their own; the later name counts."""
    taken = [int(name[1:9]) for name in children(spark, path) if _is_version(name)]
    return f"{path}/v{max(taken, default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def drop_versions(spark: SparkSession, path: str, used: set[str], keep: int = 2) -> list[str]:
    """Delete versions that are not in ``used``, but for the newest ``keep``; returns what was deleted.

    Queries that still read an older version fail, so this is for times when none runs.
    """
    old = [v for v in versions(spark, path)[: -keep or None] if v not in used]
    for folder in old:
        remove(spark, folder)
    return old
