"""Which partitions each write replaced, and what they held before.

Beside a partitioned table lies one small file for each version, with the partition folders
that the write replaces. It is named `pending` before anything moves and renamed `done` when
all has moved. Readers take done versions only, so nobody moves a mark past partitions that
are still on their way. Partitions of a version that stayed pending because its write was
interrupted belong to the next version as well. Listing the folder finds the newest version;
only the files of wanted versions are read.

Where history is kept, a replaced partition moves to a folder of its version instead of being
deleted (an empty folder stands for one that did not exist), which gives reads of past
versions and change feeds between any two of them that touch changed partitions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickmill.operators.merge import change_feed, touched_predicate
from clickmill.sources import files


def _log(path: str) -> str:
    return path.rstrip("/") + "__changes"


def _history(path: str) -> str:
    return path.rstrip("/") + "__history"


def _versions(spark: SparkSession, path: str, state: str) -> list[int]:
    names = files.names(spark, _log(path))
    return sorted(int(n.split(".")[0]) for n in names if n.endswith("." + state))


def _file(path: str, version: int, state: str) -> str:
    return f"{_log(path)}/{version:012d}.{state}"


def _folders(spark: SparkSession, path: str, version: int, state: str) -> list[str]:
    return files.read_text(spark, _file(path, version, state)).splitlines()


def newest_version(spark: SparkSession, path: str) -> int:
    """Version of the last finished write to a partitioned table, 0 where none is noted."""
    return max(_versions(spark, path, "done"), default=0)


def begin(spark: SparkSession, path: str, folders: list[str]) -> int:
    """Note the partitions about to be replaced; the version they will have."""
    left = _versions(spark, path, "pending")
    every = set(folders).union(*(_folders(spark, path, v, "pending") for v in left))
    version = max([newest_version(spark, path), *left]) + 1
    files.write_text(spark, _file(path, version, "pending"), "\n".join(sorted(every)))
    return version


def finish(spark: SparkSession, path: str, version: int) -> None:
    files.replace(spark, _file(path, version, "pending"), _file(path, version, "done"))
    for left in _versions(spark, path, "pending"):
        if left < version:
            files.delete(spark, _file(path, left, "pending"))


def changed_folders(spark: SparkSession, path: str, after: int, up_to: int) -> list[str]:
    found = [v for v in _versions(spark, path, "done") if after < v <= up_to]
    return sorted(set().union(*(_folders(spark, path, v, "done") for v in found)))


def changed_partitions(spark: SparkSession, path: str, after: int, up_to: int) -> list[tuple]:
    """Values of the partitions that versions after one up to another replaced."""
    return sorted((files.values_of(f) for f in changed_folders(spark, path, after, up_to)), key=repr)


def keep_history(spark: SparkSession, path: str) -> None:
    """From now on replaced partitions of the table are kept."""
    if not files.exists(spark, _history(path) + "/since"):
        files.write_text(spark, _history(path) + "/since", str(newest_version(spark, path)))


def put_aside(spark: SparkSession, path: str, folder: str, version: int) -> None:
    """Take a partition that a version replaces out of the table."""
    if not files.exists(spark, _history(path) + "/since"):
        files.delete(spark, path + folder)
    elif files.exists(spark, path + folder):
        files.replace(spark, path + folder, f"{_history(path)}/{version:012d}{folder}")
    else:
        files.make_folder(spark, f"{_history(path)}/{version:012d}{folder}")


def forget_history(spark: SparkSession, path: str, up_to: int) -> None:
    """Drop what versions up to this one replaced; earlier states can no longer be read."""
    for name in files.names(spark, _history(path)):
        if name.isdigit() and int(name) <= up_to:
            files.delete(spark, f"{_history(path)}/{name}")
    since = int(files.read_text(spark, _history(path) + "/since"))
    files.write_text(spark, _history(path) + "/since", str(max(since, up_to)))


def _partitions_at(spark: SparkSession, path: str, version: int, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows that the named partitions held at a version."""
    if not files.exists(spark, _history(path) + "/since") or int(files.read_text(spark, _history(path) + "/since")) > version:
        raise ValueError(f"{path} has no history back to version {version}")
    later = sorted(int(n) for n in files.names(spark, _history(path)) if n.isdigit() and int(n) > version)
    where: dict[str, list[str]] = {}
    for folder in folders:
        bases = (f"{_history(path)}/{v:012d}" for v in later)
        base = next((b for b in bases if files.exists(spark, b + folder)), path.rstrip("/"))
        if files.is_table(spark, base + folder):
            where.setdefault(base, []).append(base + folder)
    rows = spark.createDataFrame([], schema)
    for base, paths in where.items():
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", base).parquet(*paths))
    return rows


def read_version(spark: SparkSession, path: str, cols: tuple[str, ...], version: int, schema: T.StructType) -> DataFrame:
    """The table as it stood at a version; partitions not changed since are read in place."""
    folders = changed_folders(spark, path, version, newest_version(spark, path))
    current = spark.read.schema(schema).parquet(path)
    if not folders:
        return current
    unchanged = current.filter(~touched_predicate(cols, [files.values_of(f) for f in folders]))
    return unchanged.unionByName(_partitions_at(spark, path, version, folders, schema))


def version_feed(
    spark: SparkSession, path: str, keys: list[str], after: int, up_to: int, schema: T.StructType
) -> DataFrame:
    """Row changes between two versions, read from the partitions that changed in between."""
    folders = changed_folders(spark, path, after, up_to)
    old, new = (_partitions_at(spark, path, v, folders, schema) for v in (after, up_to))
    return change_feed(old, new, keys)
